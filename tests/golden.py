"""The hand-checked mini data set (FIXTURES.md section 2) as Spark DataFrames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

from salesfacts.schemas import INPUT_SCHEMAS
from salesfacts.sources.catalog import SourceCatalog

LOB = "Crop Protection"


def _mat(num, src, upd, deleted, lob, brand):
    return (num, src,
            ("BG", lob, brand, f"P-{num}", "C1"),
            ("PG", "DV"),
            (datetime(upd, 1, 1),),
            (deleted,) if deleted else None)


MATERIALS = [
    _mat("M1", "BC", 2021, None, LOB, "B2"),
    _mat("M1", "BC", 2020, None, LOB, "B1"),
    _mat("M1", "4S", 2019, None, LOB, "B0"),
    _mat("M2", "4S", 2020, None, LOB, "B4"),
    _mat("M3", "BC", 2020, datetime(2020, 6, 1), LOB, "B5"),
    _mat("M4", "BC", 2020, None, "Seeds", "B6"),
]

RATES = [
    ("MAD", "EUR", date(2020, 2, 1), date(2020, 2, 29), D("10"), "xbc"),
    ("MAD", "EUR", date(2020, 2, 1), date(2020, 3, 31), D("12"), "x4s"),
    ("MAD", "EUR", date(2020, 2, 15), date(2020, 2, 29), D("99"), "xbc"),
    ("MAD", "EUR", date(2019, 12, 1), date(2020, 12, 31), D("7"), "xbc"),
    ("USD", "EUR", date(2020, 2, 1), date(9999, 12, 31), D("0.9"), "xbc"),
    ("USD", "EUR", date(2020, 3, 1), date(9999, 12, 31), D("0.8"), "xbc"),
]

_DIMS = ("DE", "G1", "A1")  # country, sales group, sold-to


def _order(day, doc_type, mat, qty):
    return (day, *_DIMS, mat, "KG", D(qty), "0085", "PC09", doc_type, "20", "C", "00")


ORDERS = [_order("20200206", "Z4RT", "M1", "2"), _order("20200205", "Z4SD", "M1", "7")]

DELIVERIES = [
    ("20200207", *_DIMS, "M1", "KG", D("4"), "0085", "PC09", "20", "00"),
    ("00000000", *_DIMS, "M1", "KG", D("9"), "0085", "PC09", "20", "00"),
]


def _bill(day, btype, ccy, mat, gross, net, qty):
    return (day, *_DIMS, mat, "KG", ccy, btype, D(gross), D(net), D(qty), "0085", "PC09", "20", "00", "M")


BILLING = [
    _bill("20200210", "YG2W", "MAD", "M1", "100", "90", "5"),
    _bill("20200215", "YB3D", "MAD", "M1", "500", "10", "1"),
    _bill("20200210", "YF2D", "USD", "M1", "50", "50", "2"),
    _bill("20200310", "YF2D", "USD", "M1", "50", "50", "2"),
    _bill("20200220", "YL2W", "EUR", "M1", "20", "18", "1"),
    _bill("20200220", "YL2W", "EUR", "M2", "30", "30", "3"),
    _bill("20200220", "YL2W", "EUR", "M3", "1", "1", "1"),
    _bill("20200220", "YL2W", "EUR", "M4", "1", "1", "1"),
    _bill("20191231", "YL2W", "EUR", "M1", "5", "5", "5"),
]

XREF = [
    ("A1 ", "DISTRIBUTOR", "SAP-P4S-C", "C1", "G", "K"),
    (" A1", "DISTRIBUTOR ", "SAP-PBC-C", "C1", "G", "K"),
    ("A1", "DISTRIBUTOR", "SAP-QBC-C", "C1", "G", "K"),
    ("A1", "DISTRIBUTOR", "SAP-QBC-C", "C1", "G", "K"),
    ("A1", "RETAILER", "SAP-PBC-C", "C2", "G", "K"),
    (None, "DISTRIBUTOR", "SAP-PBC-C", "C3", "G", "K"),
]

TABLES = {
    "material_master": MATERIALS, "exchange_rates": RATES, "order_lines": ORDERS,
    "delivery_lines": DELIVERIES, "billing_lines": BILLING, "account_xref": XREF,
}


def golden_catalog(spark, overrides: dict | None = None) -> SourceCatalog:
    rows = {**TABLES, **(overrides or {})}
    dfs = {n: spark.createDataFrame(r, INPUT_SCHEMAS[n]) for n, r in rows.items()}
    return SourceCatalog(spark, {n: (lambda df=df: df) for n, df in dfs.items()})
