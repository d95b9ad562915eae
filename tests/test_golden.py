"""Golden rows of the hand-checked mini data set (FIXTURES.md section 2)."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from golden import golden_catalog

from salesfacts.config import NA_P4S, NA_PBC, NA_TEST, NAF_NONPROD, NAF_PROD
from salesfacts.plans.pipeline import monthly, run
from salesfacts.schemas import OUTPUT_CONTRACT

SENT = date(1900, 1, 1)
COLS = ("calendar_month", "material_number", "brand", "gross_sales_amount_local_currency_code",
        "first_order_date", "gross_sales_amount_local", "gross_sales_amount_global",
        "net_sales_amount_local", "net_sales_amount_global", "net_sales_quantity_local",
        "open_order_quantity_local", "return_quantity_local", "shipped_quantity_local",
        "total_order_quantity_local")


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def _d(x):
    return None if x is None else D(x).quantize(D("0.000000001"))


def _row(month, mat, brand, ccy, first, gl, gg, nl, ng, nq, op, ret, sh, to):
    return (month, mat, brand, ccy, first, *[_d(v) for v in (gl, gg, nl, ng, nq, op, ret, sh, to)])


def test_prod_monthly(spark):
    got = _rows(monthly(golden_catalog(spark), NAF_PROD))
    want = sorted([
        _row("02", "M1", "B1", "EUR", date(2020, 2, 6), 20, 20, 18, 18, 1, 3, 2, 4, 7),
        _row("02", "M1", "B1", "MAD", SENT, 100, 10, 100, 10, 6, 0, 0, 0, 0),
        _row("02", "M1", "B1", "USD", SENT, 50, None, 50, None, 2, 0, 0, 0, 0),
        _row("02", "M2", "B4", "EUR", SENT, 30, 30, 30, 30, 3, 0, 0, 0, 0),
        _row("03", "M1", "B1", "USD", SENT, 50, None, 50, None, 2, 0, 0, 0, 0),
    ])
    assert got == want


def test_pbc_monthly_keeps_rate_fan_out(spark):
    got = _rows(monthly(golden_catalog(spark), NA_PBC))
    want = sorted([
        _row("02", "M1", "B1", "EUR", date(2020, 2, 6), 20, 20, 18, 18, 1, 3, 2, 4, 7),
        _row("02", "M1", "B1", "MAD", SENT, 100, 1000, 100, 1000, 6, 0, 0, 0, 0),
        _row("02", "M1", "B1", "USD", SENT, 50, 45, 50, 45, 2, 0, 0, 0, 0),
        _row("03", "M1", "B1", "USD", SENT, 100, 85, 100, 85, 4, 0, 0, 0, 0),
    ])
    assert got == want


def _feb_m1(m):
    return sorted(
        (tuple(r) for r in m.where("calendar_month = '02' AND material_number = 'M1'")
         .select("gross_sales_amount_local_currency_code", "first_order_date",
                 "gross_sales_amount_local", "gross_sales_amount_global", "open_order_quantity_local",
                 "return_quantity_local", "shipped_quantity_local", "total_order_quantity_local")
         .collect()), key=str)
    assert (None, date(2020, 2, 6), _d(0), None, _d(3), _d(2), _d(4), _d(7)) in feb_m1
    assert ("EUR", SENT, _d(20), _d(20), _d(0), _d(0), _d(0), _d(0)) in feb_m1


@pytest.mark.parametrize("cfg,rows", [(NAF_PROD, 15), (NA_PBC, 4)])
def test_final_row_counts(spark, cfg, rows):
    assert run(golden_catalog(spark), cfg).count() == rows


def test_prod_labels_from_xref_patterns(spark):
    df = run(golden_catalog(spark), NAF_PROD)
    got = {(r.opl_account_source_system_code, r.source_system_code)
           for r in df.select("opl_account_source_system_code", "source_system_code").collect()}
    assert got == {("SAP-P4S-C", "DataOne-P4S"), ("SAP-PBC-C", "DataOne-PBC"), ("SAP-QBC-C", "DataOne")}
    np_labels = {r[0] for r in run(golden_catalog(spark), NAF_NONPROD).select("source_system_code").collect()}
    assert np_labels == {"DataOne", "DataOne-QBC"}


def test_output_contract(spark):
    df = run(golden_catalog(spark), NAF_PROD)
    assert [(f.name, f.dataType) for f in df.schema.fields] == OUTPUT_CONTRACT
    test = run(golden_catalog(spark), NA_TEST)
    assert test.columns[10] == "opl_source_system_code"


def test_prod_rounds_money(spark):
    cat = golden_catalog(spark, {"billing_lines": [
        ("20200210", "DE", "G1", "A1", "M1", "KG", "MAD", "YG2W", D("10.05"), D("10.05"), D("1"),
         "0085", "PC09", "20", "00", "M")]})
    r = run(cat, NAF_PROD).where("gross_sales_amount_local_currency_code = 'MAD'") \
        .select("gross_sales_amount_global").distinct().collect()
    # 10.05 / 10 = 1.005 -> half away from zero -> 1.01
    assert {x[0] for x in r} == {D("1.010000000")}


def test_p4s_converts_local_amounts(spark):
    m = monthly(golden_catalog(spark, {"order_lines": [], "delivery_lines": [], "billing_lines": [
        ("20200210", "DE", "G1", "A1", "M1", "KG", "USD", "YF2D", D("50"), D("50"), D("2"),
         "1254", "IQ09", "20", "80", "M")]}), NA_P4S)
    r = m.select("gross_sales_amount_local", "gross_sales_amount_local_currency_code",
                 "gross_sales_amount_global").collect()
    assert [tuple(x) for x in r] == [(_d(45), "EUR", _d(45))]


def test_stamps_are_pinned_by_load_ts(spark):
    ts = datetime(2026, 1, 1)
    r = run(golden_catalog(spark), NA_PBC, ts).select("row_insert_timestamp", "row_update_timestamp").distinct()
    assert [tuple(x) for x in r.collect()] == [(ts, ts)]
