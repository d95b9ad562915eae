"""Stand-ins for the six ERP/CRM tables, derived by Spark from the TPC-H-like
test tables (part, nation, customer, orders, lineitem).

The original job's tables are not public, so the tests run on relations with
the same shape and code values. Every stand-in is a pure function of the given
tables, so its size grows with them. Dates are moved 24 years forward
(1995-2001 -> 2019-2025) so that the job's own 2020 floors apply; 24 years keep
every leap day valid.

The twin of each stand-in in DuckDB SQL lives in ``salesfacts.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesfacts.schemas import MEASURE, RATE

# Fixed values of the stand-in generator (code lists indexed by a key).
COMPANY_BY_NATION_MOD4 = ("0085", "2926", "1254", "1334")
SALES_ORG_BY_SEGMENT = (("AUTOMOBILE", "PC09"), ("BUILDING", "EN09"), ("FURNITURE", "DG09"),
                        ("HOUSEHOLD", "IQ09"), ("MACHINERY", "PV09"))
BILL_TYPE_CYCLE = ("YB3D", "YG2W", "YF2D", "YRED", "YL2W", "YB4D", "YB1D", "YS1D", "YL2D", "ZF2")
RATE_CYCLE = ("0.5", "1.25", "10.731234567", "2.5", "3", "5", "0.000812345", "10")
# Parts of a unit added by line number: amounts with 3 and 9 decimals, quantities with 4 and 9.
AMOUNT_PART = ("0", "0.005", "0", "0.000000001", "0", "0.015", "0.123456789")
QUANTITY_PART = ("0", "0", "0.0004", "0", "0.000000005", "0", "0.5")
# Padding of account ids by key: blank, blanks, tab, none, no-break space, em space, ideographic space.
PADDING = ((" ", ""), ("", "  "), ("\t", ""), ("", ""), ("", "\u00a0"), ("\u2003", ""), ("\u3000", "\u3000"))
XREF_SOURCE_CYCLE = ("SAP-P4S-C", "SAP-PBC-C", "SAP-QBC-C", "SAP-Q4S-C", "SAP-QBC-C ")
SHIFT_MONTHS = 288
OPEN_ENDED_MONTH = date(2024, 12, 1)


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """values[index] for a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def currency_of_nation(key: Column) -> Column:
    return (F.when(key == 0, "EUR").when(key == 1, "MAD").when(key == 2, "USD")
            .otherwise(F.concat(F.lit("C"), F.lpad(key.cast("string"), 2, "0"))))


def _shifted_ymd(ts: Column) -> Column:
    return F.date_format(F.add_months(F.to_date(ts), SHIFT_MONTHS), "yyyyMMdd")


class BaseTables:
    """The given tables under ``root``, each read once and shared."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._dfs: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._dfs[name]


def _measure(column: str, parts: tuple[str, ...]) -> Column:
    """The column plus its line number's part of a unit, in full precision."""
    return (F.col(column).cast("decimal(18,2)") + _pick(F.col("l_linenumber") - 1, parts).cast("decimal(9,9)")).cast(MEASURE)


def _upper(df: DataFrame) -> DataFrame:
    """Upper-case names, as the source system writes them."""
    return df.toDF(*[c.upper() for c in df.columns])


def _lines(base: BaseTables) -> DataFrame:
    """lineitem joined to its order and customer: the common base of three fact tables."""
    li = base("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    od = base("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = base("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .join(cu, F.col("o_custkey") == cu.c_custkey))


@contextmanager
def kept_lines(spark: SparkSession, root: str) -> Iterator[None]:
    """Meanwhile the join that the three line tables start from is computed once and kept by the executors (memory,
    then disk), whoever builds them from ``root``; otherwise each table shuffles the line items again."""
    joined = _lines(BaseTables(spark, root)).persist()
    try:
        yield
    finally:
        joined.unpersist()


def _line_dims() -> list[Column]:
    seg = F.col("c_mktsegment")
    org = None
    for s, code in SALES_ORG_BY_SEGMENT:
        org = F.when(seg == s, code) if org is None else org.when(seg == s, code)
    ln = F.col("l_linenumber")
    return [
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("ship_to__0country"),
        F.when(ln == 6, F.lit(None).cast("string")).when(ln == 5, F.lit(""))
         .otherwise(F.concat(F.lit("G"), (F.col("o_custkey") % 10).cast("string"))).alias("sales_grp"),
        F.col("o_custkey").cast("string").alias("sold_to"),
        F.col("l_partkey").cast("string").alias("material"),
        F.when(ln % 2 == 0, "KG").otherwise("L").alias("base_uom"),
        _pick(F.col("c_nationkey") % 4, COMPANY_BY_NATION_MOD4).alias("comp_code"),
        org.alias("salesorg"),
        F.when(F.col("o_orderpriority") == "5-LOW", "10").otherwise("20").alias("g_cww007"),
        F.when(F.col("o_custkey") % 3 == 0, "80").otherwise("00").alias("distr_chan"),
    ]


def order_lines(base: BaseTables) -> DataFrame:
    ln, ok = F.col("l_linenumber"), F.col("l_orderkey")
    even = (ok + ln) % 2 == 0
    return _upper(_lines(base).select(
        _shifted_ymd(F.col("o_orderdate")).alias("derdato"),
        *_line_dims(),
        F.when(ok % 53 == 11, F.lit(None).cast(MEASURE))
         .otherwise(_measure("l_quantity", QUANTITY_PART)).alias("dorqtybu"),
        F.when(F.col("l_returnflag") == "R", F.when(even, "Z4RT").otherwise("ZPRE"))
         .otherwise(F.when(even, "Z4SD").otherwise("ZPVA")).alias("doc_type"),
        F.when(F.col("o_orderstatus") == "F", "C").when(F.col("o_orderstatus") == "O", "G")
         .when(ln == 3, F.lit(None).cast("string")).otherwise("I").alias("doc_number__0doc_categ"),
        F.col("o_orderpriority").alias("not_in_the_contract"),
    ))


def delivery_lines(base: BaseTables) -> DataFrame:
    return _lines(base).select(
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") >= 6), "00000000")
         .otherwise(_shifted_ymd(F.col("l_shipdate"))).alias("act_gi_dte"),
        *_line_dims(),
        _measure("l_quantity", QUANTITY_PART).alias("act_dl_qty"),
    )


def billing_lines(base: BaseTables) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    gross = _measure("l_extendedprice", AMOUNT_PART)
    return _upper(_lines(base).select(
        _shifted_ymd(F.col("l_shipdate")).alias("bill_date"),
        *_line_dims(),
        F.when(ok % 41 == 5, F.lit(None).cast("string"))
         .otherwise(currency_of_nation(F.col("c_nationkey"))).alias("doc_currcy"),
        _pick((ok + ln) % 10, BILL_TYPE_CYCLE).alias("bill_type"),
        gross.alias("subtotal_1"),
        F.round(gross * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 3)
         .cast(MEASURE).alias("netval_inv"),
        _measure("l_quantity", QUANTITY_PART).alias("bill_qty"),
        F.when((F.col("l_returnflag") == "R") & (ln == 1), "U").otherwise("M")
         .alias("bill_num__0doc_categ"),
    ))


def material_master(base: BaseTables) -> DataFrame:
    """part x 3 versions (generated per row, no join); nested like the source."""
    p = base("part").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    key, size, v = F.col("p_partkey"), F.col("p_size"), F.col("v")
    in_scope = F.col("p_type").isin("STANDARD", "PROMO", "SMALL") & ~((v == 2) & (key % 5 == 0))
    deleted = F.when((key + v) % 11 == 7, F.lit("2021-06-01 00:00:00").cast("timestamp"))
    return p.select(
        key.cast("string").alias("material_number"),
        F.when((v == 1) & (size % 2 == 0), "4S").otherwise("BC").alias("source"),
        F.struct(  # wider than the contract and in another order
            F.when(in_scope, "Crop Protection").otherwise(F.col("p_type")).alias("line_of_business"),
            F.col("p_name").alias("product_name"),
            size.alias("not_in_the_contract"),
            F.concat(F.lit("C"), (size % 7).cast("string")).alias("CROP_CODE"),
            F.concat(F.lit("BG"), (key % 3).cast("string")).alias("business_group"),
            F.concat(F.col("p_brand"), F.lit("/v"), v.cast("string")).alias("brand_name"),
        ).alias("attributes"),
        F.struct(
            F.concat(F.lit("PG"), (size % 5).cast("string")).alias("product_group"),
            F.concat(F.lit("D"), (key % 2).cast("string")).alias("division"),
        ).alias("general_data"),
        F.struct(F.date_sub(F.lit(date(2021, 1, 1)), (size * v).cast("int"))
                 .cast("timestamp").alias("time")).alias("updated"),
        F.when((key + v) % 13 == 0, F.lit(None).cast("struct<time:timestamp>"))
         .otherwise(F.struct(deleted.alias("time"))).alias("deleted"),
    )


def exchange_rates(base: BaseTables) -> DataFrame:
    """Rate rows published per order: every order adds the rates of its
    customer's currency for the order month, so the table grows with the data
    and holds many exact duplicates (which DISTINCT / rank-one must collapse).

    Five variants per (currency, month), generated per row (no join):
    k=0 month rate (xbc); k=1 a second system with a longer validity; k=2 an
    overlapping xbc rate (validity-range fan-out), open-ended for one month of
    USD; k=3 a duplicate of k=0 (or a non-EUR target); k=4 a rate that does not
    start on the 1st. Currencies with key mod 5 = 4 have no rate at all.
    """
    od = base("orders").select("o_custkey", "o_orderdate")
    cu = base("customer").select("c_custkey", "c_nationkey")
    g = (od.join(cu, od.o_custkey == cu.c_custkey)
           .select(F.col("c_nationkey").alias("key"),
                   F.trunc(F.add_months(F.to_date("o_orderdate"), SHIFT_MONTHS), "MM").alias("m"))
           .withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(5)]))))
    key, m, k = F.col("key"), F.col("m"), F.col("k")
    mon = F.month(m)
    keep = ((key % 5 != 4) & ((k == 0)
            | ((k == 1) & ((key % 7 == 3) | (key == 1)))
            | ((k == 2) & ((key % 6 == 5) | (key == 2)) & (mon % 4 == 0))
            | ((k == 3) & (key % 4 == 2))
            | ((k == 4) & (key % 3 == 0))))
    end = F.last_day(m)
    valid_to = (F.when(k.isin(1, 2), F.date_add(end, 31)).otherwise(end))
    valid_to = F.when((k == 2) & (key == 2) & (m == F.lit(OPEN_ENDED_MONTH)),
                      F.lit(date(9999, 12, 31))).otherwise(valid_to)
    return g.where(keep).select(
        currency_of_nation(key).alias("from_currency_code"),
        F.when((k == 3) & (mon == 6), "USD").otherwise("EUR").alias("to_currency_code"),
        F.when(k == 4, F.date_add(m, 14)).otherwise(m).alias("valid_from_date"),
        valid_to.alias("valid_to_date"),
        _pick((key + mon + k) % 8, RATE_CYCLE).cast(RATE).alias("exchange_rate"),
        F.when(k == 1, "x4s").otherwise("xbc").alias("sap_src_sys_cd"),
    )


def account_xref(base: BaseTables) -> DataFrame:
    """customer x up to 3 copies: the padded main row, a second CRM row
    (fan-out) and an exact duplicate (removed by DISTINCT)."""
    c = (base("customer").select("c_custkey", "c_mktsegment")
         .withColumn("r", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))))
    key, r = F.col("c_custkey"), F.col("r")
    skey = key.cast("string")
    keep = (((r == 0) & (key % 9 != 8)) | ((r == 1) & (key % 5 == 0))
            | ((r == 2) & (key % 7 == 0) & (key % 9 != 8)))
    main = r != 1
    n = len(PADDING)
    padded = F.concat(_pick(key % n, tuple(a for a, _ in PADDING)), skey, _pick(key % n, tuple(b for _, b in PADDING)))
    klass = (F.when(key % 6 == 5, "RETAILER").when(key % 2 == 0, "DISTRIBUTOR ")
              .otherwise("DISTRIBUTOR"))
    return c.where(keep).select(
        F.when(main, padded).otherwise(skey).alias("opl_account_id"),
        F.when(main, klass).otherwise(F.lit("DISTRIBUTOR")).alias("opl_account_classification_code"),
        F.when(main, _pick(key % 5, XREF_SOURCE_CYCLE)).otherwise(F.lit("SAP-PBC-C"))
         .alias("opl_source_system_code"),
        F.when(main, F.concat(F.lit("CRM"), (key.cast("bigint") / 2).cast("bigint").cast("string")))
         .otherwise(F.concat(F.lit("CRM-B"), skey)).alias("crm_account_id"),
        F.when(main, F.concat(F.lit("GRP"), (key % 4).cast("string"))).otherwise(F.lit("GRPB"))
         .alias("crm_account_classification_group_code"),
        F.col("c_mktsegment").alias("crm_account_classification_code"),
    )


BUILDERS = {
    "material_master": material_master,
    "exchange_rates": exchange_rates,
    "order_lines": order_lines,
    "delivery_lines": delivery_lines,
    "billing_lines": billing_lines,
    "account_xref": account_xref,
}
