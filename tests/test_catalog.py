"""Binding real tables: names without case, wider and reordered records, exact numbers."""

from decimal import Decimal as D

import pytest
from golden import golden_catalog
from pyspark.sql import functions as F

from salesfacts.config import NA_PBC, NAF_PROD
from salesfacts.functions.exprs import convert, norm_key, safe_integer
from salesfacts.plans.pipeline import monthly
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, conform


def _rebound(spark, change):
    base = golden_catalog(spark)
    return SourceCatalog(spark, {n: (lambda n=n: change(n, base.table(n))) for n in LOGICAL_TABLES})


def _upper(name, df):
    return df.toDF(*[c.upper() for c in df.columns])


def _wide_and_reordered(name, df):
    if name == "material_master":
        a = F.col("attributes")
        df = df.withColumn("attributes", F.when(a.isNotNull(), F.struct(
            a["crop_code"].alias("CROP_CODE"), F.lit("x").alias("registration"), a["product_name"].alias("product_name"),
            a["brand_name"].alias("Brand_Name"), a["line_of_business"].alias("line_of_business"), a["business_group"].alias("business_group"))))
    return df.withColumn("one_more", F.lit(1)).select(*reversed([*df.columns, "one_more"]))


@pytest.mark.parametrize("change", [_upper, _wide_and_reordered], ids=["upper", "wide"])
@pytest.mark.parametrize("cfg", [NAF_PROD, NA_PBC], ids=["prod", "pbc"])
def test_other_shapes_give_the_same_rows(spark, change, cfg):
    want, got = monthly(golden_catalog(spark), cfg), monthly(_rebound(spark, change), cfg)
    assert want.count() > 0 and want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_null_record_stays_null(spark):
    df = golden_catalog(spark).table("material_master")
    wide = df.withColumn("deleted", F.when(F.col("material_number") == "M3", F.struct(F.lit("u").alias("who"), F.col("deleted.time").alias("TIME"))))
    got = {r["material_number"]: r["deleted"] for r in conform(wide, "material_master").collect()}
    assert got["M2"] is None and got["M3"][0] is not None


def test_ambiguous_and_missing_names_raise(spark):
    df = golden_catalog(spark).table("account_xref")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="ambiguous"):
            conform(df.withColumn("CRM_ACCOUNT_ID", F.lit("x")), "account_xref")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("crm_account_id"), "account_xref")


def test_wider_numbers_raise_instead_of_rounding(spark):
    df = golden_catalog(spark).table("delivery_lines")
    for kind in ("decimal(38,12)", "decimal(38,9)", "double", "string"):
        with pytest.raises(ValueError, match="wider"):
            conform(df.withColumn("act_dl_qty", F.col("act_dl_qty").cast(kind)), "delivery_lines")
    for kind in ("decimal(18,2)", "bigint", "int"):
        assert conform(df.withColumn("act_dl_qty", F.col("act_dl_qty").cast(kind)), "delivery_lines").count() > 0


def test_pruning_and_pushdown_on_wide_upper_case_files(spark, tmp_path):
    from test_plans import _plan

    base = golden_catalog(spark)
    paths = {}
    for n in LOGICAL_TABLES:
        paths[n] = str(tmp_path / n)
        _upper(n, _wide_and_reordered(n, base.table(n))).write.parquet(paths[n])
    plan = _plan(monthly(SourceCatalog.from_paths(spark, paths), NA_PBC))
    reads = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert reads and not any("registration" in ln or "ONE_MORE" in ln for ln in reads)
    assert "GreaterThanOrEqual(BILL_DATE,20200101)" in plan


def test_conversion_keeps_all_decimals(spark):
    rows = [(D("1.005"), D("2")), (D("100.005"), D("10.731234567")), (D("0.000000001"), D("0.5")), (D("-1234567890123456789.000000001"), D("1"))]
    df = spark.createDataFrame(rows, "a decimal(28,9), r decimal(18,9)")
    got = df.select(convert(F.col("a"), F.col("r"), "multiply"), convert(F.col("a"), F.col("r"), "divide")).collect()
    q = lambda x: x.quantize(D("0.000000001"), rounding="ROUND_HALF_UP")
    import decimal
    with decimal.localcontext() as ctx:
        ctx.prec = 60
        assert [tuple(g) for g in got] == [(q(a * r), q(a / r)) for a, r in rows]


def test_trim_strips_unicode_white_space_and_safe_integer(spark):
    df = spark.createDataFrame([("\u00a0A1\u3000", "12"), ("\u2003A1\t", " -7 "), ("A1", "x"), ("\u200bA1", "99999999999999999999"), (None, None)], "a string, n string")
    rows = df.select(norm_key("a"), safe_integer("n")).collect()
    assert [r[0] for r in rows] == ["A1", "A1", "A1", "\u200bA1", None]
    assert [r[1] for r in rows] == [12, -7, None, None, None]
