"""Plan shape of the flagship: no Python, no pairwise joins, filters at the scan,
rank-one pushed below the shuffle, one scan of the order lines."""


import pytest

from conftest import SF_SMALL
from salesfacts.config import NA_PBC, NAF_PROD
from salesfacts.plans.pipeline import run
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, write_standins


@pytest.fixture(scope="module")
def parquet_catalog(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("standins"))
    paths = write_standins(spark, SF_SMALL, out)
    return SourceCatalog.from_paths(spark, paths)


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated PushedFilters
    df.write.format("noop").mode("overwrite").save()   # AQE: final plan after execution
    qe = df._jdf.queryExecution()
    return spark._jvm.PythonSQLUtils.explainString(qe, "formatted")


def _final_plan(df):
    df._jdf.queryExecution().toRdd().count()   # runs this DataFrame's own plan, so that it shows what AQE did
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("cfg", [NAF_PROD, NA_PBC], ids=["month_start", "validity"])
def test_plan_shape(parquet_catalog, cfg):
    plan = _plan(run(parquet_catalog, cfg))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    assert "WindowGroupLimit" in plan
    assert "PushedFilters: [IsNotNull(derdato)" in plan or "PushedFilters: [IsNotNull(comp_code)" in plan
    order_scans = [ln for ln in plan.splitlines() if ln.startswith("Location:") and "order_lines" in ln]
    assert len(order_scans) == 1, "returns and orders must share one scan"


def test_pushed_filters_reach_billing_scan(parquet_catalog):
    plan = _plan(run(parquet_catalog, NAF_PROD))
    lines = plan.splitlines()
    i = next(k for k, ln in enumerate(lines) if ln.startswith("Location:") and "billing_lines" in ln)
    pushed = next(ln for ln in lines[i:i + 6] if ln.startswith("PushedFilters:"))
    for f in ("In(bill_type", "EqualTo(distr_chan,00)", "GreaterThanOrEqual(bill_date,20200101)"):
        assert f in pushed


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in prev.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_bloom_filter_stands_before_the_daily_sums(spark, parquet_catalog, no_broadcast):
    """Where the material list is not broadcast, each fact scan is filtered by a Bloom filter of it, below the daily aggregate."""
    from salesfacts.plans.pipeline import monthly

    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    want = monthly(parquet_catalog, NA_PBC)
    without = want._jdf.queryExecution().optimizedPlan().toString()
    assert "might_contain" not in without
    prev = spark.conf.get(key)
    spark.conf.set(key, "1")  # the test tables are below the usual size
    try:
        got = monthly(parquet_catalog, NA_PBC)
        lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
        filters = [i for i, ln in enumerate(lines) if "might_contain" in ln]
        assert len(filters) == 3
        # in the scan's own filter, beside its day, and right below the daily aggregate
        assert sorted(c for i in filters for c in ("derdato", "act_gi_dte", "bill_date") if f"isnotnull({c}" in lines[i]) == ["act_gi_dte", "bill_date", "derdato"]
        assert all("Aggregate [" in next(ln for ln in reversed(lines[:i]) if "Project" not in ln) for i in filters)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    finally:
        spark.conf.set(key, prev)


def _hot(catalog):
    """Billing lines of which 90 % have one account and one material."""
    from pyspark.sql import functions as F

    def hot(df, account, material):
        pick = F.pmod(F.xxhash64(*df.columns), F.lit(10)) < 9
        return df.withColumn("sold_to", F.when(pick, account).otherwise(F.col("sold_to"))).withColumn(
            "material", F.when(pick, material).otherwise(F.col("material")))

    tables = {n: catalog.table(n) for n in LOGICAL_TABLES}
    material = tables["material_master"].where("attributes.line_of_business = 'Crop Protection' and deleted.time is null "
                                               "and source = 'BC'").first()["material_number"]
    account = tables["billing_lines"].first()["sold_to"]
    for n in ("order_lines", "delivery_lines", "billing_lines"):
        tables[n] = hot(tables[n], account, material)
    return SourceCatalog(catalog.spark, {n: (lambda d=d: d) for n, d in tables.items()})


def test_hot_account_and_material_are_split(spark, parquet_catalog, no_broadcast):
    """90 % of the lines have one account and one material: the roll-up has its own exchange
    on all its keys, and the join with the xref splits the account."""
    from pyspark.sql import functions as F
    from salesfacts.operators.enrich import crm_enrichment
    from salesfacts.plans.pipeline import monthly

    hot = _hot(parquet_catalog)
    exchanges = [ln for ln in _final_plan(run(hot, NA_PBC)).splitlines() if "hashpartitioning(" in ln]
    assert any(all(k in ln for k in ("material_number", "position_level_1_code", "local_uom", "calendar_month")) for ln in exchanges)

    account = hot.table("billing_lines").groupBy("sold_to").count().orderBy(F.desc("count")).first()["sold_to"]
    opl = monthly(parquet_catalog, NA_PBC).withColumn("opl_account_id", F.when(
        F.pmod(F.xxhash64("material_number", "calendar_month", "calendar_year", "opl_account_id"), F.lit(10)) < 9, account)
        .otherwise(F.col("opl_account_id")))
    assert "SortMergeJoin(skew=true)" in _final_plan(crm_enrichment(opl, hot.table("account_xref"), NA_PBC))


def test_building_the_job_starts_no_spark_job(spark, parquet_catalog):
    for name in LOGICAL_TABLES:
        parquet_catalog.table(name)  # schema reads
    spark.sparkContext.setJobGroup("build", "build")
    try:
        for cfg in (NAF_PROD, NA_PBC):
            run(parquet_catalog, cfg)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_job_needs_ansi_mode(spark, parquet_catalog):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            run(parquet_catalog, NAF_PROD)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
