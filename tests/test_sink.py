from golden import golden_catalog

from salesfacts.config import NA_PBC
from salesfacts.plans.pipeline import run
from salesfacts.sources.sinks import write_sales_fact


def test_partitioned_round_trip(spark, tmp_path):
    df = run(golden_catalog(spark), NA_PBC)
    path = str(tmp_path / "fact")
    write_sales_fact(df, path)
    back = spark.read.parquet(path)
    assert back.count() == df.count() == 4
    assert {r[0] for r in back.select("calendar_month").distinct().collect()} == {2, 3}
    march = df.where("calendar_month = 3")
    write_sales_fact(march, path, only_written_months=True)     # February stays
    assert spark.read.parquet(path).count() == 4
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_sales_fact(march, path)                               # a full re-run drops the months that vanished
    assert {r[0] for r in spark.read.parquet(path).select("calendar_month").distinct().collect()} == {3}
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.partitionOverwriteMode"))


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(0, 300_000, 1, 8).select(F.lit(2020).alias("calendar_year"), F.lit(1).alias("calendar_month"),
                                                F.sha2(F.col("id").cast("string"), 256).alias("v"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    try:
        spark.conf.set(key, "2m")
        write_sales_fact(rows, str(tmp_path / "big"))
    finally:
        spark.conf.set(key, prev)
    files = list((tmp_path / "big").glob("calendar_year=2020/calendar_month=1/*.parquet"))
    assert len(files) > 2 and spark.read.parquet(str(tmp_path / "big")).count() == 300_000


def test_command_line_runs_a_preset(spark, tmp_path):
    from conftest import SF_SMALL
    from salesfacts.__main__ import main
    from salesfacts.sources.catalog import write_standins

    paths = write_standins(spark, SF_SMALL, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    main(["--preset", "na_pbc", *[a for n, p in paths.items() for a in ("--table", f"{n}={p}")],
          "--out", out, "--load-ts", "2026-01-01T00:00:00"])
    back = spark.read.parquet(out)
    assert len(back.columns) == 73 and back.count() > 0
