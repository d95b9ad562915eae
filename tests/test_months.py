"""Month tables: all-or-none replacement, verification, pruning, clearing."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesfacts.sources import months as M
from salesfacts.sources.files import children
from salesfacts.sources.months import MonthTable, VerificationError, digest

SCHEMA = "day string, account string, amount decimal(28,9)"
MONTH = "substring(day, 1, 6)"


def _rows(spark, rows):
    return spark.createDataFrame([(d, a, None if n is None else Decimal(n)) for d, a, n in rows], SCHEMA)


def _got(table, months=None):
    return sorted((r["day"], r["account"], int(r["amount"])) for r in table.read(months).collect())


@pytest.fixture()
def table(spark, tmp_path):
    t = MonthTable(spark, str(tmp_path / "t"), sort=("day",))
    t.publish(_rows(spark, [("20200103", "a", 1), ("20200102", "b", 2), ("20200210", "a", 3), (None, "c", 4)]),
              MONTH, basis={"202001": "first"})
    return t


def test_months_are_replaced_alone(spark, table):
    assert _got(table, ["202001"]) == [("20200102", "b", 2), ("20200103", "a", 1)]
    before = table.months()
    assert {m: (e.rows, e.basis) for m, e in before.items()} == {"202001": (2, "first"), "202002": (1, ""), "none": (1, "")}
    table.publish(_rows(spark, [("20200211", "z", 9)]), MONTH, months=["202002", "202003"])
    after = table.months()
    assert after["202001"] == before["202001"] and after["202002"].rows == 1 and after["202003"] == M.Month("202003", None, 0, "0", "")
    assert _got(table, ["202002"]) == [("20200211", "z", 9)] and _got(table, ["202003"]) == [] and table.read().count() == 4
    table.publish(_rows(spark, [("20210101", "q", 7)]), MONTH)  # a full run: all other months go
    assert set(table.months()) == {"202101"} and _got(table) == [("20210101", "q", 7)]
    table.publish(_rows(spark, []), MONTH)
    assert table.months() == {} and table.read().count() == 0


def test_equal_contents_have_equal_digests(spark, table):
    before = table.months()["202001"]
    table.publish(_rows(spark, [("20200102", "b", 2), ("20200103", "a", 1)]).repartition(3), MONTH, months=["202001"])
    assert (table.months()["202001"].digest, table.months()["202001"].rows) == (before.digest, before.rows)
    assert table.months()["202001"].folder != before.folder


@pytest.mark.parametrize("how", ["write", "commit", "strange"])
def test_a_failed_run_leaves_the_old_months(spark, table, how):
    before, rows = table.months(), _got(table, ["202001", "202002"])
    bad = _rows(spark, [("20200105", "x", 5), ("20200205", "y", 6)])
    with pytest.raises(Exception):
        if how == "write":  # a task fails
            table.publish(bad.withColumn("account", F.when(F.col("day") > "20200201", F.raise_error(F.lit("lost"))).otherwise(F.col("account"))), MONTH)
        elif how == "commit":
            table.publish(bad, MONTH, before_commit=lambda: 1 / 0)
        else:
            table.publish(bad, MONTH, months=["202001"])
    assert table.months() == before and _got(table, ["202001", "202002"]) == rows
    table.publish(bad, MONTH, months=["202001", "202002"])
    assert _got(table, ["202001", "202002"]) == [("20200105", "x", 5), ("20200205", "y", 6)]


def test_what_comes_back_must_be_what_went_in(spark, table, monkeypatch):
    before = table.months()
    real = type(spark.read).parquet

    def lossy(self, *paths):
        df = real(self, *paths)
        return df.where("account <> 'x'") if "/data/" in paths[0] else df

    monkeypatch.setattr(type(spark.read), "parquet", lossy)
    with pytest.raises(VerificationError, match="went in"):
        table.publish(_rows(spark, [("20200105", "x", 5), ("20200106", "w", 5)]), MONTH, months=["202001"])
    monkeypatch.undo()
    assert table.months() == before


def test_other_columns_are_refused(spark, table):
    with pytest.raises(ValueError, match="columns differ"):
        table.publish(_rows(spark, [("20200105", "x", 5)]).withColumn("more", F.lit(1)), MONTH, months=["202001"])


def test_expire_removes_what_no_entry_names(spark, table):
    table.publish(_rows(spark, [("20200211", "z", 9)]), MONTH, months=["202002"])
    with pytest.raises(ZeroDivisionError):
        table.publish(_rows(spark, [("20200212", "f", 9)]), MONTH, months=["202002"], before_commit=lambda: 1 / 0)
    assert len(children(spark, f"{table.path}/data")) == 3
    gone = table.expire()
    assert len(gone) == 2 and all(g.endswith("month_bin=202002") for g in gone)
    assert len(children(spark, f"{table.path}/data")) == 2 and table.read().count() == 4
    assert table.expire() == []


def test_a_later_floor_skips_row_groups(spark, tmp_path):
    """The day column's statistics: the files are sorted by it, so few row groups hold days from the floor on."""
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(60_000).select(F.concat(F.lit("202001"), F.lpad((F.xxhash64("id") % 28 + 28) .cast("string"), 2, "0")).alias("day"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("account"), F.lit(1).cast("decimal(28,9)").alias("amount"))
    t = MonthTable(spark, str(tmp_path / "big"), sort=("day",))
    prev = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(128 << 10))
    try:
        t.publish(rows, F.substring("day", 1, 6))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size") if prev is None else None
    groups = [g.column(0).statistics for f in glob.glob(f"{t.path}/data/*/*/*.parquet") for g in
              [pq.ParquetFile(f).metadata.row_group(i) for i in range(pq.ParquetFile(f).metadata.num_row_groups)]]
    floor = "20200150"
    read = [s for s in groups if s.max >= floor]
    assert len(groups) > 10 and len(read) <= len(groups) * (1 - 22 / 55) + 2


def test_digest_sees_every_column_and_null(spark):
    of = lambda rows: _rows(spark, rows).agg(digest(_rows(spark, []))).first()[0]
    assert len({of([("d", "a", 1)]), of([("d", "b", 1)]), of([("d", None, 1)]), of([("d", "a", 2)]), of([("d", "a", 1)] * 2), of([])}) == 6
