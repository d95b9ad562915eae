"""What the staged queries move: one join of the line items, no shuffle of finished rows, no second run of the job."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesfacts.config import NA_TEST, NAF_NONPROD
from salesfacts.plans import operator_queries as Q
from salesfacts.plans import pipeline as P
from salesfacts.plans.registry import LOAD_TS, catalog
from salesfacts.sources import months as M
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, conform, write_standins
from salesfacts.sources.standins import BUILDERS, BaseTables, kept_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_line_tables_share_one_join(spark):
    base = BaseTables(spark, SF_SMALL)
    want = {n: sorted(map(tuple, conform(BUILDERS[n](base), n).collect()), key=repr) for n in ("order_lines", "delivery_lines", "billing_lines")}
    with kept_lines(spark, SF_SMALL):
        for n, rows in want.items():
            got = conform(BUILDERS[n](BaseTables(spark, SF_SMALL)), n)
            assert "InMemoryTableScan" in _plan(got)
            assert sorted(map(tuple, got.collect()), key=repr) == rows
    assert "InMemoryTableScan" not in _plan(conform(BUILDERS["order_lines"](base), "order_lines"))


def test_written_standins_are_not_dealt_again(spark, tmp_path, monkeypatch):
    def dealt(self, *args):
        raise AssertionError("a finished table is shuffled before it is written")

    monkeypatch.setattr(type(spark.range(1)), "repartition", dealt)
    paths = write_standins(spark, SF_SMALL, str(tmp_path))
    monkeypatch.undo()
    base = BaseTables(spark, SF_SMALL)
    for n in LOGICAL_TABLES:
        row = F.to_json(F.struct("*"))
        got, want = spark.read.parquet(paths[n]).select(row), conform(BUILDERS[n](base), n).select(row)
        _same(got, want)


@pytest.mark.parametrize("cfg", [NAF_NONPROD, NA_TEST], ids=["naf_nonprod", "na_test"])
def test_a_stored_roll_up_gives_the_same_result(spark, tmp_path, cfg):
    paths = write_standins(spark, SF_SMALL, str(tmp_path / "in"))
    tables = SourceCatalog.from_paths(spark, paths)
    got = P.run(tables, cfg, LOAD_TS, store=str(tmp_path / "rollup"))
    _same(got, P.run(tables, cfg, LOAD_TS))
    assert "order_lines" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("order_lines" in f for f in got.inputFiles()) and any("rollup" in f for f in got.inputFiles())


def test_the_staged_result_runs_the_job_once(spark, monkeypatch):
    """Each of the four published tables reads stored rows; the lines are not read for it."""
    staged = []
    real = M.MonthTable.publish

    def publish(self, df, *args, **kwargs):
        staged.append(df.inputFiles())
        return real(self, df, *args, **kwargs)

    monkeypatch.setattr(M.MonthTable, "publish", publish)
    got = Q.q_result_relation_staged(spark, SF_SMALL)
    assert len(staged) == 4 and not any("lineitem" in f for files in staged for f in files)
    _same(got, P.run(catalog(spark, SF_SMALL), NA_TEST, LOAD_TS))
