"""DISTINCT by key proof: the same rows as DISTINCT over everything, with a shuffle for the doubtful rows only."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesfacts.config import NA_P4S, NA_PBC, NA_TEST, NAF_PROD
from salesfacts.operators.enrich import crm_enrichment, may_coincide
from salesfacts.plans import pipeline as P
from salesfacts.plans.registry import LOAD_TS
from salesfacts.sources.catalog import SourceCatalog, write_standins


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    return SourceCatalog.from_paths(spark, write_standins(spark, SF_SMALL, str(tmp_path_factory.mktemp("in"))))


@pytest.fixture(scope="module")
def stored(spark, catalog, tmp_path_factory):
    """The roll-up of each preset, with twins of some rows: one group with NULL keys and one with '' that sum up alike print the same."""
    out = {}
    for cfg in (NAF_PROD, NA_P4S, NA_TEST):
        path = str(tmp_path_factory.mktemp("opl") / cfg.name)
        rows = P.monthly(catalog, cfg)
        rows.union(rows.where("position_level_1_code = ''")).write.parquet(path)
        out[cfg.name] = spark.read.parquet(path)
    return out


@pytest.mark.parametrize("cfg", [NAF_PROD, NA_P4S, NA_TEST], ids=lambda c: c.name)
def test_same_rows_as_distinct_over_all(catalog, stored, cfg):
    xref = catalog.table("account_xref")
    opl = stored[cfg.name]
    xref = xref.union(xref).union(xref.withColumn("opl_source_system_code", F.concat("opl_source_system_code", F.lit("x"))))  # rows that print alike
    proven, plain = (crm_enrichment(opl, xref, cfg, LOAD_TS, proven=p) for p in (True, False))
    assert proven.count() == plain.count() > 0
    assert proven.exceptAll(plain).count() == 0
    assert 0 < opl.where(may_coincide(cfg)).count() < opl.count()


def _exchanges(df):
    """Exchanges on the output columns in the plan that ran."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [ln for ln in plan.splitlines() if "hashpartitioning(" in ln and "calendar_month" in ln]


def test_one_exchange_less(catalog, stored):
    """Rows without doubt have no exchange on the output columns; it is there for the others, and for all without the proof."""
    opl, xref = stored["na_test"], catalog.table("account_xref")
    doubt = may_coincide(NA_TEST)
    assert len(_exchanges(crm_enrichment(opl, xref, NA_TEST, LOAD_TS))) == 1
    assert len(_exchanges(crm_enrichment(opl, xref, NA_TEST, LOAD_TS, proven=True))) == 1
    assert len(_exchanges(crm_enrichment(opl.where(doubt), xref, NA_TEST, LOAD_TS, proven=True))) == 1
    sure = opl.where(~doubt)
    assert len(_exchanges(crm_enrichment(sure, xref, NA_TEST, LOAD_TS))) == 1
    assert _exchanges(crm_enrichment(sure, xref, NA_TEST, LOAD_TS, proven=True)) == []


@pytest.mark.parametrize("column,value", [("country_code", ""), ("opl_account_id", ""), ("calendar_year", "1900"), ("calendar_month", "3"), ("calendar_year", " 2020"), ("calendar_month", None)])
def test_every_doubtful_key_is_found(stored, column, value):
    opl = stored["na_test"].where(~may_coincide(NA_TEST)).limit(3)
    assert opl.withColumn(column, F.lit(value).cast("string")).where(may_coincide(NA_TEST)).count() == 3


def test_a_currency_that_is_not_printed_leaves_all_in_doubt(stored):
    hidden = NA_PBC.with_(gross_local_currency="eur", net_local_currency="eur", net_global_currency="eur")
    opl = stored["na_test"]
    assert opl.where(may_coincide(hidden)).count() == opl.count()
