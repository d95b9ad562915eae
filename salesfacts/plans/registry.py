"""Registered queries: one per operator / composite of the blueprint.

Every query runs on Spark over stand-ins derived from the given tables (whole
tables, no sampling) and has a DuckDB twin in ``oracle_sql()`` where SQL can
express it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from salesfacts.config import NA_P4S, NA_PBC, NA_TEST, NAF_NONPROD, NAF_PROD, VariantConfig
from salesfacts.operators.dims import fx_rates_month_start, fx_rates_validity, material_list
from salesfacts.operators.facts import build_fact
from salesfacts.operators.rollup import unified_facts
from salesfacts.plans import oracle as O
from salesfacts.plans import pipeline as P
from salesfacts.sources.catalog import SourceCatalog

Query = Callable[[SparkSession, str], DataFrame]

# Fixed stamp for registered end-to-end queries, so Spark and the oracle agree
# on the two row-stamp columns.
LOAD_TS = datetime(2026, 1, 1, 0, 0, 0)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def catalog(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    return SourceCatalog.from_standins(spark, sf_dir)


# --- end-to-end variants (the five statements) ------------------------------

def _end_to_end(key: str, cfg: VariantConfig) -> None:
    register(key, O.job_sql(cfg, LOAD_TS))(
        lambda spark, sf_dir, cfg=cfg: P.run(catalog(spark, sf_dir), cfg, LOAD_TS))


_end_to_end("sales_fact_naf", NAF_PROD)
_end_to_end("sales_fact_naf_nonprod", NAF_NONPROD)
_end_to_end("sales_fact_na_p4s", NA_P4S)
_end_to_end("sales_fact_na_pbc", NA_PBC)
_end_to_end("sales_fact_na_test", NA_TEST)


# --- composites ----------------------------------------------------------------

@register("material_list", O.with_standins(O.material_list_sql(NAF_PROD)))
def q_material_list(spark, sf_dir):
    return material_list(catalog(spark, sf_dir).table("material_master"), NAF_PROD)


@register("fx_rates_month_start", O.with_standins(O.rates_sql(NAF_PROD)))
def q_fx_rates_month_start(spark, sf_dir):
    return fx_rates_month_start(catalog(spark, sf_dir).table("exchange_rates"), NAF_PROD)


@register("fx_rates_validity", O.with_standins(O.rates_sql(NA_PBC)))
def q_fx_rates_validity(spark, sf_dir):
    return fx_rates_validity(catalog(spark, sf_dir).table("exchange_rates"), NA_PBC)


def _fact(key: str, index: int, cfg: VariantConfig) -> None:
    spec = cfg.facts[index]
    register(key, O.with_standins(O.fact_sql(spec, cfg)))(
        lambda spark, sf_dir: build_fact(catalog(spark, sf_dir).table(spec.source), spec, cfg))


_fact("returns_daily", 0, NAF_PROD)
_fact("orders_daily", 1, NAF_PROD)
_fact("shipments_daily", 2, NAF_PROD)
_fact("billing_daily", 3, NAF_PROD)


@register("unified_facts", O.with_standins("SELECT * FROM gassp", O.job_ctes(NAF_PROD)))
def q_unified_facts(spark, sf_dir):
    return unified_facts(P.facts_for(catalog(spark, sf_dir), NAF_PROD))


@register("monthly_sales", O.with_standins("SELECT * FROM opl", O.job_ctes(NA_PBC)))
def q_monthly_sales(spark, sf_dir):
    return P.monthly(catalog(spark, sf_dir), NA_PBC)


@register("crm_enrichment", O.job_sql(NA_TEST.with_(name="crm_enrichment", output_renames=()), LOAD_TS))
def q_crm_enrichment(spark, sf_dir):
    return P.run(catalog(spark, sf_dir), NA_TEST.with_(name="crm_enrichment", output_renames=()), LOAD_TS)
