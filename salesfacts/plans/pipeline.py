"""End-to-end job: six logical tables in, the 73-column monthly fact out.

The whole job is one lazy DataFrame; Catalyst sees every stage at once, pushes
each fact's filters into its scan, prunes nested columns of the material
master and picks join strategies (AQE re-plans with measured sizes).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from salesfacts.config import VariantConfig
from salesfacts.operators.dims import fx_rates_month_start, fx_rates_validity, material_list, material_scope
from salesfacts.operators.enrich import crm_enrichment
from salesfacts.operators.facts import build_facts
from salesfacts.operators.rollup import monthly_sales, unified_facts
from salesfacts.session import require_ansi
from salesfacts.sources.catalog import SourceCatalog


def rates_for(catalog: SourceCatalog, cfg: VariantConfig) -> DataFrame:
    rates = catalog.table("exchange_rates")
    if cfg.rate_match == "month_start":
        return fx_rates_month_start(rates, cfg)
    return fx_rates_validity(rates, cfg)


def facts_for(catalog: SourceCatalog, cfg: VariantConfig) -> list[DataFrame]:
    """The daily facts; returns and orders share one scan of the order lines."""
    return build_facts(catalog.table, cfg.facts, cfg, fuse=cfg.fuse_shared_scans)


def reuse_dimension(df: DataFrame, cfg: VariantConfig) -> DataFrame:
    """With ``cfg.checkpoint_dims``, compute a dimension once: a reliable
    checkpoint into the shared folder the session names in
    ``spark.checkpoint.dir`` (never a machine-local folder). The material list
    is referenced by every fact branch; a checkpoint also cuts its lineage, so a
    lost executor does not recompute it."""
    if not cfg.checkpoint_dims:
        return df
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("checkpoint_dims needs spark.checkpoint.dir set to a shared folder")
        sc.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def monthly(catalog: SourceCatalog, cfg: VariantConfig) -> DataFrame:
    """The 66-column monthly relation before CRM enrichment."""
    return monthly_sales(unified_facts(facts_for(catalog, cfg)),
                         reuse_dimension(material_list(catalog.table("material_master"), cfg), cfg),
                         reuse_dimension(rates_for(catalog, cfg), cfg), cfg,
                         scope=None if cfg.checkpoint_dims else material_scope(catalog.table("material_master"), cfg))


def run(catalog: SourceCatalog, cfg: VariantConfig, load_ts: datetime | None = None, store: str | None = None) -> DataFrame:
    """The full job. ``load_ts`` pins the two row stamps (re-runs and retried
    tasks then write identical rows); by default they are the query time.

    Needs ANSI mode, under which bad dates, overflows and division by zero raise
    instead of becoming NULL. Building it starts no Spark job (unless
    ``checkpoint_dims`` asks for one, or ``store``).

    ``store`` names a new folder: the roll-up is computed now and written there, and the
    result reads it. Then only rows that can coincide go through the DISTINCT's exchange,
    and whoever uses the result several times does not recompute the facts."""
    require_ansi(catalog.spark)
    opl = monthly(catalog, cfg)
    if store:
        opl.write.option("compression", "zstd").parquet(store)
        opl = catalog.spark.read.schema(opl.schema).parquet(store)
    return crm_enrichment(opl, catalog.table("account_xref"), cfg, load_ts, proven=bool(store))
