"""Union of the daily facts and the monthly roll-up (the 66-column relation)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.config import (DIVISION_NAME, GLOBAL_CURRENCY, SEASON_CODE, SENTINEL_DATE,
                               SENTINEL_YEAR, VariantConfig)
from salesfacts.functions.exprs import (date_lit, difference, month_start, numeric, season_name,
                                        to_global, typed_null)
from salesfacts.operators.facts import fact_constants
from salesfacts.operators.joins import attach_rate
from salesfacts.schemas import FACT_COLUMNS, FACT_KEYS, MATERIAL_ATTRS, NUMERIC


def unified_facts(facts: list[DataFrame]) -> DataFrame:
    """UNION ALL of facts that share the layout (aligned by name)."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*FACT_COLUMNS) for f in facts])


def currency_key(cfg: VariantConfig) -> Column | None:
    ccy = F.col("local_currency_code")
    if cfg.currency_group == "null_to_eur":
        return F.when(ccy.isNull(), F.lit(GLOBAL_CURRENCY)).otherwise(ccy)
    if cfg.currency_group == "raw":
        return ccy
    if cfg.currency_group == "none":
        return None
    raise ValueError(cfg.currency_group)


def _currency_out(mode: str) -> Column:
    if mode == "eur":
        return F.lit(GLOBAL_CURRENCY)
    if mode in ("null_to_eur", "raw"):
        return F.col("_ccy_key")
    raise ValueError(mode)


def monthly_sales(union: DataFrame, materials: DataFrame, rates: DataFrame,
                  cfg: VariantConfig, scope: DataFrame | None = None) -> DataFrame:
    """Join materials (inner) and rates (left), then SUM by month.

    Groups are formed on the raw key columns; the output shows them coalesced,
    so a NULL group and an '' group stay two rows (as in the source).

    The material list has one row per material, so its attributes are a
    function of ``material_number``: grouping by them adds nothing. Facts are
    therefore filtered by a semi-join before the aggregate and the attributes
    are joined to the (much smaller) monthly result, which keeps five strings
    out of the shuffled group key.

    The semi-join's key is an expression of ``material_number``, so that its
    partitioning does not also serve the roll-up: the roll-up gets its own
    exchange on all its keys after a partial aggregation, and a best-seller's
    lines do not meet in the one task of its material.

    ``scope`` names the same materials as the list in a form that is cheaper to
    filter by (``dims.material_scope``).
    """
    # The variant's literal layout columns are left out of the group key (a
    # constant does not split groups; Catalyst cannot see that through the
    # UNION) and added back after the aggregate.
    consts = fact_constants(cfg)
    in_scope = (materials if scope is None else scope).select(F.concat("material_number", F.lit("")).alias("_scope"))
    f = union.drop(*consts)
    f = f.join(in_scope, F.concat(f["material_number"], F.lit("")) == in_scope["_scope"], "left_semi")
    f = f.withColumn("month_start", month_start(F.col("calendar_year"), F.col("calendar_month")))
    f = attach_rate(f, rates, cfg)

    ccy, rate = F.col("local_currency_code"), F.col("fx_rate")
    key = currency_key(cfg)
    if key is not None:
        f = f.withColumn("_ccy_key", key)
    group = [*[k for k in (*FACT_KEYS, "invoice_date") if k not in consts],
             *(["_ccy_key"] if key is not None else []), "material_number", "local_uom"]

    def conv(col: str) -> Column:
        return to_global(F.col(col), ccy, rate, cfg.conversion)

    local = conv if cfg.convert_local_amounts else (lambda c: F.col(c))
    g = f.groupBy(*group).agg(
        F.max("first_order_date").alias("first_order_date"),
        numeric(F.sum(local("gross_sales_amount_local"))).alias("gross_sales_amount_local"),
        numeric(F.sum(conv("gross_sales_amount_local"))).alias("gross_sales_amount_global"),
        numeric(F.sum(local("net_sales_amount_local"))).alias("net_sales_amount_local"),
        numeric(F.sum(conv("net_sales_amount_local"))).alias("net_sales_amount_global"),
        numeric(F.sum("net_sales_quantity_local")).alias("net_sales_quantity_local"),
        numeric(F.sum(difference(F.col("total_order_quantity_local"), F.col("shipped_quantity_local"))))
        .alias("open_order_quantity_local"),
        numeric(F.sum("return_quantity_local")).alias("return_quantity_local"),
        numeric(F.sum("shipped_quantity_local")).alias("shipped_quantity_local"),
        numeric(F.sum("total_order_quantity_local")).alias("total_order_quantity_local"),
    ).join(materials, "material_number", "inner").select(
        "*", *[c.alias(n) for n, c in consts.items()])

    def co(c: str, d: str = "") -> Column:
        return F.coalesce(F.col(c), F.lit(d))

    uom = F.col("local_uom")
    null_d, null_s = typed_null(NUMERIC), typed_null("string")
    return g.select(
        co("source_system_code").alias("source_system_code"),
        co("calendar_year", SENTINEL_YEAR).alias("calendar_year"),
        co("calendar_month").alias("calendar_month"),
        co("country_code").alias("country_code"),
        co("position_level_1_code").alias("position_level_1_code"),
        co("operational_account_identifier_1").alias("opl_account_id"),
        co("operational_account_identifier_1_source_system_code").alias("opl_account_source_system_code"),
        co("operational_account_identifier_1_classification_code").alias("opl_account_classification_code"),
        co("direct_indirect_indicator").alias("direct_indirect_indicator"),
        F.coalesce(F.col("invoice_date"), date_lit(SENTINEL_DATE)).alias("invoice_date"),
        co("material_number").alias("material_number"),
        F.col("first_order_date"),
        co("calendar_year", SENTINEL_YEAR).alias("selling_season"),
        F.lit(SEASON_CODE).alias("season_code"),
        season_name(F.col("calendar_year")).alias("season_name"),
        F.lit(DIVISION_NAME).alias("division_name"),
        *[F.col(a) for a in MATERIAL_ATTRS],
        F.col("gross_sales_amount_local"),
        _currency_out(cfg.gross_local_currency).alias("gross_sales_amount_local_currency_code"),
        F.col("gross_sales_amount_global"),
        F.lit(GLOBAL_CURRENCY).alias("gross_sales_amount_global_currency_code"),
        F.col("net_sales_amount_local"),
        _currency_out(cfg.net_local_currency).alias("net_sales_amount_local_currency_code"),
        F.col("net_sales_amount_global"),
        _currency_out(cfg.net_global_currency).alias("net_sales_amount_global_currency_code"),
        F.col("net_sales_quantity_local"),
        uom.alias("net_sales_quantity_local_unit_of_measure_code"),
        null_d.alias("net_sales_quantity_global"),
        null_s.alias("net_sales_quantity_global_unit_of_measure_code"),
        *[c for stem in ("forecasted_sales_amount", "forecasted_gross_profit_amount")
          for c in (null_d.alias(f"{stem}_local"), null_s.alias(f"{stem}_local_currency_code"),
                    null_d.alias(f"{stem}_global"), null_s.alias(f"{stem}_global_currency_code"))],
        *[c for stem in ("open_order_quantity", "return_quantity", "shipped_quantity",
                         "total_order_quantity")
          for c in (F.col(f"{stem}_local"), uom.alias(f"{stem}_local_unit_of_measure_code"),
                    null_d.alias(f"{stem}_global"), null_s.alias(f"{stem}_global_unit_of_measure_code"))],
        typed_null("bigint").alias("international_article_number"),
        *[c for stem in ("net_price_amount", "budget_price_amount")
          for c in (null_d.alias(f"{stem}_local"), null_s.alias(f"{stem}_local_currency_code"),
                    null_d.alias(f"{stem}_global"), null_s.alias(f"{stem}_global_currency_code"))],
    )
