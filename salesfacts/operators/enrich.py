"""CRM enrichment and the 73-column output contract."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.config import (ACCOUNT_CLASSIFICATION, ACTION_TYPE, CRM_SOURCE_LABEL,
                               DIRECT_INDICATOR, DIVISION_NAME, GLOBAL_CURRENCY, SEASON_CODE,
                               SENTINEL_DATE, SENTINEL_YEAR, VariantConfig)
from salesfacts.functions.exprs import classify, norm_key
from salesfacts.operators.rollup import currency_key
from salesfacts.schemas import MONEY_COLUMNS, NUMERIC, OUTPUT_CONTRACT

XREF_COLS = ("crm_account_id", "crm_account_classification_group_code",
             "crm_account_classification_code", "opl_source_system_code")
# Output columns that are always NULL (the job reserves them for later use).
PLACEHOLDER_COLUMNS = (
    "net_sales_quantity_global", "net_sales_quantity_global_unit_of_measure_code",
    *[f"{stem}_{side}{suffix}" for stem in ("forecasted_sales_amount", "forecasted_gross_profit_amount",
                                            "net_price_amount", "budget_price_amount")
      for side in ("local", "global") for suffix in ("", "_currency_code")],
    *[f"{stem}_global{suffix}" for stem in ("open_order_quantity", "return_quantity",
                                            "shipped_quantity", "total_order_quantity")
      for suffix in ("", "_unit_of_measure_code")],
    "international_article_number",
)


def constant_columns(cfg: VariantConfig, load_ts: datetime | None) -> dict[str, Column]:
    """Columns with one value for every output row. DISTINCT runs without
    them (a constant cannot tell two rows apart) and they are added after it,
    which keeps the shuffled rows narrow."""
    stamp = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    out = {n: F.lit(None) for n in PLACEHOLDER_COLUMNS}
    out.update({
        "crm_account_source_system_code": F.lit(CRM_SOURCE_LABEL),
        "season_code": F.lit(SEASON_CODE),
        "division_name": F.lit(DIVISION_NAME),
        "gross_sales_amount_global_currency_code": F.lit(GLOBAL_CURRENCY),
        "action_type": F.lit(ACTION_TYPE),
        "row_insert_timestamp": stamp,
        "row_update_timestamp": stamp,
    })
    out.update({
        "opl_account_classification_code": F.lit(ACCOUNT_CLASSIFICATION),
        "direct_indirect_indicator": F.lit(DIRECT_INDICATOR),
        "invoice_date": F.lit(SENTINEL_DATE),
    })
    if not cfg.source_system_patterns:
        out["source_system_code"] = F.lit(cfg.source_system_label)
    if not cfg.account_source_from_xref:
        out["opl_account_source_system_code"] = F.lit(cfg.account_source_label)
    for col, mode in (("gross_sales_amount_local_currency_code", cfg.gross_local_currency),
                      ("net_sales_amount_local_currency_code", cfg.net_local_currency),
                      ("net_sales_amount_global_currency_code", cfg.net_global_currency)):
        if mode == "eur":
            out[col] = F.lit(GLOBAL_CURRENCY)
    return out


def xref_keyed(xref: DataFrame, cfg: VariantConfig) -> DataFrame:
    """The xref with its join keys normalised once, as plain columns, and the
    optional source-system restriction applied as a filter."""
    if cfg.xref_source_system is not None:
        xref = xref.where(norm_key("opl_source_system_code") == F.lit(cfg.xref_source_system))
    return xref.select(norm_key("opl_account_id").alias("_k_account"),
                       norm_key("opl_account_classification_code").alias("_k_class"),
                       *[F.col(c).alias(f"x_{c}") for c in XREF_COLS])


def _typed(name: str, dtype, expr: Column, cfg: VariantConfig) -> Column:
    t = dtype.simpleString()
    if dtype == NUMERIC and cfg.round_money and name in MONEY_COLUMNS:
        return F.round(expr.cast(t), 2).cast(t).alias(name)
    return expr.cast(t).alias(name)


def xref_printed(xref: DataFrame, cfg: VariantConfig) -> DataFrame:
    """The keyed xref as what it prints: rows equal in keys and printed values count once, since the DISTINCT
    would merge what they give. So one roll-up row meets no two xref rows that print alike."""
    source = F.col("x_opl_source_system_code")
    printed = ["x_crm_account_id", "x_crm_account_classification_group_code", "x_crm_account_classification_code"]
    if cfg.source_system_patterns:
        printed.append(classify(source, cfg.source_system_patterns, cfg.source_system_default).alias("x_label"))
    if cfg.account_source_from_xref:
        printed.append(source)
    return xref_keyed(xref, cfg).select("_k_account", "_k_class", *printed).distinct()


def may_coincide(cfg: VariantConfig) -> Column:
    """Whether another row of the roll-up can print the same as a given one.

    The roll-up has one row per raw group, and prints its keys. Two groups print the
    same keys only where NULL and '' (or the year's default) print alike, or where a
    year or month is not plain digits, so that its number is not its text. All other rows are
    distinct as they are. A currency that groups but is not printed leaves all in doubt.
    """
    printed = {cfg.gross_local_currency, cfg.net_local_currency, cfg.net_global_currency} - {"eur"}
    if currency_key(cfg) is not None and not printed:
        return F.lit(True)
    doubts = [F.col(c) == "" for c in ("country_code", "position_level_1_code", "opl_account_id", "material_number")]
    doubts += [F.col("calendar_year") == SENTINEL_YEAR, ~F.col("calendar_year").rlike("^[0-9]{4}$"), ~F.col("calendar_month").rlike("^[0-9]{2}$")]
    return F.coalesce(reduce(or_, doubts), F.lit(True))


def crm_enrichment(opl: DataFrame, xref: DataFrame, cfg: VariantConfig,
                   load_ts: datetime | None = None, proven: bool = False) -> DataFrame:
    """OPL x xref on trimmed (account, classification); one-to-many, then DISTINCT.

    ``proven``: ``opl`` is the roll-up's own relation, stored, so that reading it twice is cheap.
    Then only the rows that ``may_coincide`` go through the DISTINCT and its
    exchange; the others are distinct by their keys and leave the join as they are.
    """
    x = xref_printed(xref, cfg)
    source_expr = {
        "crm_account_id": F.col("x_crm_account_id"),
        "crm_account_classification_group_code": F.col("x_crm_account_classification_group_code"),
        "crm_account_classification": F.col("x_crm_account_classification_code"),
        "source_system_code": F.col("x_label" if cfg.source_system_patterns else "source_system_code"),
        "opl_account_source_system_code": F.col("x_opl_source_system_code" if cfg.account_source_from_xref
                                                else "opl_account_source_system_code"),
    }
    constants = constant_columns(cfg, load_ts)
    body = [_typed(n, t, source_expr.get(n, F.col(n)), cfg)
            for n, t in OUTPUT_CONTRACT if n not in constants]

    def enriched(rows: DataFrame) -> DataFrame:
        o = rows.withColumn("_k_account", norm_key("opl_account_id")).withColumn("_k_class", norm_key("opl_account_classification_code"))
        return o.join(x, ["_k_account", "_k_class"], "inner").select(*body)

    # The join keys stay out of the DISTINCT: its own exchange on the output
    # columns spreads a hot account, and lets AQE split the join before it.
    if proven:
        doubt = may_coincide(cfg)
        distinct = enriched(opl.where(~doubt)).unionByName(enriched(opl.where(doubt)).distinct())
    else:
        distinct = enriched(opl).distinct()

    renames = dict(cfg.output_renames)
    return distinct.select(*[
        (constants[n].cast(t.simpleString()) if n in constants else F.col(n)).alias(renames.get(n, n))
        for n, t in OUTPUT_CONTRACT])
