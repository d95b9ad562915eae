"""The four daily facts, built from one generic spec-driven builder."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.config import (ACCOUNT_CLASSIFICATION, DIRECT_INDICATOR, SENTINEL_DATE, FactSpec,
                               Measure, VariantConfig)
from salesfacts.functions.exprs import date_lit, numeric, numeric_zero, parse_ymd, typed_null
from salesfacts.schemas import FACT_COLUMNS, FACT_MEASURES

DIM_COLS = ("ship_to__0country", "sales_grp", "sold_to", "material")


def fact_predicate(spec: FactSpec) -> Column:
    """The spec's WHERE clause. Every term is a simple comparison on a source
    column, so all of them reach the Parquet scan as pushed filters."""
    preds = [F.col(c) == F.lit(v) for c, v in spec.eq]
    preds += [F.col(c).isin(*vs) for c, vs in spec.isin]
    preds += [~F.col(c).isin(*vs) for c, vs in spec.not_in]   # NULL -> row dropped
    preds += [F.col(c) != F.lit(v) for c, v in spec.ne]       # NULL -> row dropped
    preds.append(F.col(spec.date_col) >= F.lit(spec.date_floor))
    return reduce(and_, preds)


def measure_expr(m: Measure) -> Column:
    v = F.col(m.source_col)
    if m.only_types is not None:
        v = F.when(F.col(m.type_col).isin(*m.only_types), v).otherwise(F.lit(0))
    return F.sum(v)


def daily_keys(spec: FactSpec) -> list[str]:
    keys = [spec.date_col, *DIM_COLS]
    if spec.currency_col:
        keys.append(spec.currency_col)
    return keys + ["base_uom"]


def aggregate_daily(lines: DataFrame, spec: FactSpec) -> DataFrame:
    """Filter, then SUM by day and the account/material keys (partial + final
    hash aggregate: a hot key is combined map-side before the shuffle)."""
    return (lines.where(fact_predicate(spec))
                 .groupBy(*daily_keys(spec))
                 .agg(*[measure_expr(m).alias(m.target) for m in spec.measures]))


def fact_constants(cfg: VariantConfig) -> dict[str, Column]:
    """Layout columns that every fact of a variant fills with the same literal."""
    return {
        "source_system_code": F.lit(cfg.source_system_label),
        "operational_account_identifier_1_source_system_code": F.lit(cfg.account_source_label),
        "operational_account_identifier_1_classification_code": F.lit(ACCOUNT_CLASSIFICATION),
        "direct_indirect_indicator": F.lit(DIRECT_INDICATOR),
        "invoice_date": date_lit(SENTINEL_DATE),
    }


def _layout(daily: DataFrame, spec: FactSpec, cfg: VariantConfig, first_order_date: Column,
            measures: dict[str, Column]) -> DataFrame:
    """Project a daily aggregate onto the 20-column layout shared by all facts."""
    day = F.col(spec.date_col)
    cols = {
        **fact_constants(cfg),
        "calendar_month": F.substring(day, 5, 2),
        "calendar_year": F.substring(day, 1, 4),
        "country_code": F.col("ship_to__0country"),
        "position_level_1_code": F.col("sales_grp"),
        "operational_account_identifier_1": F.col("sold_to"),
        "first_order_date": first_order_date,
        "material_number": F.col("material"),
        "local_currency_code": F.col(spec.currency_col) if spec.currency_col else typed_null("string"),
        "local_uom": F.col("base_uom"),
        **{m: measures.get(m, numeric_zero()) for m in FACT_MEASURES},
    }
    return daily.select(*[cols[c].alias(c) for c in FACT_COLUMNS])


def to_layout(daily: DataFrame, spec: FactSpec, cfg: VariantConfig) -> DataFrame:
    first = parse_ymd(F.col(spec.date_col)) if spec.order_date_from_fact else date_lit(SENTINEL_DATE)
    return _layout(daily, spec, cfg, first, {m.target: numeric(m.target) for m in spec.measures})


def build_fact(lines: DataFrame, spec: FactSpec, cfg: VariantConfig) -> DataFrame:
    return to_layout(aggregate_daily(lines, spec), spec, cfg)


def _provably_disjoint(a: FactSpec, b: FactSpec) -> bool:
    """True when both specs require different values of the same column."""
    return any(ca == cb and va != vb for ca, va in a.eq for cb, vb in b.eq)


def build_facts_one_scan(lines: DataFrame, specs: list[FactSpec], cfg: VariantConfig) -> DataFrame:
    """Several facts over the same table with one scan and one shuffle.

    Each line is tagged with the fact(s) whose filter it passes; the daily
    aggregate groups by (fact, keys), so every group still holds one fact's
    lines and SUM keeps its NULL semantics. Specs whose filters are provably
    disjoint get a CASE tag; otherwise a line may feed several facts, so it is
    exploded once per matching fact. Equivalent to building each fact alone
    and unioning, but the table is read once.
    """
    keys = daily_keys(specs[0])
    assert all(daily_keys(s) == keys for s in specs), "one scan needs the same daily keys"
    preds = [fact_predicate(s) for s in specs]
    disjoint = all(_provably_disjoint(a, b) for i, a in enumerate(specs) for b in specs[i + 1:])
    if disjoint:
        tag = None
        for i, p in enumerate(preds):
            tag = F.when(p, F.lit(i)) if tag is None else tag.when(p, F.lit(i))
    else:
        tag = F.explode(F.filter(F.array(*[F.when(p, F.lit(i)) for i, p in enumerate(preds)]),
                                 lambda x: x.isNotNull()))
    tagged = lines.where(reduce(lambda a, b: a | b, preds)).withColumn("_fact", tag)

    # one SUM per distinct measure expression, shared by the facts that use it
    exprs: dict[tuple, str] = {}
    for s in specs:
        for m in s.measures:
            exprs.setdefault((m.source_col, m.only_types, m.type_col), f"_m{len(exprs)}")
    daily = tagged.groupBy("_fact", *keys).agg(*[
        measure_expr(Measure("_", src, types, tcol)).alias(name)
        for (src, types, tcol), name in exprs.items()])

    fact = F.col("_fact")
    day = F.col(specs[0].date_col)
    first_days = [i for i, s in enumerate(specs) if s.order_date_from_fact]
    owned: dict[str, Column] = {}
    for i, s in enumerate(specs):
        for m in s.measures:
            src = numeric(F.col(exprs[(m.source_col, m.only_types, m.type_col)]))
            owned[m.target] = (F.when(fact == i, src) if m.target not in owned
                               else owned[m.target].when(fact == i, src))
    first = F.when(fact.isin(*first_days), parse_ymd(day)).otherwise(date_lit(SENTINEL_DATE))
    return _layout(daily, specs[0], cfg, first, {m: c.otherwise(numeric_zero()) for m, c in owned.items()})


def build_facts(tables, specs: tuple[FactSpec, ...], cfg: VariantConfig, fuse: bool = True) -> list[DataFrame]:
    """All facts of a variant; facts sharing a source table and daily keys are
    built from one scan when ``fuse`` is set. ``tables(name)`` returns a table."""
    groups: dict[tuple, list[FactSpec]] = {}
    for s in specs:
        groups.setdefault((s.source, tuple(daily_keys(s))), []).append(s)
    out = []
    for (source, _), group in groups.items():
        if fuse and len(group) > 1:
            out.append(build_facts_one_scan(tables(source), group, cfg))
        else:
            out += [build_fact(tables(source), s, cfg) for s in group]
    return out
