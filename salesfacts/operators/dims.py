"""Dimensions: the current material version and the exchange-rate relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesfacts.config import VariantConfig
from salesfacts.functions.exprs import date_lit


def top1_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1.

    Spark plans this with a partial WindowGroupLimit before the shuffle, so a
    hot key ships one row per map task, not all of its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


MATERIAL_FIELDS = (
    ("attributes.business_group", "business_group_name"),
    ("attributes.line_of_business", "line_of_business"),
    ("general_data.product_group", "product_group"),
    ("attributes.brand_name", "brand"),
    ("attributes.product_name", "product_name"),
    ("attributes.crop_code", "species_code"),
    ("general_data.division", "division_name_src"),
)


def material_filter(cfg: VariantConfig) -> Column:
    return (F.col("source").isin(*cfg.material_sources)
            & (F.col("attributes.line_of_business") == F.lit(cfg.line_of_business))
            & F.col("deleted.time").isNull())


def material_order(cfg: VariantConfig) -> list[Column]:
    """Rank order of versions; the trailing attribute columns only break ties
    the source leaves open, so that a recomputed partition picks the same row."""
    order = [F.col("source").desc_nulls_last()] if cfg.material_rank_by_source_desc else []
    order.append(F.col("updated_time").asc_nulls_first())
    order += [F.col(alias).asc_nulls_first() for _, alias in MATERIAL_FIELDS]
    if not cfg.material_rank_by_source_desc:
        order.append(F.col("source").asc_nulls_first())
    return order


def material_list(master: DataFrame, cfg: VariantConfig) -> DataFrame:
    """One row per in-scope material: filter (before ranking), rank, keep first."""
    flat = master.where(material_filter(cfg)).select(
        "material_number", "source", F.col("updated.time").alias("updated_time"),
        *[F.col(path).alias(alias) for path, alias in MATERIAL_FIELDS])
    top = top1_per_group(flat, ["material_number"], material_order(cfg))
    return top.select("material_number", "business_group_name", "line_of_business",
                      "product_group", "brand", "product_name")


def material_scope(master: DataFrame, cfg: VariantConfig) -> DataFrame:
    """The materials of ``material_list``, by its filter alone: a material is in the list if any version passes.

    One row per version: a semi-join does not mind, and a filtered scan without ranking
    or aggregate is what Spark can build a runtime Bloom filter from, where it is too
    big to broadcast. The filter then stands on the fact scans, before the daily sums.
    """
    return master.where(material_filter(cfg)).select("material_number")


def rate_filter(cfg: VariantConfig) -> Column:
    c = ((F.col("to_currency_code") == F.lit(cfg.rate_target_currency))
         & F.col("sap_src_sys_cd").isin(*cfg.rate_source_systems)
         & (F.col("valid_from_date") >= date_lit(cfg.rate_from_floor))
         & (F.dayofmonth("valid_from_date") == 1))
    if cfg.rate_from_currencies:
        c = c & F.col("from_currency_code").isin(*cfg.rate_from_currencies)
    return c


RATE_COLS = ("from_currency_code", "valid_from_date", "valid_to_date", "exchange_rate")


def fx_rates_month_start(rates: DataFrame, cfg: VariantConfig) -> DataFrame:
    """One rate per (currency, month start): the row with the earliest valid-to."""
    r = rates.where(rate_filter(cfg)).select(*RATE_COLS)
    return top1_per_group(r, ["from_currency_code", "valid_from_date"],
                          [F.col("valid_to_date").asc_nulls_first(),
                           F.col("exchange_rate").asc_nulls_first()])


def fx_rates_validity(rates: DataFrame, cfg: VariantConfig) -> DataFrame:
    """Distinct (currency, from, to, rate); overlapping validities stay (fan-out)."""
    return rates.where(rate_filter(cfg)).select(*RATE_COLS).distinct()


def first_month(valid_from: Column) -> Column:
    """The first month start on or after a date."""
    return F.when(F.dayofmonth(valid_from) == 1, valid_from).otherwise(F.add_months(F.trunc(valid_from, "MM"), 1))


def _month_spans(rates: DataFrame) -> DataFrame:
    """Rates with the first and last month start that they cover; those that cover none are left out."""
    return rates.withColumns({"_first": first_month(F.col("valid_from_date")), "_last": F.trunc("valid_to_date", "MM")}).where("_first <= _last")


def rate_starts(rates: DataFrame) -> DataFrame:
    """(fx_ccy, fx_starts): per currency the sorted month starts at which its set of rates changes.

    Between two of them the set is the same, so they cut time into disjoint
    intervals, the last one without an end. Their number is bounded by the
    rates' own dates and by the calendar, however far validities reach.
    """
    spans = _month_spans(rates).select(F.col("from_currency_code").alias("fx_ccy"), F.explode(
        F.array("_first", F.add_months("_last", 1))).alias("_start"))
    return spans.groupBy("fx_ccy").agg(F.sort_array(F.collect_set("_start")).alias("fx_starts"))


def rate_intervals(rates: DataFrame, starts: DataFrame) -> DataFrame:
    """(fx_ccy, fx_start, fx_rate): the rates of each interval, named by its start."""
    spans = _month_spans(rates).join(starts, F.col("from_currency_code") == F.col("fx_ccy"))
    inside = F.filter("fx_starts", lambda s: (s >= F.col("_first")) & (s <= F.col("_last")))
    return spans.select("fx_ccy", F.explode(inside).alias("fx_start"), F.col("exchange_rate").alias("fx_rate"))


# More month starts than the calendar of Spark's dates has (to the year 9999).
_LOOKUP_BITS = 17


def interval_start(month: Column, starts: Column) -> Column:
    """The greatest of the sorted ``starts`` that is not after ``month`` (NULL if none), by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(_LOOKUP_BITS))])
    below = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(starts, n + step - 1) <= month, n + step).otherwise(n))
    return F.get(starts, below - 1)


def rate_overlaps(rates: DataFrame) -> DataFrame:
    """Data-quality view for validity-range rates: the runs of months of a
    currency that more than one rate covers, i.e. where the range join fans out
    and a fact row is summed once per rate (kept on purpose, as in the source).

    One row per run with the same number of rates (first_month, last_month,
    n_rates): a running sum over the months where a rate starts or has ended, so
    an open-ended rate costs two rows, not one for every month to come.
    """
    r = rates.select("from_currency_code", first_month(F.col("valid_from_date")).alias("first"),
                     F.trunc("valid_to_date", "MM").alias("last")).where("first <= last")
    steps = r.select("from_currency_code", F.explode(F.array(
        F.struct(F.col("first").alias("month"), F.lit(1).alias("step")),
        F.struct(F.add_months("last", 1).alias("month"), F.lit(-1).alias("step")))).alias("s"))
    net = steps.groupBy("from_currency_code", "s.month").agg(F.sum("s.step").alias("step")).where("step <> 0")
    by_month = Window.partitionBy("from_currency_code").orderBy("month")
    return (net.select("from_currency_code", F.col("month").alias("first_month"),
                       F.add_months(F.lead("month").over(by_month), -1).alias("last_month"),
                       F.sum("step").over(by_month).alias("n_rates"))
               .where(F.col("n_rates") > 1))
