"""Join helpers: the two ways to attach a rate. Which side is broadcast is left
to the planner and AQE, which decide from bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.config import VariantConfig
from salesfacts.operators.dims import interval_start, rate_intervals, rate_starts

# columns that spread NULL-currency rows of the daily facts over reducers
_SPREAD = ["operational_account_identifier_1", "material_number", "calendar_month"]


def null_spread_key(key: str, spread: list[str]) -> Column:
    """The join key with NULLs replaced by a value that matches nothing.

    A NULL key never matches in an equi-join, but in a shuffled outer join all
    NULL-keyed rows hash to one reducer; order and delivery lines (no
    currency) can be a large share of the facts. Prefixing a control character
    to a hash of other columns spreads them over all reducers, stays
    deterministic (retried tasks route rows the same way) and can never equal
    a real code, so the result is unchanged.
    """
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in spread]).cast("string"))
    return F.coalesce(F.col(key), salt)


def attach_rate(facts: DataFrame, rates: DataFrame, cfg: VariantConfig) -> DataFrame:
    """LEFT JOIN the rate of each fact row's currency and month start.

    ``facts`` must carry ``local_currency_code`` and ``month_start``; the result
    adds ``fx_rate`` (NULL when no rate matches). A NULL currency never matches.
    Range matching keeps every overlapping rate (fan-out), as the source does:
    a row finds its currency's interval by an ordered lookup in the interval
    starts (one row a currency), and then the interval's rates. Any month is
    looked up alike, however late.
    """
    if cfg.rate_match == "month_start":
        r = rates.select(F.col("from_currency_code").alias("fx_ccy"),
                         F.col("valid_from_date").alias("fx_month"),
                         F.col("exchange_rate").alias("fx_rate"))
        f = facts.withColumn("fx_join_ccy", null_spread_key("local_currency_code", _SPREAD))
        cond = ((f.fx_join_ccy == r.fx_ccy) & (f.month_start == r.fx_month))
        return f.join(r, cond, "left").drop("fx_ccy", "fx_month", "fx_join_ccy")
    if cfg.rate_match == "validity":
        starts = rate_starts(rates)
        b = rate_intervals(rates, starts).withColumnRenamed("fx_ccy", "fx_of")
        f = facts.withColumn("fx_join_ccy", null_spread_key("local_currency_code", _SPREAD))
        f = f.join(starts, f.fx_join_ccy == starts.fx_ccy, "left")
        f = f.withColumn("fx_at", interval_start(F.col("month_start"), F.col("fx_starts"))).drop("fx_ccy", "fx_starts")
        return f.join(b, (f.fx_join_ccy == b.fx_of) & (f.fx_at == b.fx_start), "left").drop("fx_of", "fx_start", "fx_at", "fx_join_ccy")
    raise ValueError(cfg.rate_match)
