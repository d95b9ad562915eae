"""Column expressions used across the pipeline. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesfacts.schemas import NUMERIC


NUMERIC_SQL = NUMERIC.simpleString()


def numeric(c: Column | str) -> Column:
    """CAST(x AS NUMERIC)."""
    return (F.col(c) if isinstance(c, str) else c).cast(NUMERIC_SQL)


def numeric_zero() -> Column:
    return F.lit(0).cast(NUMERIC_SQL)


def typed_null(dtype: T.DataType | str) -> Column:
    """A NULL with a real type (a bare NULL would be `void`, which Parquet cannot store)."""
    return F.lit(None).cast(dtype if isinstance(dtype, str) else dtype.simpleString())


def date_lit(d: date) -> Column:
    return F.lit(d)


def parse_ymd(c: Column | str) -> Column:
    """PARSE_DATE('%Y%m%d', s); strict under ANSI mode (bad input raises)."""
    return F.to_date(F.col(c) if isinstance(c, str) else c, "yyyyMMdd")


def month_start(year: Column, month: Column) -> Column:
    """PARSE_DATE('%Y-%m-%d', year || '-' || month || '-01'); NULL if any part is NULL."""
    return F.to_date(F.concat(year, F.lit("-"), month, F.lit("-01")), "yyyy-MM-dd")


# The characters with the Unicode property White_Space, which the job's TRIM strips.
WHITESPACE = "".join(chr(c) for c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                      0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def norm_key(c: Column | str) -> Column:
    """TRIM that strips every leading/trailing whitespace character, not only
    blanks (BTRIM with an explicit set: no regex engine per row)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.btrim(col, F.lit(WHITESPACE))


def convert(amount: Column, rate: Column, op: str) -> Column:
    """amount (x|/) rate, rounded once to 9 decimals like NUMERIC arithmetic.

    Operand widths are chosen so that Spark types both results decimal(38,9),
    rounded half-up once from the exact value: decimal(28,9) * decimal(18,9) and
    decimal(29,9) / decimal(18,9). An amount with more integer digits (19 and 20)
    raises under ANSI mode.
    """
    r = rate.cast("decimal(18,9)")
    if op == "multiply":
        return (amount.cast("decimal(28,9)") * r).cast(NUMERIC_SQL)
    if op == "divide":
        return (amount.cast("decimal(29,9)") / r).cast(NUMERIC_SQL)
    raise ValueError(op)


def to_global(amount: Column, currency: Column, rate: Column, op: str) -> Column:
    """CASE currency WHEN 'EUR' THEN amount ELSE convert(amount) END.

    A NULL currency takes the ELSE branch; with no matching rate that is NULL,
    which SUM then skips.
    """
    from salesfacts.config import GLOBAL_CURRENCY

    return F.when(currency == F.lit(GLOBAL_CURRENCY), amount.cast(NUMERIC_SQL)).otherwise(
        convert(amount, rate, op))


def difference(a: Column, b: Column) -> Column:
    """a - b at 9 decimals without Spark's scale shrink."""
    return (a.cast("decimal(28,9)") - b.cast("decimal(28,9)")).cast(NUMERIC_SQL)


def safe_integer(c: Column | str) -> Column:
    """SAFE_CAST to an integer. The text is tested first, since a failing cast
    costs an exception a row."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.rlike(r"^\s*[+-]?[0-9]+\s*$"), col.try_cast("bigint"))


def classify(c: Column, patterns: tuple[tuple[str, str], ...], default: str) -> Column:
    """CASE WHEN c LIKE p1 THEN l1 WHEN c LIKE p2 THEN l2 ... ELSE default END."""
    out = None
    for pattern, label in patterns:
        out = (F.when(c.like(pattern), label) if out is None
               else out.when(c.like(pattern), label))
    return F.lit(default) if out is None else out.otherwise(default)


def season_name(year: Column) -> Column:
    from salesfacts.config import SEASON_PREFIX, SENTINEL_YEAR

    return F.concat(F.lit(SEASON_PREFIX), F.substring(F.coalesce(year, F.lit(SENTINEL_YEAR)), 3, 2))
