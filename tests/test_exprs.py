"""Scalar semantics that must survive (decimal scale, rounding, trim, strict parsing)."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salesfacts.functions.exprs import classify, convert, month_start, norm_key, parse_ymd, to_global


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()[0]


def test_divide_keeps_nine_decimals(spark):
    v = one(spark, convert(F.lit(D("1.00")), F.lit(D("10.731234567")), "divide"))
    assert v == D("0.093185923")


def test_multiply_is_exact_then_rounded_once(spark):
    v = one(spark, convert(F.lit(D("12345678901234.99")), F.lit(D("0.123456789")), "multiply"))
    # exact product 1524157875171.51999984711, rounded half-up at 9 decimals
    assert v == D("1524157875171.519999847")


def test_round_half_away_from_zero(spark):
    assert one(spark, F.round(F.lit(D("2.345")), 2)) == D("2.35")
    assert one(spark, F.round(F.lit(D("-2.345")), 2)) == D("-2.35")


def test_null_currency_goes_to_else_branch(spark):
    amt, rate = F.lit(D("5.00")), F.lit(None).cast("decimal(18,9)")
    assert one(spark, to_global(amt, F.lit(None).cast("string"), rate, "multiply")) is None
    assert one(spark, to_global(amt, F.lit("EUR"), rate, "multiply")) == D("5.000000000")


def test_norm_key_strips_tabs_and_blanks(spark):
    assert one(spark, norm_key(F.lit("\t A1 \n"))) == "A1"
    assert one(spark, norm_key(F.lit(None).cast("string"))) is None


def test_strict_date_parse_raises(spark):
    assert one(spark, parse_ymd(F.lit("20200229"))) == date(2020, 2, 29)
    with pytest.raises(Exception):
        one(spark, parse_ymd(F.lit("2020-02-3x")))


def test_month_start_and_null(spark):
    assert one(spark, month_start(F.lit("2020"), F.lit("02"))) == date(2020, 2, 1)
    assert one(spark, month_start(F.lit(None).cast("string"), F.lit("02"))) is None


def test_classify_like_and_null(spark):
    pats = (("SAP%P4S%", "P"), ("SAP%PBC%", "B"))
    assert one(spark, classify(F.lit("SAP-PBC-C"), pats, "D")) == "B"
    assert one(spark, classify(F.lit(None).cast("string"), pats, "D")) == "D"


def test_norm_key_matches_python_strip_on_random_strings(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from salesfacts.functions.exprs import WHITESPACE

    samples = []

    @settings(max_examples=300, database=None)
    @given(st.text(alphabet=st.sampled_from(list(WHITESPACE) + list("aZ9-_ é")), max_size=12))
    def collect(s):
        samples.append(s)

    collect()
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(norm_key("s")).collect()]
    assert got == [s.strip(WHITESPACE) for s in samples]
