"""The interval join against a brute-force BETWEEN join on random data."""

import random
from datetime import date, timedelta
from decimal import Decimal
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salesfacts.config import NA_PBC
from salesfacts.operators.dims import rate_intervals, rate_starts
from salesfacts.operators.joins import attach_rate


def _month(y, m):
    return date(y, m, 1)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    ccys = ["EUR", "USD", "MAD", "C05", None]
    rates = []
    for _ in range(300):
        c = rnd.choice(ccys[:-1])
        start = date(2019, 1, 1) + timedelta(days=rnd.randrange(0, 3000))
        kind = rnd.random()
        if kind < 0.1:
            end = date(9999, 12, 31)                         # open-ended
        elif kind < 0.15:
            end = start                                      # one day
        elif kind < 0.2:
            end = start - timedelta(days=rnd.randrange(1, 40))   # reversed: matches nothing
        else:
            end = start + timedelta(days=rnd.randrange(0, 400))
        rates.append((c, start, end, Decimal(rnd.choice(["0.5", "1.25", "2", "8"]))))
    facts = [(i, rnd.choice(ccys), _month(rnd.randrange(2018, 2029), rnd.randrange(1, 13)))
             for i in range(600)]
    r = spark.createDataFrame(rates, "from_currency_code string, valid_from_date date, "
                                     "valid_to_date date, exchange_rate decimal(18,9)")
    f = spark.createDataFrame(facts, "id int, local_currency_code string, month_start date")
    return f, r


def _brute(f, r):
    j = f.join(r, (f.local_currency_code == r.from_currency_code)
               & f.month_start.between(r.valid_from_date, r.valid_to_date), "left")
    return j.select("id", F.col("exchange_rate").alias("fx_rate"))


def _facts(f):
    return (f.withColumn("operational_account_identifier_1", F.lit("A"))
             .withColumn("material_number", F.col("id").cast("string")).withColumn("calendar_month", F.lit("01")))


def _same(got, want):
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("later", [0, 30, 1200], ids=["now", "past the last rates", "next century"])
def test_interval_join_equals_brute_force(data, later):
    f, r = data
    f = f.withColumn("month_start", F.add_months("month_start", later))
    _same(attach_rate(_facts(f), r, NA_PBC).select("id", "fx_rate"), _brute(f, r))


def test_interval_join_of_rates_to_the_end_of_the_calendar(spark):
    """Months far beyond any rate's start, reversed and one-day validities, a currency without rates, no rates at all."""
    d = date
    rates = [("USD", d(1999, 12, 31), d(9999, 12, 31), D("2")), ("USD", d(2041, 5, 1), d(2960, 1, 1), D("3")), ("USD", d(2041, 5, 2), d(2041, 5, 31), D("9")),
             ("MAD", d(2020, 2, 1), d(2020, 2, 1), D("5")), ("MAD", d(2020, 3, 1), d(2020, 2, 1), D("7")), ("MAD", d(2020, 4, 1), None, D("8")),
             ("EUR", d(9999, 12, 1), d(9999, 12, 31), D("1"))]
    months = [d(1999, 12, 1), d(2000, 1, 1), d(2020, 2, 1), d(2020, 3, 1), d(2041, 5, 1), d(2041, 6, 1), d(2960, 1, 1), d(2960, 2, 1), d(9999, 11, 1), d(9999, 12, 1)]
    facts = [(i * 10 + j, c, m) for i, c in enumerate(["USD", "MAD", "EUR", "XXX", None]) for j, m in enumerate(months)]
    r = spark.createDataFrame(rates, "from_currency_code string, valid_from_date date, valid_to_date date, exchange_rate decimal(18,9)")
    f = spark.createDataFrame(facts, "id int, local_currency_code string, month_start date")
    _same(attach_rate(_facts(f), r, NA_PBC).select("id", "fx_rate"), _brute(f, r))
    _same(attach_rate(_facts(f), r.where("false"), NA_PBC).select("id", "fx_rate"), _brute(f, r.where("false")))


def test_many_open_ended_rates_of_one_currency_stay_small(spark):
    """Monthly rates of one hot currency up to the year 2300, read by facts of these months: as many rows as true matches."""
    months = [date(2041 + i // 12, i % 12 + 1, 1) for i in range(3000)]
    r = spark.createDataFrame([("USD", m, (m + timedelta(days=40)).replace(day=1) - timedelta(days=1), D(1)) for m in months],
                              "from_currency_code string, valid_from_date date, valid_to_date date, exchange_rate decimal(18,9)")
    starts = rate_starts(r)
    assert [len(x["fx_starts"]) for x in starts.collect()] == [3001]
    assert rate_intervals(r, starts).count() == 3000
    f = spark.createDataFrame([(i, "USD", m) for i, m in enumerate(months)], "id int, local_currency_code string, month_start date")
    got = attach_rate(_facts(f), r, NA_PBC)
    assert got.count() == got.where("fx_rate IS NOT NULL").count() == 3000
