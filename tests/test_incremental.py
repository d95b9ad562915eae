"""The monthly state: only changed months are read, and every refresh equals a full run."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesfacts.config import NA_PBC, NAF_PROD
from salesfacts.plans import incremental as I
from salesfacts.plans import pipeline as P
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, write_standins


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    return SourceCatalog.from_paths(spark, write_standins(spark, SF_SMALL, str(tmp_path_factory.mktemp("in"))))


def _with(catalog, **tables):
    return SourceCatalog(catalog.spark, {n: (lambda d=tables.get(n, catalog.table(n)): d) for n in LOGICAL_TABLES})


def _same(a, b):
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_each_change_reads_its_months_only(spark, catalog, tmp_path):
    cfg = NA_PBC
    lines = I.publish_lines(catalog, str(tmp_path / "lines"))
    state = str(tmp_path / "state")
    months = sorted(m for m in lines["billing_lines"].months() if m >= "202001")
    first = I.refresh(catalog, lines, cfg, state)
    assert set(months) <= set(first.lines_read) and min(first.lines_read) >= "202001"
    _same(first.monthly, P.monthly(catalog, cfg))
    again = I.refresh(catalog, lines, cfg, state)
    assert (again.lines_read, again.rolled_up) == ([], [])

    # lines of one month change in one table, those of another month go in all
    changed, gone = months[5], months[8]
    bills = catalog.table("billing_lines")
    tables = {n: catalog.table(n).where(F.coalesce(I.line_month(n) != gone, F.lit(True))) for n in I.LINE_DAYS}
    tables["billing_lines"] = tables["billing_lines"].where(F.coalesce(~((I.line_month("billing_lines") == changed) & (bills.bill_qty > 20)), F.lit(True)))
    other = _with(catalog, **tables)
    I.publish_lines(other, str(tmp_path / "lines"), months=[changed, gone])
    done = I.refresh(other, lines, cfg, state)
    assert done.lines_read == sorted([changed, gone]) and set(done.rolled_up) <= {changed, gone}
    _same(done.monthly, P.monthly(other, cfg))

    # one rate changes: no line is read, and only the months that it covers are rolled up
    ccy = "MAD"
    rates = catalog.table("exchange_rates")
    day = F.to_date(F.concat(F.lit(changed), F.lit("01")), "yyyyMMdd")
    new = rates.withColumn("exchange_rate", F.when((F.col("from_currency_code") == ccy) & (F.col("valid_from_date") == day), F.lit(3).cast("decimal(28,9)"))
                           .otherwise(F.col("exchange_rate")).cast(rates.schema["exchange_rate"].dataType))
    rated = _with(other, exchange_rates=new, **tables)
    done = I.refresh(rated, lines, cfg, state)
    assert done.lines_read == [] and done.rolled_up and set(done.rolled_up) <= set(months[5:8])
    _same(done.monthly, P.monthly(rated, cfg))

    # the material list changes: all months are rolled up, again from the daily facts
    fewer = _with(rated, exchange_rates=new, material_master=catalog.table("material_master").where("material_number NOT LIKE '1%'"), **tables)
    done = I.refresh(fewer, lines, cfg, state)
    assert done.lines_read == [] and len(done.rolled_up) > len(months) // 2
    _same(done.monthly, P.monthly(fewer, cfg))


def test_a_refresh_that_fails_between_the_tables_is_made_good(spark, catalog, tmp_path, monkeypatch):
    lines = I.publish_lines(catalog, str(tmp_path / "lines"))
    state = str(tmp_path / "state")
    with monkeypatch.context() as m:
        m.setattr(I, "monthly_sales", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.refresh(catalog, lines, NA_PBC, state)
    done = I.refresh(catalog, lines, NA_PBC, state)
    assert done.lines_read == [] and done.rolled_up
    _same(done.monthly, P.monthly(catalog, NA_PBC))


def test_only_the_changed_months_files_are_in_the_plan(spark, catalog, tmp_path):
    lines = I.publish_lines(catalog, str(tmp_path / "lines"))
    month = sorted(m for m in lines["order_lines"].months() if m >= "202001")[2]
    files = lines["order_lines"].read([month]).inputFiles()
    assert files and all(f"month_bin={month}/" in f for f in files)
    assert lines["order_lines"].read([month]).where(F.substring("derdato", 1, 6) != month).count() == 0


def test_the_result_from_the_state(spark, catalog, tmp_path):
    from salesfacts.plans.registry import LOAD_TS

    lines = I.publish_lines(catalog, str(tmp_path / "lines"))
    got = I.refreshed_result(catalog, lines, NAF_PROD, str(tmp_path / "state"), LOAD_TS)
    _same(got, P.run(catalog, NAF_PROD, LOAD_TS))
