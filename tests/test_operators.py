"""Operator properties on the stand-in tables (sf0.001) and the golden set."""

from datetime import date

from golden import golden_catalog
from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesfacts.config import NA_PBC, NAF_PROD
from salesfacts.operators.dims import fx_rates_month_start, material_list, rate_intervals, rate_starts
from salesfacts.operators.rollup import unified_facts
from salesfacts.plans import pipeline as P
from salesfacts.sources.catalog import SourceCatalog


def test_union_keeps_row_count(spark):
    c = SourceCatalog.from_standins(spark, SF_SMALL)
    facts = P.facts_for(c, NAF_PROD)
    assert unified_facts(facts).count() == sum(f.count() for f in facts)


def test_rank_one_outputs_unique_keys(spark):
    c = SourceCatalog.from_standins(spark, SF_SMALL)
    m = material_list(c.table("material_master"), NAF_PROD)
    assert m.count() == m.select("material_number").distinct().count() > 0
    r = fx_rates_month_start(c.table("exchange_rates"), NAF_PROD)
    assert r.count() == r.select("from_currency_code", "valid_from_date").distinct().count() > 0


def test_deleted_versions_never_compete(spark):
    m = material_list(golden_catalog(spark).table("material_master"), NAF_PROD)
    assert {tuple(r) for r in m.select("material_number", "brand").collect()} == {("M1", "B1"), ("M2", "B4")}


def test_rate_intervals_are_disjoint_and_open_at_the_end(spark):
    r = golden_catalog(spark).table("exchange_rates").where("from_currency_code = 'USD'")
    starts = rate_starts(r)
    [row] = starts.selectExpr("fx_ccy", "slice(fx_starts, 1, 2) AS first_two", "size(fx_starts) AS n").collect()
    assert row.asDict() == {"fx_ccy": "USD", "first_two": [date(2020, 2, 1), date(2020, 3, 1)], "n": 3}  # and the end of the calendar
    got = {(x["fx_start"], float(x["fx_rate"])) for x in rate_intervals(r, starts).collect()}
    assert got == {(date(2020, 2, 1), 0.9), (date(2020, 3, 1), 0.9), (date(2020, 3, 1), 0.8)}


def test_monthly_local_sums_equal_daily_sums_without_fan_out(spark):
    c = SourceCatalog.from_standins(spark, SF_SMALL)
    cfg = NAF_PROD  # month-start rates: no fan-out
    facts = unified_facts(P.facts_for(c, cfg)).join(
        material_list(c.table("material_master"), cfg).select("material_number"), "material_number")
    m = P.monthly(c, cfg)
    for col in ("return_quantity_local", "shipped_quantity_local", "net_sales_amount_local"):
        assert facts.agg(F.sum(col)).first()[0] == m.agg(F.sum(col)).first()[0]


def test_all_eur_data_gives_local_equal_global(spark):
    c = golden_catalog(spark)
    m = P.monthly(c, NA_PBC).where("gross_sales_amount_local_currency_code = 'EUR'")
    rows = m.where("gross_sales_amount_local <> 0").select(
        "gross_sales_amount_local", "gross_sales_amount_global").collect()
    assert rows and all(a == b for a, b in rows)


def test_fused_scan_equals_separate_facts(spark):
    c = SourceCatalog.from_standins(spark, SF_SMALL)
    for cfg in (NAF_PROD, NA_PBC):
        fused = unified_facts(P.facts_for(c, cfg))
        apart = unified_facts(P.facts_for(c, cfg.with_(fuse_shared_scans=False)))
        assert fused.exceptAll(apart).count() == 0 and apart.exceptAll(fused).count() == 0


def test_fused_scan_with_overlapping_filters_feeds_both_facts(spark):
    from dataclasses import replace

    c = SourceCatalog.from_standins(spark, SF_SMALL)
    ret, orders = NAF_PROD.facts[0], NAF_PROD.facts[1]
    # both facts now accept the same document type, so a line feeds both
    overlap = NAF_PROD.with_(facts=(replace(ret, eq=(("doc_type", "Z4SD"),)), orders, *NAF_PROD.facts[2:]))
    fused = unified_facts(P.facts_for(c, overlap))
    apart = unified_facts(P.facts_for(c, overlap.with_(fuse_shared_scans=False)))
    assert fused.count() == apart.count() > 0
    assert fused.exceptAll(apart).count() == 0 and apart.exceptAll(fused).count() == 0


def test_rate_overlaps_flags_the_fan_out_month(spark):
    from salesfacts.operators.dims import fx_rates_validity, rate_overlaps

    r = fx_rates_validity(golden_catalog(spark).table("exchange_rates"), NA_PBC)
    # both USD rates are open-ended, so the run of months with two rates ends with the calendar
    got = {tuple(x) for x in rate_overlaps(r).collect()}
    assert got == {("USD", date(2020, 3, 1), date(9999, 12, 1), 2)}


def test_null_currency_rows_never_match_but_spread(spark):
    from salesfacts.operators.joins import null_spread_key

    df = spark.createDataFrame([(None, "A", "M1", "02"), (None, "B", "M2", "03"), ("EUR", "A", "M1", "02")],
                               "local_currency_code string, operational_account_identifier_1 string, "
                               "material_number string, calendar_month string")
    keys = [r[0] for r in df.select(null_spread_key("local_currency_code", [
        "operational_account_identifier_1", "material_number", "calendar_month"])).collect()]
    assert keys[2] == "EUR" and keys[0] != keys[1] and all(k.startswith("\u0000") for k in keys[:2])


def test_checkpointed_dimensions_give_the_same_result(spark):
    c = SourceCatalog.from_standins(spark, SF_SMALL)
    for cfg in (NAF_PROD, NA_PBC):
        a = P.monthly(c, cfg)
        b = P.monthly(c, cfg.with_(checkpoint_dims=True))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
