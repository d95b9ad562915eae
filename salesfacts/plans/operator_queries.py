"""Per-operator queries (blueprint sections 2.1-2.9).

Each one exercises a single relational operator of the job on the stand-in
tables (whole tables) and has a DuckDB twin. They are registered on import.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import date

from pyspark.sql import functions as F

from salesfacts.config import (ACCOUNT_CLASSIFICATION, DIRECT_INDICATOR, EXCLUDED_BILL_CATEGORY, EXCLUDED_DOC_CATEGORIES, GLOBAL_CURRENCY,
                               GOODS_ISSUE_SENTINEL, GROSS_BILL_TYPES, NA_P4S, NA_PBC, NA_TEST,
                               NAF_NONPROD, NAF_PROD, SEASON_CODE, SENTINEL_DATE)
from salesfacts.functions.exprs import (classify, convert, difference, month_start, norm_key,
                                        numeric, numeric_zero, parse_ymd, safe_integer, season_name, to_global,
                                        typed_null)
from salesfacts.operators.dims import (fx_rates_month_start, material_list, rate_filter,
                                       rate_overlaps, top1_per_group)
from salesfacts.operators.enrich import crm_enrichment, xref_keyed
from salesfacts.operators.facts import aggregate_daily, build_fact, daily_keys, fact_predicate
from salesfacts.operators.joins import attach_rate
from salesfacts.operators.rollup import currency_key, unified_facts
from salesfacts.plans import oracle as O
from salesfacts.plans import pipeline as P
from salesfacts.plans.registry import LOAD_TS, catalog, register
from salesfacts.plans import incremental as I
from salesfacts.session import ensure_checkpoint_dir
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, write_standins
from salesfacts.sources.months import MonthTable, VerificationError
from salesfacts.sources.profiles import bind, load_profile
from salesfacts.sources.standins import kept_lines

W = O.with_standins
q, qlist, trimws = O.q, O.qlist, O.trimws
DEC = O.DEC


def scratch(spark, name):
    """A new folder of the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def T(spark, sf, name):
    return catalog(spark, sf).table(name)


# === 2.1 scans, sources, sinks =============================================

MM_FLAT = ("material_number", "source", "attributes.business_group", "attributes.line_of_business",
           "attributes.brand_name", "attributes.product_name", "attributes.crop_code",
           "general_data.product_group", "general_data.division", "updated.time", "deleted.time")


def _like_sql(cfg) -> str:
    """The CASE of a preset's LIKE patterns on the xref's source system."""
    return ("CASE " + " ".join(f"WHEN opl_source_system_code LIKE {q(p)} THEN {q(label)}" for p, label in cfg.source_system_patterns)
            + f" ELSE {q(cfg.source_system_default)} END AS source_system_code")


def _mm_flat_name(path: str) -> str:
    return path.replace(".", "_")


register("scan_material_master",
         W("SELECT " + ", ".join(f"{p} AS {_mm_flat_name(p)}" for p in MM_FLAT) + " FROM material_master"))(
    lambda s, sf: T(s, sf, "material_master").select(
        *[F.col(p).alias(_mm_flat_name(p)) for p in MM_FLAT]))

for _name in ("exchange_rates", "order_lines", "delivery_lines", "billing_lines", "account_xref"):
    register(f"scan_{_name}" if _name != "exchange_rates" else "scan_exchange_rates",
             W(f"SELECT * FROM {_name}"))(lambda s, sf, n=_name: T(s, sf, n))


_ENVIRONMENTS = ("prod", "nonprod")


@register("env_bound_source", W("SELECT e.environment, r.* FROM result r, (SELECT unnest([" + qlist(_ENVIRONMENTS) + "]) AS environment) e",
                                {**O.job_ctes(NAF_NONPROD), "result": O.final_sql(NAF_NONPROD, LOAD_TS)}))
def q_env_bound_source(spark, sf):
    """The whole job under two environment profiles: prod binds the six tables by paths below a root, nonprod by names
    in a namespace of the session's catalog, some by path. Both give the same rows."""
    root = scratch(spark, "environments")
    paths = write_standins(spark, sf, f"{root}/tables")
    space = f"salesfacts_{os.path.basename(root).replace('-', '_')}"
    by_path = {"environment": "prod", "root": f"{root}/tables", "tables": {n: {"path": n} for n in paths}}
    by_name = {"environment": "nonprod", "catalog": "spark_catalog", "namespace": space,
               "tables": {n: f"{n}_np" if n != "account_xref" else {"path": p} for n, p in paths.items()}}
    spark.sql(f"CREATE NAMESPACE {space}")
    try:
        for n, p in paths.items():
            spark.catalog.createTable(f"{space}.{n}_np", path=p, source="parquet")
        jobs = []
        for spec in (by_path, by_name):
            file = f"{root}/{spec['environment']}.json"
            spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.text(file)
            profile = load_profile(spark, file)
            rows = P.run(bind(spark, profile), NAF_NONPROD, LOAD_TS, store=f"{root}/{profile.environment}")
            jobs.append(rows.select(F.lit(profile.environment).alias("environment"), "*"))
        return jobs[0].unionByName(jobs[1])
    finally:
        spark.sql(f"DROP NAMESPACE {space} CASCADE")  # external tables: the files stay, and the plans hold their paths


_RESULT_SQL = ("SELECT action_type, row_insert_timestamp = row_update_timestamp AS same_stamp, "
               "count(*) AS n_rows FROM result GROUP BY 1, 2")


@register("result_relation", W(_RESULT_SQL, {**O.job_ctes(NA_PBC),
                                              "result": O.final_sql(NA_PBC, LOAD_TS)}))
def q_result_relation(spark, sf):
    r = P.run(catalog(spark, sf), NA_PBC, LOAD_TS)
    return (r.groupBy("action_type",
                      (F.col("row_insert_timestamp") == F.col("row_update_timestamp")).alias("same_stamp"))
             .agg(F.count(F.lit(1)).alias("n_rows")))


@register("result_relation_staged", W(O.final_sql(NA_TEST, LOAD_TS), O.job_ctes(NA_TEST)))
def q_result_relation_staged(spark, sf):
    """All 73 columns through the staged sink: published, a run that fails before its commit, one that loses rows
    between two months and is refused, and a second good run; then read back."""
    root = scratch(spark, "result")
    with kept_lines(spark, sf):
        result = P.run(catalog(spark, sf), NA_TEST, LOAD_TS, store=f"{root}/rollup")
    table, month = MonthTable(spark, f"{root}/table", sort=("opl_account_id", "material_number")), I.result_month()
    table.publish(result, month)
    first = table.months()

    def fail():
        raise OSError("the run ends before its commit")

    half = table.read().where(F.xxhash64("opl_account_id") % 2 == 0)
    for broken, error, given in ((half, OSError, None), (half, VerificationError, sorted(first)[:-1])):
        try:
            table.publish(broken, month, months=given, before_commit=fail)
        except error:
            assert table.months() == first
        else:
            raise AssertionError("a broken run was published")
    table.publish(table.read().where(month == max(first)), month, months=[max(first)])
    table.expire()
    return table.read()


@register("agg_monthly_state", W("SELECT * FROM opl", O.job_ctes(NA_PBC)))
def q_agg_monthly_state(spark, sf):
    """The roll-up from its monthly state: lines of one month are first other ones, then corrected. The second
    refresh reads the lines of this month only and gives the rows of a full run."""
    c, root, month = catalog(spark, sf), scratch(spark, "state"), "202104"
    odd = lambda n: F.coalesce((I.line_month(n) != month) | (F.xxhash64("sold_to") % 2 == 0), F.lit(True))
    wrong = SourceCatalog(spark, {n: (lambda n=n: c.table(n).where(odd(n)) if n in I.LINE_DAYS else c.table(n)) for n in LOGICAL_TABLES})
    with kept_lines(spark, sf):
        lines = I.publish_lines(wrong, f"{root}/lines")
        I.refresh(c, lines, NA_PBC, f"{root}/state")
        I.publish_lines(c, f"{root}/lines", months=[month])
    done = I.refresh(c, lines, NA_PBC, f"{root}/state")
    if (done.lines_read, done.rolled_up) != ([month], [month]):
        raise AssertionError(f"the refresh read {done.lines_read} and rolled up {done.rolled_up}, not {month}")
    return done.monthly


# === 2.2 projections =======================================================

register("project_rename", W(
    "SELECT derdato AS fact_day, ship_to__0country AS country_code, sales_grp AS position_level_1_code, "
    "sold_to AS operational_account_identifier_1, material AS material_number, base_uom AS local_uom "
    "FROM order_lines"))(
    lambda s, sf: T(s, sf, "order_lines").select(
        F.col("derdato").alias("fact_day"), F.col("ship_to__0country").alias("country_code"),
        F.col("sales_grp").alias("position_level_1_code"),
        F.col("sold_to").alias("operational_account_identifier_1"),
        F.col("material").alias("material_number"), F.col("base_uom").alias("local_uom")))

_STRUCT_FIELDS = (("attributes.business_group", "business_group_name"),
                  ("attributes.line_of_business", "line_of_business_name"),
                  ("general_data.product_group", "product_group_name"),
                  ("attributes.brand_name", "product_brand_name"),
                  ("attributes.product_name", "product_name"),
                  ("attributes.crop_code", "species_code"),
                  ("general_data.division", "division_name"))
register("project_struct_field", W(
    "SELECT material_number, " + ", ".join(f"{p} AS {a}" for p, a in _STRUCT_FIELDS)
    + " FROM material_master"))(
    lambda s, sf: T(s, sf, "material_master").select(
        "material_number", *[F.col(p).alias(a) for p, a in _STRUCT_FIELDS]))

register("project_constant", W(
    f"SELECT material, {q(NAF_PROD.source_system_label)} AS source_system_code, "
    f"{q(NAF_PROD.account_source_label)} AS account_source_system_code, "
    f"{q(ACCOUNT_CLASSIFICATION)} AS classification_code, {q(DIRECT_INDICATOR)} AS direct_indirect_indicator, "
    f"{q(SEASON_CODE)} AS season_code, {q(GLOBAL_CURRENCY)} AS global_currency_code FROM delivery_lines"))(
    lambda s, sf: T(s, sf, "delivery_lines").select(
        "material", F.lit(NAF_PROD.source_system_label).alias("source_system_code"),
        F.lit(NAF_PROD.account_source_label).alias("account_source_system_code"),
        F.lit(ACCOUNT_CLASSIFICATION).alias("classification_code"),
        F.lit(DIRECT_INDICATOR).alias("direct_indirect_indicator"), F.lit(SEASON_CODE).alias("season_code"),
        F.lit(GLOBAL_CURRENCY).alias("global_currency_code")))

register("project_zero_measure", W(
    f"SELECT act_gi_dte, material, CAST(0 AS {DEC}) AS gross_sales_amount_local, "
    f"CAST(0 AS {DEC}) AS return_quantity_local, CAST(act_dl_qty AS {DEC}) AS shipped_quantity_local "
    "FROM delivery_lines"))(
    lambda s, sf: T(s, sf, "delivery_lines").select(
        "act_gi_dte", "material", numeric_zero().alias("gross_sales_amount_local"),
        numeric_zero().alias("return_quantity_local"),
        numeric("act_dl_qty").alias("shipped_quantity_local")))

register("project_typed_null", W(
    f"SELECT material, CAST(NULL AS {DEC}) AS net_sales_quantity_global, "
    "CAST(NULL AS VARCHAR) AS net_sales_quantity_global_unit_of_measure_code FROM billing_lines"))(
    lambda s, sf: T(s, sf, "billing_lines").select(
        "material", typed_null("decimal(38,9)").alias("net_sales_quantity_global"),
        typed_null("string").alias("net_sales_quantity_global_unit_of_measure_code")))

register("project_untyped_null", W(
    "SELECT material, CAST(NULL AS BIGINT) AS international_article_number, "
    "CAST(NULL AS VARCHAR) AS return_quantity_global_unit_of_measure_code FROM billing_lines"))(
    lambda s, sf: T(s, sf, "billing_lines").select(
        "material", typed_null("bigint").alias("international_article_number"),
        typed_null("string").alias("return_quantity_global_unit_of_measure_code")))


@register("project_star", W(O.rates_sql(NAF_PROD)))
def q_project_star(spark, sf):
    ranked = fx_rates_month_start(T(spark, sf, "exchange_rates"), NAF_PROD)
    return ranked.select("*")


@register("project_qualified_join", W(
    "SELECT g.material_number, g.calendar_year, g.calendar_month, g.local_uom, m.brand, "
    "m.product_name FROM gassp g JOIN material_list m ON g.material_number = m.material_number",
    O.job_ctes(NAF_PROD)))
def q_project_qualified_join(spark, sf):
    c = catalog(spark, sf)
    g = unified_facts(P.facts_for(c, NAF_PROD))
    m = material_list(c.table("material_master"), NAF_PROD)
    return g.join(m, "material_number").select(
        "material_number", "calendar_year", "calendar_month", "local_uom", "brand", "product_name")


_CONTRACT_CFG = NA_PBC.with_(name="pbc_rounded", round_money=True)
register("project_output_contract", O.job_sql(_CONTRACT_CFG, LOAD_TS))(
    lambda s, sf: P.run(catalog(s, sf), _CONTRACT_CFG, LOAD_TS))


# === 2.3 filters and predicates ============================================

def _filter_query(key, table, spark_pred, sql_pred, cols):
    register(key, W(f"SELECT {', '.join(cols)} FROM {table} WHERE {sql_pred}"))(
        lambda s, sf: T(s, sf, table).where(spark_pred()).select(*cols))


_OL = ("derdato", "sold_to", "material", "dorqtybu")
_filter_query("filter_eq", "order_lines", lambda: F.col("doc_type") == "Z4RT", "doc_type = 'Z4RT'", _OL)
_filter_query("filter_in_list", "order_lines",
              lambda: F.col("comp_code").isin("0085", "2926") & F.col("salesorg").isin("PC09", "EN09", "DG09"),
              "comp_code IN ('0085', '2926') AND salesorg IN ('PC09', 'EN09', 'DG09')", _OL)
_filter_query("filter_not_in_list", "order_lines",
              lambda: ~F.col("doc_number__0doc_categ").isin(*EXCLUDED_DOC_CATEGORIES),
              f"doc_number__0doc_categ NOT IN ({qlist(EXCLUDED_DOC_CATEGORIES)})", _OL)
_filter_query("filter_not_equal", "billing_lines",
              lambda: F.col("bill_num__0doc_categ") != EXCLUDED_BILL_CATEGORY,
              f"bill_num__0doc_categ <> {q(EXCLUDED_BILL_CATEGORY)}", ("bill_date", "material", "subtotal_1"))
_filter_query("filter_sentinel_date", "delivery_lines",
              lambda: F.col("act_gi_dte") != GOODS_ISSUE_SENTINEL,
              f"act_gi_dte <> {q(GOODS_ISSUE_SENTINEL)}", ("act_gi_dte", "material", "act_dl_qty"))
_filter_query("filter_compact_date_floor", "billing_lines", lambda: F.col("bill_date") >= "20200101",
              "bill_date >= '20200101'", ("bill_date", "material", "subtotal_1"))
_RC = ("from_currency_code", "valid_from_date", "valid_to_date", "exchange_rate")
_filter_query("filter_date_floor", "exchange_rates",
              lambda: F.col("valid_from_date") >= F.lit(date(2020, 1, 1)),
              "valid_from_date >= DATE '2020-01-01'", _RC)
_filter_query("filter_first_of_month", "exchange_rates", lambda: F.dayofmonth("valid_from_date") == 1,
              "day(valid_from_date) = 1", _RC)
_MC = ("material_number", "source")
_filter_query("filter_nested_eq", "material_master",
              lambda: F.col("attributes.line_of_business") == "Crop Protection",
              "attributes.line_of_business = 'Crop Protection'", _MC)
_filter_query("filter_nested_is_null", "material_master", lambda: F.col("deleted.time").isNull(),
              "deleted.time IS NULL", _MC)
_filter_query("filter_or", "exchange_rates",
              lambda: (F.col("sap_src_sys_cd") == "xbc") | (F.col("sap_src_sys_cd") == "x4s"),
              "(sap_src_sys_cd = 'xbc' OR sap_src_sys_cd = 'x4s')", _RC)
_BILL = NAF_PROD.facts[3]
_filter_query("filter_conjunction", "billing_lines", lambda: fact_predicate(_BILL),
              O.fact_where_sql(_BILL), ("bill_date", "material", "bill_type", "subtotal_1"))
_filter_query("filter_tautology", "order_lines",
              lambda: (F.lit(1) == F.lit(1)) & (F.col("doc_type") == "Z4SD"),
              "1 = 1 AND doc_type = 'Z4SD'", _OL)


@register("filter_rank_eq_one", W(O.material_list_sql(NA_P4S)))
def q_filter_rank_eq_one(spark, sf):
    return material_list(T(spark, sf, "material_master"), NA_P4S)


register("predicate_like", W(
    f"SELECT opl_source_system_code, {_like_sql(NAF_PROD)} FROM account_xref"))(
    lambda s, sf: T(s, sf, "account_xref").select(
        "opl_source_system_code",
        classify(F.col("opl_source_system_code"), NAF_PROD.source_system_patterns,
                 NAF_PROD.source_system_default).alias("source_system_code")))

register("predicate_is_null_branch", W(
    "SELECT bill_date, material, CASE WHEN doc_currcy IS NULL THEN 'EUR' ELSE doc_currcy END AS currency_code "
    "FROM billing_lines"))(
    lambda s, sf: T(s, sf, "billing_lines").select(
        "bill_date", "material",
        F.when(F.col("doc_currcy").isNull(), "EUR").otherwise(F.col("doc_currcy")).alias("currency_code")))


# === 2.4 joins =============================================================

@register("join_inner_equi", W(
    "SELECT g.*, m.business_group_name, m.line_of_business, m.product_group, m.brand, m.product_name "
    "FROM gassp g JOIN material_list m ON g.material_number = m.material_number", O.job_ctes(NAF_PROD)))
def q_join_inner_equi(spark, sf):
    c = catalog(spark, sf)
    return unified_facts(P.facts_for(c, NAF_PROD)).join(
        material_list(c.table("material_master"), NAF_PROD), "material_number", "inner")


def _rate_join_sql(cfg, fact_index, later=0):
    month = "CAST(strptime(g.calendar_year || '-' || g.calendar_month || '-01', '%Y-%m-%d') AS DATE)"
    if later:
        month = f"CAST({month} + INTERVAL {later} MONTH AS DATE)"
    on = (f"r.valid_from_date = {month}" if cfg.rate_match == "month_start"
          else f"{month} BETWEEN r.valid_from_date AND r.valid_to_date")
    return W(f"SELECT g.calendar_year, g.calendar_month, g.operational_account_identifier_1, "
             f"g.material_number, g.local_currency_code, g.gross_sales_amount_local, "
             f"r.exchange_rate AS fx_rate FROM fact g LEFT JOIN ccr r "
             f"ON r.from_currency_code = g.local_currency_code AND {on}",
             {"ccr": O.rates_sql(cfg), "fact": O.fact_sql(cfg.facts[fact_index], cfg)})


def _rate_join(spark, sf, cfg, fact_index, later=0):
    c = catalog(spark, sf)
    spec = cfg.facts[fact_index]
    f = build_fact(c.table(spec.source), spec, cfg).withColumn(
        "month_start", F.add_months(month_start(F.col("calendar_year"), F.col("calendar_month")), later))
    return attach_rate(f, P.rates_for(c, cfg), cfg).select(
        "calendar_year", "calendar_month", "operational_account_identifier_1", "material_number",
        "local_currency_code", "gross_sales_amount_local", "fx_rate")


_MONTH_RATES = NAF_PROD.with_(rate_from_currencies=None)  # all currencies, so most rows match
register("join_left_equi_computed_date", _rate_join_sql(_MONTH_RATES, 3))(
    lambda s, sf: _rate_join(s, sf, _MONTH_RATES, 3))
register("join_left_range_validity", _rate_join_sql(NA_PBC, 3))(
    lambda s, sf: _rate_join(s, sf, NA_PBC, 3))
# Facts of the next century, which only open-ended rates cover: the last interval of a currency.
register("join_left_range_overflow_bucket", _rate_join_sql(NA_PBC, 3, later=960))(
    lambda s, sf: _rate_join(s, sf, NA_PBC, 3, later=960))


_MONTH_OF_FACT = "CAST(strptime(g.calendar_year || '-' || g.calendar_month || '-01', '%Y-%m-%d') AS DATE)"
_BILLING_P4S = NA_P4S.facts[3]


@register("predicate_between", W(
    f"SELECT g.calendar_year, g.calendar_month, g.material_number, g.local_currency_code, "
    f"r.exchange_rate AS fx_rate FROM fact g JOIN ccr r ON r.from_currency_code = g.local_currency_code "
    f"AND {_MONTH_OF_FACT} BETWEEN r.valid_from_date AND r.valid_to_date",
    {"ccr": O.rates_sql(NA_P4S), "fact": O.fact_sql(_BILLING_P4S, NA_P4S)}))
def q_predicate_between(spark, sf):
    """The rate join's BETWEEN: the fact months that a rate's validity covers."""
    c = catalog(spark, sf)
    f = build_fact(c.table(_BILLING_P4S.source), _BILLING_P4S, NA_P4S).withColumn(
        "month_start", month_start(F.col("calendar_year"), F.col("calendar_month")))
    return attach_rate(f, P.rates_for(c, NA_P4S), NA_P4S).where("fx_rate IS NOT NULL").select(
        "calendar_year", "calendar_month", "material_number", "local_currency_code", "fx_rate")


@register("rate_overlaps", W(
    """SELECT from_currency_code, first_month, last_month, n_rates FROM (
  SELECT b.from_currency_code, b.m AS first_month, CAST(b.next_m - INTERVAL 1 MONTH AS DATE) AS last_month,
         (SELECT count(*) FROM ccr r WHERE r.from_currency_code = b.from_currency_code
            AND b.m BETWEEN r.valid_from_date AND r.valid_to_date) AS n_rates
  FROM (SELECT from_currency_code, m, lead(m) OVER (PARTITION BY from_currency_code ORDER BY m) AS next_m
        FROM (SELECT from_currency_code, m, sum(s) AS s FROM (
                SELECT from_currency_code, CAST(date_trunc('month', valid_from_date) AS DATE) AS m, 1 AS s FROM ccr
                UNION ALL
                SELECT from_currency_code, CASE WHEN valid_to_date >= DATE '9999-12-01' THEN DATE '10000-01-01'
                  ELSE CAST(date_trunc('month', valid_to_date) + INTERVAL 1 MONTH AS DATE) END, -1 FROM ccr)
              GROUP BY from_currency_code, m) WHERE s <> 0) b)
WHERE n_rates > 1""", {"ccr": O.rates_sql(NA_PBC)}))
def q_rate_overlaps(spark, sf):
    return rate_overlaps(P.rates_for(catalog(spark, sf), NA_PBC))


def _xref_join_sql(cfg):
    on = (f"{trimws('o.opl_account_id')} = {trimws('x.opl_account_id')} AND "
          f"{trimws('o.opl_account_classification_code')} = {trimws('x.opl_account_classification_code')}")
    if cfg.xref_source_system:
        on += f" AND {trimws('x.opl_source_system_code')} = {q(cfg.xref_source_system)}"
    return W("SELECT o.opl_account_id, o.calendar_year, o.calendar_month, o.material_number, "
             "o.net_sales_amount_local, x.crm_account_id, x.opl_source_system_code "
             f"FROM opl o JOIN account_xref x ON {on}", O.job_ctes(cfg))


def _xref_join(spark, sf, cfg):
    c = catalog(spark, sf)
    o = P.monthly(c, cfg)
    o = o.withColumn("_k_account", norm_key("opl_account_id")) \
         .withColumn("_k_class", norm_key("opl_account_classification_code"))
    j = o.join(xref_keyed(c.table("account_xref"), cfg), ["_k_account", "_k_class"])
    return j.select("opl_account_id", "calendar_year", "calendar_month", "material_number",
                    "net_sales_amount_local", F.col("x_crm_account_id").alias("crm_account_id"),
                    F.col("x_opl_source_system_code").alias("opl_source_system_code"))


register("join_inner_trimmed_keys", _xref_join_sql(NAF_PROD))(lambda s, sf: _xref_join(s, sf, NAF_PROD))
register("join_inner_trimmed_with_constant", _xref_join_sql(NA_PBC))(lambda s, sf: _xref_join(s, sf, NA_PBC))


@register("join_null_key_semantics", W(
    "SELECT g.local_currency_code IS NULL AS null_currency, r.exchange_rate IS NULL AS no_rate, "
    "count(*) AS n_rows FROM fact g LEFT JOIN ccr r ON r.from_currency_code = g.local_currency_code "
    "AND CAST(strptime(g.calendar_year || '-' || g.calendar_month || '-01', '%Y-%m-%d') AS DATE) "
    "BETWEEN r.valid_from_date AND r.valid_to_date GROUP BY 1, 2",
    {"ccr": O.rates_sql(NA_PBC), "fact": O.fact_sql(NA_PBC.facts[3], NA_PBC)}))
def q_join_null_key_semantics(spark, sf):
    j = _rate_join(spark, sf, NA_PBC, 3)
    return (j.groupBy(F.col("local_currency_code").isNull().alias("null_currency"),
                      F.col("fx_rate").isNull().alias("no_rate"))
             .agg(F.count(F.lit(1)).alias("n_rows")))


# === 2.5 aggregations ======================================================

def _daily_sql(spec):
    keys = [spec.date_col, "ship_to__0country", "sales_grp", "sold_to", "material",
            *([spec.currency_col] if spec.currency_col else []), "base_uom"]
    sums = []
    for m in spec.measures:
        v = m.source_col if m.only_types is None else \
            f"CASE WHEN {m.type_col} IN ({qlist(m.only_types)}) THEN {m.source_col} ELSE 0 END"
        sums.append(f"CAST(SUM({v}) AS {DEC}) AS {m.target}")
    return W(f"SELECT {', '.join(keys)}, {', '.join(sums)} FROM {spec.source} "
             f"WHERE {O.fact_where_sql(spec)} GROUP BY {', '.join(keys)}")


for _key, _i in (("agg_sum_returns_daily", 0), ("agg_sum_orders_daily", 1),
                 ("agg_sum_shipped_daily", 2), ("agg_conditional_sum_billing", 3)):
    _spec = NAF_PROD.facts[_i]
    register(_key, _daily_sql(_spec))(
        lambda s, sf, spec=_spec: aggregate_daily(T(s, sf, spec.source), spec).select(
            *[F.col(k) for k in daily_keys(spec)], *[numeric(m.target).alias(m.target) for m in spec.measures]))

register("agg_monthly_rollup", W("SELECT * FROM opl", O.job_ctes(NA_TEST)))(
    lambda s, sf: P.monthly(catalog(s, sf), NA_TEST))
register("agg_group_drop_key", W("SELECT * FROM opl", O.job_ctes(NA_P4S)))(
    lambda s, sf: P.monthly(catalog(s, sf), NA_P4S))


def _joined_sql(cfg):
    month = "CAST(strptime(g.calendar_year || '-' || g.calendar_month || '-01', '%Y-%m-%d') AS DATE)"
    on = (f"r.valid_from_date = {month}" if cfg.rate_match == "month_start"
          else f"{month} BETWEEN r.valid_from_date AND r.valid_to_date")
    return (f"SELECT g.*, r.exchange_rate AS fx_rate FROM gassp g "
            f"JOIN material_list m ON g.material_number = m.material_number "
            f"LEFT JOIN ccr r ON r.from_currency_code = g.local_currency_code AND {on}")


def _joined(spark, sf, cfg):
    c = catalog(spark, sf)
    f = unified_facts(P.facts_for(c, cfg)).join(
        material_list(c.table("material_master"), cfg).select("material_number"), "material_number")
    f = f.withColumn("month_start", month_start(F.col("calendar_year"), F.col("calendar_month")))
    return attach_rate(f, P.rates_for(c, cfg), cfg)


def _fx_sum(key, cfg):
    sql = W("SELECT calendar_year, calendar_month, local_currency_code, "
            f"CAST(SUM({O.convert_sql('gross_sales_amount_local', cfg)}) AS {DEC}) AS gross_sales_amount_global, "
            f"CAST(SUM({O.convert_sql('net_sales_amount_local', cfg)}) AS {DEC}) AS net_sales_amount_global "
            "FROM j GROUP BY 1, 2, 3", {**O.job_ctes(cfg), "j": _joined_sql(cfg)})

    def run(spark, sf):
        j = _joined(spark, sf, cfg)
        ccy, rate = F.col("local_currency_code"), F.col("fx_rate")
        return j.groupBy("calendar_year", "calendar_month", "local_currency_code").agg(
            numeric(F.sum(to_global(F.col("gross_sales_amount_local"), ccy, rate, cfg.conversion)))
            .alias("gross_sales_amount_global"),
            numeric(F.sum(to_global(F.col("net_sales_amount_local"), ccy, rate, cfg.conversion)))
            .alias("net_sales_amount_global"))
    register(key, sql)(run)


_fx_sum("agg_sum_fx_multiply", NA_PBC)
_fx_sum("agg_sum_fx_divide", NAF_PROD.with_(rate_from_currencies=None))


@register("agg_sum_difference", W(
    f"SELECT material_number, local_uom, CAST(SUM(CAST(total_order_quantity_local AS DECIMAL(28,9)) - "
    f"CAST(shipped_quantity_local AS DECIMAL(28,9))) AS {DEC}) AS open_order_quantity_local "
    "FROM gassp GROUP BY 1, 2", O.job_ctes(NAF_PROD)))
def q_agg_sum_difference(spark, sf):
    g = unified_facts(P.facts_for(catalog(spark, sf), NAF_PROD))
    return g.groupBy("material_number", "local_uom").agg(
        numeric(F.sum(difference(F.col("total_order_quantity_local"), F.col("shipped_quantity_local"))))
        .alias("open_order_quantity_local"))


@register("agg_max_date", W(
    "SELECT operational_account_identifier_1, MAX(first_order_date) AS first_order_date "
    "FROM gassp GROUP BY 1", O.job_ctes(NAF_PROD)))
def q_agg_max_date(spark, sf):
    g = unified_facts(P.facts_for(catalog(spark, sf), NAF_PROD))
    return g.groupBy("operational_account_identifier_1").agg(
        F.max("first_order_date").alias("first_order_date"))


@register("agg_group_by_expression", W(
    "SELECT CASE WHEN local_currency_code IS NULL THEN 'EUR' ELSE local_currency_code END AS currency_code, "
    f"CAST(SUM(gross_sales_amount_local) AS {DEC}) AS gross_sales_amount_local, "
    f"CAST(SUM(total_order_quantity_local) AS {DEC}) AS total_order_quantity_local "
    "FROM gassp GROUP BY 1", O.job_ctes(NAF_PROD)))
def q_agg_group_by_expression(spark, sf):
    g = unified_facts(P.facts_for(catalog(spark, sf), NAF_PROD))
    return g.groupBy(currency_key(NAF_PROD).alias("currency_code")).agg(
        numeric(F.sum("gross_sales_amount_local")).alias("gross_sales_amount_local"),
        numeric(F.sum("total_order_quantity_local")).alias("total_order_quantity_local"))


@register("agg_group_raw_output_coalesced", W(
    f"SELECT COALESCE(sales_grp, '') AS position_level_1_code, CAST(SUM(dorqtybu) AS {DEC}) AS total_order_quantity "
    "FROM order_lines GROUP BY sales_grp"))
def q_agg_group_raw_output_coalesced(spark, sf):
    g = T(spark, sf, "order_lines").groupBy("sales_grp").agg(numeric(F.sum("dorqtybu")).alias("total_order_quantity"))
    return g.select(F.coalesce(F.col("sales_grp"), F.lit("")).alias("position_level_1_code"),
                    "total_order_quantity")


register("distinct_projection", W(
    "SELECT DISTINCT from_currency_code, valid_from_date, valid_to_date, exchange_rate FROM exchange_rates"))(
    lambda s, sf: T(s, sf, "exchange_rates").select(*_RC).distinct())
register("distinct_xref_rows", W("SELECT DISTINCT * FROM account_xref"))(
    lambda s, sf: T(s, sf, "account_xref").distinct())


@register("distinct_rows", W(O.final_sql(NAF_PROD, LOAD_TS), O.job_ctes(NAF_PROD)))
def q_distinct_rows(spark, sf):
    """The job's DISTINCT over all 73 columns, by key proof: the stored roll-up's rows that cannot
    print alike leave the xref join as they are, and the rest is made distinct."""
    c = catalog(spark, sf)
    table = MonthTable(spark, scratch(spark, "monthly"))
    table.publish(P.monthly(c, NAF_PROD), F.concat("calendar_year", "calendar_month"))
    return crm_enrichment(table.read(), c.table("account_xref"), NAF_PROD, LOAD_TS, proven=True)



# === 2.6 windows / 2.7 top-k / 2.8 set operations ============================

register("window_latest_single_key", W(O.material_list_sql(NA_PBC)))(
    lambda s, sf: material_list(T(s, sf, "material_master"), NA_PBC))
register("window_latest_mixed_order", W(O.material_list_sql(NAF_PROD)))(
    lambda s, sf: material_list(T(s, sf, "material_master"), NAF_PROD))
_ALL_RATES = NAF_PROD.with_(rate_from_currencies=None, rate_source_systems=("xbc", "x4s"))
register("window_dedup_composite_key", W(O.rates_sql(_ALL_RATES)))(
    lambda s, sf: fx_rates_month_start(T(s, sf, "exchange_rates"), _ALL_RATES))


@register("top1_per_group", W(
    "SELECT sold_to, bill_date, material, bill_type, subtotal_1 FROM ("
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY sold_to ORDER BY bill_date DESC NULLS LAST, "
    "material ASC NULLS FIRST, bill_type ASC NULLS FIRST, subtotal_1 ASC NULLS FIRST) AS rn "
    "FROM billing_lines) WHERE rn = 1"))
def q_top1_per_group(spark, sf):
    b = T(spark, sf, "billing_lines").select("sold_to", "bill_date", "material", "bill_type", "subtotal_1")
    return top1_per_group(b, ["sold_to"], [F.col("bill_date").desc_nulls_last(),
                                           F.col("material").asc_nulls_first(),
                                           F.col("bill_type").asc_nulls_first(),
                                           F.col("subtotal_1").asc_nulls_first()])


@register("sort_in_subquery", W(O.rates_sql(NA_P4S)))
def q_sort_in_subquery(spark, sf):
    """An ORDER BY inside the CTE has no effect on a DISTINCT above it; Spark drops the sort."""
    r = T(spark, sf, "exchange_rates").where(rate_filter(NA_P4S)) \
        .orderBy("from_currency_code", "valid_from_date", "valid_to_date")
    return r.select(*_RC).distinct()


register("union_all_aligned_facts", W("SELECT * FROM gassp", O.job_ctes(NA_P4S)))(
    lambda s, sf: unified_facts(P.facts_for(catalog(s, sf), NA_P4S)))


# === 2.9 scalar functions ==================================================

def _fn(key, table, spark_cols, sql_cols):
    register(key, W(f"SELECT {sql_cols} FROM {table}"))(lambda s, sf: T(s, sf, table).select(*spark_cols()))


_fn("fn_substr_year_month", "order_lines",
    lambda: ["derdato", F.substring("derdato", 5, 2).alias("calendar_month"),
             F.substring("derdato", 1, 4).alias("calendar_year")],
    "derdato, substr(derdato, 5, 2) AS calendar_month, substr(derdato, 1, 4) AS calendar_year")
_fn("fn_season_name", "order_lines",
    lambda: ["derdato", season_name(F.substring("derdato", 1, 4)).alias("season_name")],
    "derdato, 'MY ' || substr(COALESCE(substr(derdato, 1, 4), '1900'), 3, 2) AS season_name")
_fn("fn_parse_compact_date", "order_lines",
    lambda: ["derdato", parse_ymd("derdato").alias("order_date")],
    "derdato, CAST(strptime(derdato, '%Y%m%d') AS DATE) AS order_date")
_fn("fn_parse_sentinel_date", "delivery_lines",
    lambda: ["material", F.lit(SENTINEL_DATE).alias("invoice_date")],
    "material, DATE '1900-01-01' AS invoice_date")
_fn("fn_month_start", "billing_lines",
    lambda: ["bill_date", month_start(F.substring("bill_date", 1, 4), F.substring("bill_date", 5, 2))
             .alias("month_start")],
    "bill_date, CAST(strptime(substr(bill_date, 1, 4) || '-' || substr(bill_date, 5, 2) || '-01', "
    "'%Y-%m-%d') AS DATE) AS month_start")
_fn("fn_extract_day", "exchange_rates",
    lambda: ["valid_from_date", F.dayofmonth("valid_from_date").cast("bigint").alias("day_of_month")],
    "valid_from_date, CAST(day(valid_from_date) AS BIGINT) AS day_of_month")
_fn("fn_date_to_string", "exchange_rates",
    lambda: ["valid_from_date", F.col("valid_from_date").cast("string").alias("valid_from_text"),
             (F.substring(F.col("valid_from_date").cast("string"), 8, 10) == "-01").alias("first_of_month")],
    "valid_from_date, CAST(valid_from_date AS VARCHAR) AS valid_from_text, "
    "substr(CAST(valid_from_date AS VARCHAR), 8, 10) = '-01' AS first_of_month")
_fn("fn_concat", "order_lines",
    lambda: ["derdato", "sales_grp", F.concat(F.col("sales_grp"), F.lit("-"), F.col("sold_to")).alias("group_account")],
    "derdato, sales_grp, sales_grp || '-' || sold_to AS group_account")
_fn("fn_coalesce", "order_lines",
    lambda: ["derdato", F.coalesce(F.col("sales_grp"), F.lit("")).alias("position_level_1_code"),
             F.coalesce(F.col("doc_number__0doc_categ"), F.lit("1900")).alias("category_or_default")],
    "derdato, COALESCE(sales_grp, '') AS position_level_1_code, "
    "COALESCE(doc_number__0doc_categ, '1900') AS category_or_default")
_fn("fn_trim", "account_xref",
    lambda: ["opl_account_id", norm_key("opl_account_id").alias("account_key"),
             norm_key("opl_account_classification_code").alias("classification_key")],
    f"opl_account_id, {trimws('opl_account_id')} AS account_key, "
    f"{trimws('opl_account_classification_code')} AS classification_key")
_fn("fn_case_searched", "billing_lines",
    lambda: ["bill_date", "bill_type",
             F.when(F.col("bill_type").isin(*GROSS_BILL_TYPES), F.col("subtotal_1")).otherwise(F.lit(0))
             .alias("gross_amount")],
    f"bill_date, bill_type, CASE WHEN bill_type IN ({qlist(GROSS_BILL_TYPES)}) THEN subtotal_1 ELSE 0 END "
    "AS gross_amount")
_fn("fn_case_simple", "billing_lines",
    lambda: ["bill_date", "doc_currcy",
             F.when(F.col("doc_currcy") == "EUR", "home").otherwise("foreign").alias("currency_kind")],
    "bill_date, doc_currcy, CASE doc_currcy WHEN 'EUR' THEN 'home' ELSE 'foreign' END AS currency_kind")
_fn("fn_classify_by_pattern", "account_xref",
    lambda: ["opl_source_system_code",
             classify(F.col("opl_source_system_code"), NAF_NONPROD.source_system_patterns,
                      NAF_NONPROD.source_system_default).alias("source_system_code")],
    f"opl_source_system_code, {_like_sql(NAF_NONPROD)}")
_fn("fn_cast_numeric", "billing_lines",
    lambda: ["bill_date", numeric("subtotal_1").alias("gross_numeric"),
             numeric(F.lit("0.00")).alias("zero_numeric")],
    f"bill_date, CAST(subtotal_1 AS {DEC}) AS gross_numeric, CAST('0.00' AS {DEC}) AS zero_numeric")
_fn("fn_cast_integer", "order_lines",
    lambda: ["derdato", F.substring("derdato", 1, 4).cast("bigint").alias("calendar_year"),
             F.substring("derdato", 5, 2).cast("bigint").alias("calendar_month")],
    "derdato, CAST(substr(derdato, 1, 4) AS BIGINT) AS calendar_year, "
    "CAST(substr(derdato, 5, 2) AS BIGINT) AS calendar_month")
_fn("fn_cast_string", "exchange_rates",
    lambda: ["from_currency_code", F.col("valid_to_date").cast("string").alias("valid_to_text")],
    "from_currency_code, CAST(valid_to_date AS VARCHAR) AS valid_to_text")
_fn("fn_safe_cast", "order_lines",
    lambda: ["sold_to", safe_integer("sold_to").alias("sold_to_number"),
             safe_integer("sales_grp").alias("sales_group_number"),
             F.lit(None).try_cast("string").alias("local_currency_code")],
    "sold_to, TRY_CAST(sold_to AS BIGINT) AS sold_to_number, "
    "TRY_CAST(sales_grp AS BIGINT) AS sales_group_number, TRY_CAST(NULL AS VARCHAR) AS local_currency_code")
_fn("fn_round_money", "billing_lines",
    lambda: ["bill_date", F.round(numeric("subtotal_1"), 2).cast("decimal(38,9)").alias("rounded_amount")],
    f"bill_date, CAST(round(CAST(subtotal_1 AS {DEC}), 2) AS {DEC}) AS rounded_amount")
_fn("fn_arith_mul", "billing_lines",
    lambda: ["bill_date", "subtotal_1",
             convert(F.col("subtotal_1"), F.lit("10.731234567").cast("decimal(18,9)"), "multiply").alias("converted")],
    f"bill_date, subtotal_1, {O.converted_sql('subtotal_1', '10.731234567', 'multiply')} AS converted")
_fn("fn_arith_div", "billing_lines",
    lambda: ["bill_date", "subtotal_1",
             convert(F.col("subtotal_1"), F.lit("10.731234567").cast("decimal(18,9)"), "divide").alias("converted")],
    f"bill_date, subtotal_1, {O.converted_sql('subtotal_1', '10.731234567', 'divide')} AS converted")


@register("fn_arith_sub", W(
    f"SELECT material_number, CAST(CAST(total_order_quantity_local AS DECIMAL(28,9)) - "
    f"CAST(shipped_quantity_local AS DECIMAL(28,9)) AS {DEC}) AS open_quantity FROM gassp",
    O.job_ctes(NAF_PROD)))
def q_fn_arith_sub(spark, sf):
    g = unified_facts(P.facts_for(catalog(spark, sf), NAF_PROD))
    return g.select("material_number", difference(F.col("total_order_quantity_local"),
                                                  F.col("shipped_quantity_local")).alias("open_quantity"))


@register("fn_current_timestamp", W(
    "SELECT count(DISTINCT t) AS n_stamps, count(*) AS n_rows FROM "
    "(SELECT CURRENT_TIMESTAMP AS t FROM order_lines)"))
def q_fn_current_timestamp(spark, sf):
    """CURRENT_TIMESTAMP is one value per statement, so every row carries the same stamp."""
    t = T(spark, sf, "order_lines").select(F.current_timestamp().alias("t"))
    return t.agg(F.countDistinct("t").alias("n_stamps"), F.count(F.lit(1)).alias("n_rows"))
