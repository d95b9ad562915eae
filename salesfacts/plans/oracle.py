"""DuckDB twins: the stand-in tables and the job written as one SQL statement.

Used only to check the Spark results (the driver runs these strings against
the same parquet tables, which it registers as views). Dialect notes that
matter for equal results:

* window ORDER BY spells out NULLS FIRST/LAST (DuckDB's default differs);
* DuckDB divides decimals in DOUBLE, so conversions are done on whole numbers of
  billionths (HUGEINT), rounded half up once;
* decimals are widened before a product so DuckDB does not overflow;
* TRIM is given the same characters as on the Spark side.
"""

from __future__ import annotations

from datetime import datetime

from salesfacts.config import (ACCOUNT_CLASSIFICATION, ACTION_TYPE, CRM_SOURCE_LABEL,
                               DIRECT_INDICATOR, DIVISION_NAME, GLOBAL_CURRENCY, SEASON_CODE,
                               SEASON_PREFIX, SENTINEL_YEAR, FactSpec, VariantConfig)
from salesfacts.functions.exprs import WHITESPACE
from salesfacts.schemas import FACT_MEASURES, MONEY_COLUMNS, NUMERIC, OUTPUT_CONTRACT
from salesfacts.sources import standins as S

DEC = "DECIMAL(38,9)"


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def qlist(vs) -> str:
    return ", ".join(q(v) for v in vs)


_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def trimws(expr: str) -> str:
    return f"trim({expr}, {_BLANKS})"


def _pick(index: str, values) -> str:
    return f"list_extract([{qlist(values)}], CAST({index} AS INTEGER) + 1)"


def _ccy(key: str) -> str:
    return (f"CASE WHEN {key} = 0 THEN 'EUR' WHEN {key} = 1 THEN 'MAD' WHEN {key} = 2 THEN 'USD' "
            f"ELSE 'C' || lpad(CAST({key} AS VARCHAR), 2, '0') END")


def _ymd(ts: str) -> str:
    return f"strftime(CAST({ts} AS DATE) + INTERVAL {S.SHIFT_MONTHS} MONTH, '%Y%m%d')"


def _measure(column: str, parts) -> str:
    return (f"CAST(CAST({column} AS DECIMAL(18,2)) + CAST({_pick('l_linenumber - 1', parts)} AS DECIMAL(9,9)) "
            f"AS DECIMAL(28,9))")


_GROSS, _QUANTITY = _measure("l_extendedprice", S.AMOUNT_PART), _measure("l_quantity", S.QUANTITY_PART)
_ORG = "CASE " + " ".join(f"WHEN c_mktsegment = {q(s)} THEN {q(c)}" for s, c in S.SALES_ORG_BY_SEGMENT) + " END"

_LINE_DIMS = f"""
    'N' || CAST(c_nationkey AS VARCHAR) AS ship_to__0country,
    CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN ''
         ELSE 'G' || CAST(o_custkey % 10 AS VARCHAR) END AS sales_grp,
    CAST(o_custkey AS VARCHAR) AS sold_to,
    CAST(l_partkey AS VARCHAR) AS material,
    CASE WHEN l_linenumber % 2 = 0 THEN 'KG' ELSE 'L' END AS base_uom,
    {_pick('c_nationkey % 4', S.COMPANY_BY_NATION_MOD4)} AS comp_code,
    {_ORG} AS salesorg,
    CASE WHEN o_orderpriority = '5-LOW' THEN '10' ELSE '20' END AS g_cww007,
    CASE WHEN o_custkey % 3 = 0 THEN '80' ELSE '00' END AS distr_chan"""

_LINES = ("lineitem JOIN orders ON l_orderkey = o_orderkey "
          "JOIN customer ON o_custkey = c_custkey")


STANDIN_CTES = {
    "order_lines": f"""SELECT
    {_ymd('o_orderdate')} AS derdato,{_LINE_DIMS},
    CASE WHEN l_orderkey % 53 = 11 THEN NULL ELSE {_QUANTITY} END AS dorqtybu,
    CASE WHEN l_returnflag = 'R'
         THEN CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 'Z4RT' ELSE 'ZPRE' END
         ELSE CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 'Z4SD' ELSE 'ZPVA' END END AS doc_type,
    CASE WHEN o_orderstatus = 'F' THEN 'C' WHEN o_orderstatus = 'O' THEN 'G'
         WHEN l_linenumber = 3 THEN NULL ELSE 'I' END AS doc_number__0doc_categ
  FROM {_LINES}""",
    "delivery_lines": f"""SELECT
    CASE WHEN l_linestatus = 'O' AND l_linenumber >= 6 THEN '00000000'
         ELSE {_ymd('l_shipdate')} END AS act_gi_dte,{_LINE_DIMS},
    {_QUANTITY} AS act_dl_qty
  FROM {_LINES}""",
    "billing_lines": f"""SELECT
    {_ymd('l_shipdate')} AS bill_date,{_LINE_DIMS},
    CASE WHEN l_orderkey % 41 = 5 THEN NULL ELSE {_ccy('c_nationkey')} END AS doc_currcy,
    {_pick('(l_orderkey + l_linenumber) % 10', S.BILL_TYPE_CYCLE)} AS bill_type,
    {_GROSS} AS subtotal_1,
    CAST(round({_GROSS} * CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(4,2)), 3) AS DECIMAL(28,9)) AS netval_inv,
    {_QUANTITY} AS bill_qty,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'U' ELSE 'M' END AS bill_num__0doc_categ
  FROM {_LINES}""",
    "material_master": """SELECT
    CAST(p_partkey AS VARCHAR) AS material_number,
    CASE WHEN v = 1 AND p_size % 2 = 0 THEN '4S' ELSE 'BC' END AS source,
    struct_pack(
      business_group := 'BG' || CAST(p_partkey % 3 AS VARCHAR),
      line_of_business := CASE WHEN p_type IN ('STANDARD', 'PROMO', 'SMALL')
                                    AND NOT (v = 2 AND p_partkey % 5 = 0)
                               THEN 'Crop Protection' ELSE p_type END,
      brand_name := p_brand || '/v' || CAST(v AS VARCHAR),
      product_name := p_name,
      crop_code := 'C' || CAST(p_size % 7 AS VARCHAR)) AS attributes,
    struct_pack(
      product_group := 'PG' || CAST(p_size % 5 AS VARCHAR),
      division := 'D' || CAST(p_partkey % 2 AS VARCHAR)) AS general_data,
    struct_pack(time := CAST(DATE '2021-01-01' - CAST(p_size * v AS INTEGER) AS TIMESTAMP)) AS updated,
    CASE WHEN (p_partkey + v) % 13 = 0 THEN NULL
         ELSE struct_pack(time := CASE WHEN (p_partkey + v) % 11 = 7
                                       THEN TIMESTAMP '2021-06-01 00:00:00' END) END AS deleted
  FROM (SELECT *, unnest([0, 1, 2]) AS v FROM part)""",
    "exchange_rates": f"""SELECT
    {_ccy('n_nationkey')} AS from_currency_code,
    CASE WHEN k = 3 AND month(m) = 6 THEN 'USD' ELSE 'EUR' END AS to_currency_code,
    CASE WHEN k = 4 THEN m + 14 ELSE m END AS valid_from_date,
    CASE WHEN k = 2 AND n_nationkey = 2 AND m = DATE '{S.OPEN_ENDED_MONTH}' THEN DATE '9999-12-31'
         WHEN k IN (1, 2) THEN last_day(m) + 31 ELSE last_day(m) END AS valid_to_date,
    CAST({_pick('(n_nationkey + month(m) + k) % 8', S.RATE_CYCLE)} AS DECIMAL(18,9)) AS exchange_rate,
    CASE WHEN k = 1 THEN 'x4s' ELSE 'xbc' END AS sap_src_sys_cd
  FROM (SELECT c_nationkey AS n_nationkey,
               CAST(date_trunc('month', CAST(o_orderdate AS DATE) + INTERVAL {S.SHIFT_MONTHS} MONTH) AS DATE) AS m,
               unnest([0, 1, 2, 3, 4]) AS k
        FROM orders JOIN customer ON o_custkey = c_custkey)
  WHERE n_nationkey % 5 <> 4 AND (k = 0
        OR (k = 1 AND (n_nationkey % 7 = 3 OR n_nationkey = 1))
        OR (k = 2 AND (n_nationkey % 6 = 5 OR n_nationkey = 2) AND month(m) % 4 = 0)
        OR (k = 3 AND n_nationkey % 4 = 2)
        OR (k = 4 AND n_nationkey % 3 = 0))""",
    "account_xref": f"""SELECT
    CASE WHEN r = 1 THEN CAST(c_custkey AS VARCHAR)
         ELSE {_pick(f'c_custkey % {len(S.PADDING)}', [a for a, _ in S.PADDING])} || CAST(c_custkey AS VARCHAR)
              || {_pick(f'c_custkey % {len(S.PADDING)}', [b for _, b in S.PADDING])} END AS opl_account_id,
    CASE WHEN r = 1 THEN 'DISTRIBUTOR' WHEN c_custkey % 6 = 5 THEN 'RETAILER'
         WHEN c_custkey % 2 = 0 THEN 'DISTRIBUTOR ' ELSE 'DISTRIBUTOR' END
      AS opl_account_classification_code,
    CASE WHEN r = 1 THEN 'SAP-PBC-C' ELSE {_pick('c_custkey % 5', S.XREF_SOURCE_CYCLE)} END
      AS opl_source_system_code,
    CASE WHEN r = 1 THEN 'CRM-B' || CAST(c_custkey AS VARCHAR)
         ELSE 'CRM' || CAST(c_custkey // 2 AS VARCHAR) END AS crm_account_id,
    CASE WHEN r = 1 THEN 'GRPB' ELSE 'GRP' || CAST(c_custkey % 4 AS VARCHAR) END
      AS crm_account_classification_group_code,
    c_mktsegment AS crm_account_classification_code
  FROM (SELECT c_custkey, c_mktsegment, unnest([0, 1, 2]) AS r FROM customer)
  WHERE (r = 0 AND c_custkey % 9 <> 8) OR (r = 1 AND c_custkey % 5 = 0)
     OR (r = 2 AND c_custkey % 7 = 0 AND c_custkey % 9 <> 8)""",
}


def with_standins(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the stand-in CTEs (and ``extra`` CTEs after them)."""
    ctes = {**STANDIN_CTES, **(extra or {})}
    return "WITH " + ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes.items()) + "\n" + body


# --- the job -------------------------------------------------------------------

def material_list_sql(cfg: VariantConfig) -> str:
    order = ["source DESC NULLS LAST"] if cfg.material_rank_by_source_desc else []
    order += ["updated.time ASC NULLS FIRST",
              *[f"{p} ASC NULLS FIRST" for p in (
                  "attributes.business_group", "attributes.line_of_business",
                  "general_data.product_group", "attributes.brand_name", "attributes.product_name",
                  "attributes.crop_code", "general_data.division")]]
    if not cfg.material_rank_by_source_desc:
        order.append("source ASC NULLS FIRST")
    return f"""SELECT material_number, business_group_name, line_of_business, product_group, brand, product_name
  FROM (SELECT material_number,
               attributes.business_group AS business_group_name,
               attributes.line_of_business AS line_of_business,
               general_data.product_group AS product_group,
               attributes.brand_name AS brand,
               attributes.product_name AS product_name,
               ROW_NUMBER() OVER (PARTITION BY material_number ORDER BY {', '.join(order)}) AS rn
        FROM material_master
        WHERE source IN ({qlist(cfg.material_sources)})
          AND attributes.line_of_business = {q(cfg.line_of_business)}
          AND deleted.time IS NULL)
  WHERE rn = 1"""


def rate_where_sql(cfg: VariantConfig) -> str:
    w = (f"to_currency_code = {q(cfg.rate_target_currency)} "
         f"AND sap_src_sys_cd IN ({qlist(cfg.rate_source_systems)}) "
         f"AND valid_from_date >= DATE '{cfg.rate_from_floor}' AND day(valid_from_date) = 1")
    if cfg.rate_from_currencies:
        w += f" AND from_currency_code IN ({qlist(cfg.rate_from_currencies)})"
    return w


def rates_sql(cfg: VariantConfig) -> str:
    cols = "from_currency_code, valid_from_date, valid_to_date, exchange_rate"
    if cfg.rate_match == "month_start":
        return f"""SELECT {cols} FROM (
    SELECT {cols}, ROW_NUMBER() OVER (PARTITION BY from_currency_code, valid_from_date
                                      ORDER BY valid_to_date ASC NULLS FIRST,
                                               exchange_rate ASC NULLS FIRST) AS rn
    FROM exchange_rates WHERE {rate_where_sql(cfg)}) WHERE rn = 1"""
    return f"SELECT DISTINCT {cols} FROM exchange_rates WHERE {rate_where_sql(cfg)}"


def fact_where_sql(spec: FactSpec) -> str:
    preds = [f"{c} = {q(v)}" for c, v in spec.eq]
    preds += [f"{c} IN ({qlist(vs)})" for c, vs in spec.isin]
    preds += [f"{c} NOT IN ({qlist(vs)})" for c, vs in spec.not_in]
    preds += [f"{c} <> {q(v)}" for c, v in spec.ne]
    preds.append(f"{spec.date_col} >= {q(spec.date_floor)}")
    return " AND ".join(preds)


def fact_sql(spec: FactSpec, cfg: VariantConfig) -> str:
    d = spec.date_col
    sums = {}
    for m in spec.measures:
        v = m.source_col if m.only_types is None else \
            f"CASE WHEN {m.type_col} IN ({qlist(m.only_types)}) THEN {m.source_col} ELSE 0 END"
        sums[m.target] = f"CAST(SUM({v}) AS {DEC})"
    measures = ",\n    ".join(f"{sums.get(m, f'CAST(0 AS {DEC})')} AS {m}" for m in FACT_MEASURES)
    first = f"CAST(strptime({d}, '%Y%m%d') AS DATE)" if spec.order_date_from_fact else "DATE '1900-01-01'"
    ccy = spec.currency_col or "CAST(NULL AS VARCHAR)"
    keys = [d, "ship_to__0country", "sales_grp", "sold_to", "material",
            *([spec.currency_col] if spec.currency_col else []), "base_uom"]
    return f"""SELECT {q(cfg.source_system_label)} AS source_system_code,
    substr({d}, 5, 2) AS calendar_month, substr({d}, 1, 4) AS calendar_year,
    ship_to__0country AS country_code, sales_grp AS position_level_1_code,
    sold_to AS operational_account_identifier_1,
    {q(cfg.account_source_label)} AS operational_account_identifier_1_source_system_code,
    {q(ACCOUNT_CLASSIFICATION)} AS operational_account_identifier_1_classification_code,
    {q(DIRECT_INDICATOR)} AS direct_indirect_indicator,
    {first} AS first_order_date, DATE '1900-01-01' AS invoice_date,
    material AS material_number, {ccy} AS local_currency_code, base_uom AS local_uom,
    {measures}
  FROM {spec.source} WHERE {fact_where_sql(spec)}
  GROUP BY {', '.join(keys)}"""


def converted_sql(amount: str, rate: str, op: str) -> str:
    """amount (x|/) rate in whole billionths, rounded half up (away from zero) once."""
    a = f"CAST(CAST({amount} AS DECIMAL(28,9)) * CAST(1000000000 AS DECIMAL(10,0)) AS HUGEINT)"
    r = f"CAST(CAST({rate} AS DECIMAL(28,9)) * CAST(1000000000 AS DECIMAL(10,0)) AS HUGEINT)"
    whole = (f"(abs({a}) * {r} * 2 + 1000000000) // 2000000000" if op == "multiply"
             else f"(abs({a}) * 2000000000 + {r}) // (2 * {r})")
    return f"CAST(CAST(sign({a}) * ({whole}) AS DECIMAL(28,0)) * CAST(0.000000001 AS DECIMAL(9,9)) AS {DEC})"


def convert_sql(amount: str, cfg: VariantConfig) -> str:
    return (f"CASE WHEN local_currency_code = {q(GLOBAL_CURRENCY)} THEN CAST({amount} AS {DEC}) "
            f"ELSE {converted_sql(amount, 'fx_rate', cfg.conversion)} END")


def _ccy_key_sql(cfg: VariantConfig) -> str | None:
    return {"null_to_eur": f"CASE WHEN local_currency_code IS NULL THEN {q(GLOBAL_CURRENCY)} "
                           f"ELSE local_currency_code END",
            "raw": "local_currency_code", "none": None}[cfg.currency_group]


def _ccy_out_sql(mode: str, cfg: VariantConfig) -> str:
    return q(GLOBAL_CURRENCY) if mode == "eur" else _ccy_key_sql(cfg)


def _placeholders_sql() -> str:
    """The always-NULL columns of the monthly relation, typed."""
    from salesfacts.schemas import NUMERIC as _N

    names = [n for n, t in OUTPUT_CONTRACT
             if (n.endswith("_global") and not n.startswith(("gross_sales", "net_sales_amount")))
             or n.startswith(("forecasted_", "net_price_", "budget_price_"))
             or (n.endswith("_global_unit_of_measure_code"))
             or n == "international_article_number"]
    types = dict(OUTPUT_CONTRACT)
    return ",\n    ".join(
        f"CAST(NULL AS {DEC if types[n] == _N else _SQL_TYPES[types[n].simpleString()]}) AS {n}"
        for n in names)


def monthly_sql(cfg: VariantConfig) -> str:
    """The 66-column monthly relation (OPL) over CTEs ``gassp``, ``material_list``, ``ccr``."""
    month = ("CAST(strptime(g.calendar_year || '-' || g.calendar_month || '-01', '%Y-%m-%d') AS DATE)")
    on = (f"r.valid_from_date = {month}" if cfg.rate_match == "month_start"
          else f"{month} BETWEEN r.valid_from_date AND r.valid_to_date")
    key = _ccy_key_sql(cfg)
    group = ["source_system_code", "calendar_month", "calendar_year", "country_code",
             "position_level_1_code", "operational_account_identifier_1",
             "operational_account_identifier_1_source_system_code",
             "operational_account_identifier_1_classification_code", "direct_indirect_indicator",
             "invoice_date", *([key] if key else []), "material_number", "business_group_name",
             "line_of_business", "product_group", "brand", "product_name", "local_uom"]

    def local(c):
        return convert_sql(c, cfg) if cfg.convert_local_amounts else c

    def co(c, d=""):
        return f"COALESCE({c}, {q(d)})"
    return f"""SELECT
    {co('source_system_code')} AS source_system_code,
    {co('calendar_year', SENTINEL_YEAR)} AS calendar_year,
    {co('calendar_month')} AS calendar_month,
    {co('country_code')} AS country_code,
    {co('position_level_1_code')} AS position_level_1_code,
    {co('operational_account_identifier_1')} AS opl_account_id,
    {co('operational_account_identifier_1_source_system_code')} AS opl_account_source_system_code,
    {co('operational_account_identifier_1_classification_code')} AS opl_account_classification_code,
    {co('direct_indirect_indicator')} AS direct_indirect_indicator,
    COALESCE(invoice_date, DATE '1900-01-01') AS invoice_date,
    {co('material_number')} AS material_number,
    MAX(first_order_date) AS first_order_date,
    {co('calendar_year', SENTINEL_YEAR)} AS selling_season,
    {q(SEASON_CODE)} AS season_code,
    {q(SEASON_PREFIX)} || substr({co('calendar_year', SENTINEL_YEAR)}, 3, 2) AS season_name,
    {q(DIVISION_NAME)} AS division_name,
    business_group_name, line_of_business, product_group, brand, product_name,
    CAST(SUM({local('gross_sales_amount_local')}) AS {DEC}) AS gross_sales_amount_local,
    {_ccy_out_sql(cfg.gross_local_currency, cfg)} AS gross_sales_amount_local_currency_code,
    CAST(SUM({convert_sql('gross_sales_amount_local', cfg)}) AS {DEC}) AS gross_sales_amount_global,
    {q(GLOBAL_CURRENCY)} AS gross_sales_amount_global_currency_code,
    CAST(SUM({local('net_sales_amount_local')}) AS {DEC}) AS net_sales_amount_local,
    {_ccy_out_sql(cfg.net_local_currency, cfg)} AS net_sales_amount_local_currency_code,
    CAST(SUM({convert_sql('net_sales_amount_local', cfg)}) AS {DEC}) AS net_sales_amount_global,
    {_ccy_out_sql(cfg.net_global_currency, cfg)} AS net_sales_amount_global_currency_code,
    CAST(SUM(net_sales_quantity_local) AS {DEC}) AS net_sales_quantity_local,
    local_uom AS net_sales_quantity_local_unit_of_measure_code,
    CAST(SUM(CAST(total_order_quantity_local AS DECIMAL(28,9))
             - CAST(shipped_quantity_local AS DECIMAL(28,9))) AS {DEC}) AS open_order_quantity_local,
    local_uom AS open_order_quantity_local_unit_of_measure_code,
    CAST(SUM(return_quantity_local) AS {DEC}) AS return_quantity_local,
    local_uom AS return_quantity_local_unit_of_measure_code,
    CAST(SUM(shipped_quantity_local) AS {DEC}) AS shipped_quantity_local,
    local_uom AS shipped_quantity_local_unit_of_measure_code,
    CAST(SUM(total_order_quantity_local) AS {DEC}) AS total_order_quantity_local,
    local_uom AS total_order_quantity_local_unit_of_measure_code,
    {_placeholders_sql()}
  FROM (SELECT g.*, m.business_group_name, m.line_of_business, m.product_group, m.brand,
               m.product_name, r.exchange_rate AS fx_rate
        FROM gassp g
        JOIN material_list m ON g.material_number = m.material_number
        LEFT JOIN ccr r ON r.from_currency_code = g.local_currency_code AND {on})
  GROUP BY {', '.join(group)}"""


_SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "date": "DATE", "timestamp": "TIMESTAMP",
              NUMERIC.simpleString(): DEC}


def final_sql(cfg: VariantConfig, load_ts: datetime | None) -> str:
    opl_cols = {"calendar_year", "calendar_month", "country_code", "position_level_1_code",
                "opl_account_id", "opl_account_classification_code", "direct_indirect_indicator",
                "invoice_date", "material_number", "first_order_date", "selling_season",
                "season_code", "season_name", "division_name", "business_group_name",
                "line_of_business", "product_group", "brand", "product_name"}
    opl_cols |= {f"{s}_local" for s in ("gross_sales_amount", "net_sales_amount", "net_sales_quantity",
                                         "open_order_quantity", "return_quantity", "shipped_quantity",
                                         "total_order_quantity")}
    opl_cols |= {f"{s}_global" for s in ("gross_sales_amount", "net_sales_amount")}
    opl_cols |= {c for c, _ in OUTPUT_CONTRACT if c.endswith("_local_currency_code")
                 and c.split("_local_")[0] in ("gross_sales_amount", "net_sales_amount")}
    opl_cols |= {"gross_sales_amount_global_currency_code", "net_sales_amount_global_currency_code"}
    opl_cols |= {c for c, _ in OUTPUT_CONTRACT if c.endswith("_local_unit_of_measure_code")}
    if cfg.source_system_patterns:
        src = "CASE " + " ".join(f"WHEN x.opl_source_system_code LIKE {q(p)} THEN {q(lbl)}"
                                 for p, lbl in cfg.source_system_patterns) \
              + f" ELSE {q(cfg.source_system_default)} END"
    else:
        src = "o.source_system_code"
    stamp = "CURRENT_TIMESTAMP" if load_ts is None else f"TIMESTAMP '{load_ts:%Y-%m-%d %H:%M:%S}'"
    special = {
        "crm_account_source_system_code": q(CRM_SOURCE_LABEL),
        "crm_account_id": "x.crm_account_id",
        "crm_account_classification_group_code": "x.crm_account_classification_group_code",
        "crm_account_classification": "x.crm_account_classification_code",
        "source_system_code": src,
        "opl_account_source_system_code": ("x.opl_source_system_code" if cfg.account_source_from_xref
                                           else "o.opl_account_source_system_code"),
        "action_type": q(ACTION_TYPE),
        "row_insert_timestamp": stamp,
        "row_update_timestamp": stamp,
    }
    renames = dict(cfg.output_renames)
    cols = []
    for name, dtype in OUTPUT_CONTRACT:
        t = _SQL_TYPES[dtype.simpleString()]
        expr = special.get(name, f"o.{name}" if name in opl_cols else "NULL")
        if cfg.round_money and name in MONEY_COLUMNS:
            expr = f"round(CAST({expr} AS {DEC}), 2)"
        cols.append(f"CAST({expr} AS {t}) AS {renames.get(name, name)}")
    on = (f"{trimws('o.opl_account_id')} = {trimws('x.opl_account_id')} AND "
          f"{trimws('o.opl_account_classification_code')} = {trimws('x.opl_account_classification_code')}")
    if cfg.xref_source_system is not None:
        on += f" AND {trimws('x.opl_source_system_code')} = {q(cfg.xref_source_system)}"
    return ("SELECT DISTINCT\n    " + ",\n    ".join(cols)
            + f"\n  FROM opl o JOIN account_xref x ON {on}")


def job_ctes(cfg: VariantConfig) -> dict[str, str]:
    return {
        "material_list": material_list_sql(cfg),
        "ccr": rates_sql(cfg),
        "gassp": "\n  UNION ALL\n".join(fact_sql(s, cfg) for s in cfg.facts),
        "opl": monthly_sql(cfg),
    }


def job_sql(cfg: VariantConfig, load_ts: datetime | None = None) -> str:
    """The whole job over the stand-ins, as one DuckDB statement."""
    return with_standins(final_sql(cfg, load_ts), job_ctes(cfg))
