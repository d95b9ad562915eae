"""Input contracts of the six logical tables, the daily fact layout and the
73-column output contract."""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)     # the warehouse NUMERIC type
MEASURE = T.DecimalType(28, 9)     # source amounts and quantities: all decimals that NUMERIC keeps
RATE = T.DecimalType(18, 9)        # exchange rates

S = T.StringType()


def _struct(*names: str, dtype=S) -> T.StructType:
    return T.StructType([T.StructField(n, dtype) for n in names])


INPUT_SCHEMAS: dict[str, T.StructType] = {
    "material_master": T.StructType([
        T.StructField("material_number", S),
        T.StructField("source", S),
        T.StructField("attributes", _struct("business_group", "line_of_business", "brand_name",
                                            "product_name", "crop_code")),
        T.StructField("general_data", _struct("product_group", "division")),
        T.StructField("updated", _struct("time", dtype=T.TimestampType())),
        T.StructField("deleted", _struct("time", dtype=T.TimestampType())),
    ]),
    "exchange_rates": T.StructType([
        T.StructField("from_currency_code", S),
        T.StructField("to_currency_code", S),
        T.StructField("valid_from_date", T.DateType()),
        T.StructField("valid_to_date", T.DateType()),
        T.StructField("exchange_rate", RATE),
        T.StructField("sap_src_sys_cd", S),
    ]),
    "order_lines": T.StructType([
        T.StructField(n, MEASURE if n == "dorqtybu" else S)
        for n in ("derdato", "ship_to__0country", "sales_grp", "sold_to", "material", "base_uom",
                  "dorqtybu", "comp_code", "salesorg", "doc_type", "g_cww007",
                  "doc_number__0doc_categ", "distr_chan")
    ]),
    "delivery_lines": T.StructType([
        T.StructField(n, MEASURE if n == "act_dl_qty" else S)
        for n in ("act_gi_dte", "ship_to__0country", "sales_grp", "sold_to", "material", "base_uom",
                  "act_dl_qty", "comp_code", "salesorg", "g_cww007", "distr_chan")
    ]),
    "billing_lines": T.StructType([
        T.StructField(n, MEASURE if n in ("subtotal_1", "netval_inv", "bill_qty") else S)
        for n in ("bill_date", "ship_to__0country", "sales_grp", "sold_to", "material", "base_uom",
                  "doc_currcy", "bill_type", "subtotal_1", "netval_inv", "bill_qty", "comp_code",
                  "salesorg", "g_cww007", "distr_chan", "bill_num__0doc_categ")
    ]),
    "account_xref": _struct("opl_account_id", "opl_account_classification_code",
                            "opl_source_system_code", "crm_account_id",
                            "crm_account_classification_group_code",
                            "crm_account_classification_code"),
}

# Daily fact layout shared by the four facts (union aligns on these names).
FACT_KEYS = (
    "source_system_code", "calendar_month", "calendar_year", "country_code",
    "position_level_1_code", "operational_account_identifier_1",
    "operational_account_identifier_1_source_system_code",
    "operational_account_identifier_1_classification_code", "direct_indirect_indicator",
)
FACT_MEASURES = (
    "gross_sales_amount_local", "net_sales_amount_local", "net_sales_quantity_local",
    "shipped_quantity_local", "return_quantity_local", "total_order_quantity_local",
)
FACT_COLUMNS = FACT_KEYS + (
    "first_order_date", "invoice_date", "material_number", "local_currency_code", "local_uom",
) + FACT_MEASURES

MATERIAL_ATTRS = ("business_group_name", "line_of_business", "product_group", "brand", "product_name")

# Output contract: (name, type) in emitted order. "dec" columns are NUMERIC.
_D, _S, _L, _DT, _TS = NUMERIC, S, T.LongType(), T.DateType(), T.TimestampType()


def _measure_block(stem: str, unit: str) -> list[tuple[str, T.DataType]]:
    return [(f"{stem}_local", _D), (f"{stem}_local_{unit}", _S),
            (f"{stem}_global", _D), (f"{stem}_global_{unit}", _S)]


OUTPUT_CONTRACT: list[tuple[str, T.DataType]] = [
    ("crm_account_source_system_code", _S), ("crm_account_id", _S),
    ("crm_account_classification_group_code", _S), ("crm_account_classification", _S),
    ("source_system_code", _S), ("calendar_year", _L), ("calendar_month", _L),
    ("country_code", _S), ("position_level_1_code", _S), ("opl_account_id", _S),
    ("opl_account_source_system_code", _S), ("opl_account_classification_code", _S),
    ("direct_indirect_indicator", _S), ("invoice_date", _DT), ("material_number", _S),
    ("first_order_date", _DT), ("selling_season", _L), ("season_code", _S), ("season_name", _S),
    ("division_name", _S), ("business_group_name", _S), ("line_of_business", _S),
    ("product_group", _S), ("brand", _S), ("product_name", _S),
    *_measure_block("gross_sales_amount", "currency_code"),
    *_measure_block("net_sales_amount", "currency_code"),
    *_measure_block("net_sales_quantity", "unit_of_measure_code"),
    *_measure_block("forecasted_sales_amount", "currency_code"),
    *_measure_block("forecasted_gross_profit_amount", "currency_code"),
    *_measure_block("open_order_quantity", "unit_of_measure_code"),
    *_measure_block("return_quantity", "unit_of_measure_code"),
    *_measure_block("shipped_quantity", "unit_of_measure_code"),
    *_measure_block("total_order_quantity", "unit_of_measure_code"),
    ("international_article_number", _L),
    *_measure_block("net_price_amount", "currency_code"),
    *_measure_block("budget_price_amount", "currency_code"),
    ("action_type", _S), ("row_insert_timestamp", _TS), ("row_update_timestamp", _TS),
]
assert len(OUTPUT_CONTRACT) == 73

# Money columns rounded to 2 digits when a variant asks for it.
MONEY_COLUMNS = tuple(
    f"{stem}_{side}" for stem in ("gross_sales_amount", "net_sales_amount", "forecasted_sales_amount",
                                  "forecasted_gross_profit_amount", "net_price_amount",
                                  "budget_price_amount")
    for side in ("local", "global")
)
