"""Variant settings: the five statements of the original job differ only in data,
so one pipeline reads one `VariantConfig`.

Everything a variant can change lives here as plain values; the pipeline has no
branch on a variant *name*.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values. These literals must equal the original job's for the output to
# match it (labels, codes and sentinels written into or filtered from rows).
# ---------------------------------------------------------------------------
CRM_SOURCE_LABEL = "C360-DATA-ASSET"
ACCOUNT_CLASSIFICATION = "DISTRIBUTOR"
DIRECT_INDICATOR = "D"
SEASON_CODE = "MY"
SEASON_PREFIX = "MY "
DIVISION_NAME = "Crop Science"
ACTION_TYPE = "A"
GLOBAL_CURRENCY = "EUR"
SENTINEL_DATE = date(1900, 1, 1)
SENTINEL_YEAR = "1900"
GOODS_ISSUE_SENTINEL = "00000000"
FACT_DATE_FLOOR = "20200101"
RATE_FROM_FLOOR = date(2020, 1, 1)
LINE_OF_BUSINESS = "Crop Protection"

COMPANIES_A = ("0085", "2926")
COMPANIES_B = ("1254", "1334")
SALES_ORGS_NAF = ("PC09", "EN09", "DG09")
SALES_ORGS_NA = ("PC09", "EN09")
SALES_ORGS_B = ("IQ09", "PV09")
ORDER_DIVISION = "20"
EXCLUDED_DOC_CATEGORIES = ("G", "B")
EXCLUDED_BILL_CATEGORY = "U"
GROSS_BILL_TYPES = ("YG2W", "YF2D", "YRED", "YL2W")
NET_BILL_TYPES = ("YB3D", "YG2W", "YF2D", "YRED", "YL2W", "YB4D")
NET_BILL_TYPES_P4S = ("YB3D", "YB1D", "YG2W", "YF2D", "YRED", "YL2W", "YB1D", "YS1D", "YL2D")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """One summed measure of a daily fact: SUM(source_col), or
    SUM(CASE WHEN type_col IN only_types THEN source_col ELSE 0 END)."""

    target: str
    source_col: str
    only_types: tuple[str, ...] | None = None
    type_col: str = "bill_type"


@dataclass(frozen=True)
class FactSpec:
    """One daily fact (returns, orders, shipments, billing) as data.

    Filters are conjunctive: ``eq`` col = value, ``isin`` col IN values,
    ``not_in`` col NOT IN values (NULL drops the row), ``ne`` col <> value.
    """

    name: str
    source: str                       # logical table in the SourceCatalog
    date_col: str                     # compact YYYYMMDD string column
    measures: tuple[Measure, ...]
    eq: tuple[tuple[str, str], ...] = ()
    isin: tuple[tuple[str, tuple[str, ...]], ...] = ()
    not_in: tuple[tuple[str, tuple[str, ...]], ...] = ()
    ne: tuple[tuple[str, str], ...] = ()
    date_floor: str = FACT_DATE_FLOOR
    currency_col: str | None = None   # billing carries the document currency
    order_date_from_fact: bool = False  # returns/orders stamp the fact day as order day


@dataclass(frozen=True)
class VariantConfig:
    name: str
    facts: tuple[FactSpec, ...]
    # material list
    material_sources: tuple[str, ...] = ("BC",)
    material_rank_by_source_desc: bool = False
    line_of_business: str = LINE_OF_BUSINESS
    # rates
    rate_target_currency: str = GLOBAL_CURRENCY
    rate_source_systems: tuple[str, ...] = ("xbc",)
    rate_from_floor: date = RATE_FROM_FLOOR
    rate_from_currencies: tuple[str, ...] | None = None
    rate_match: str = "validity"            # "month_start" | "validity"
    conversion: str = "multiply"            # "multiply" | "divide"
    convert_local_amounts: bool = False
    # currency columns: "null_to_eur" | "eur" | "raw"
    gross_local_currency: str = "null_to_eur"
    net_local_currency: str = "null_to_eur"
    net_global_currency: str = "eur"
    currency_group: str = "null_to_eur"     # "null_to_eur" | "none" | "raw"
    # labels stamped on fact rows
    source_system_label: str = "DataOne"
    account_source_label: str = "SAP"
    # enrichment
    source_system_patterns: tuple[tuple[str, str], ...] | None = None  # (LIKE pattern, label)
    source_system_default: str = "DataOne"
    account_source_from_xref: bool = True
    xref_source_system: str | None = None
    round_money: bool = False
    output_renames: tuple[tuple[str, str], ...] = ()
    # physical knobs (never change results)
    fuse_shared_scans: bool = True
    checkpoint_dims: bool = False           # compute material list and rates once (reliable checkpoint)

    def with_(self, **kw) -> "VariantConfig":
        return replace(self, **kw)


def _qty(target: str, col: str) -> tuple[Measure, ...]:
    return (Measure(target, col),)


def _billing_measures(net_types: tuple[str, ...]) -> tuple[Measure, ...]:
    return (
        Measure("gross_sales_amount_local", "subtotal_1", GROSS_BILL_TYPES),
        Measure("net_sales_amount_local", "netval_inv", net_types),
        Measure("net_sales_quantity_local", "bill_qty", net_types),
    )


def returns_spec(companies, orgs, doc_type, *, division=None, categories=None, channel=None):
    eq = [("doc_type", doc_type)]
    if division:
        eq.append(("g_cww007", division))
    if channel:
        eq.append(("distr_chan", channel))
    not_in = (("doc_number__0doc_categ", categories),) if categories else ()
    return FactSpec(
        name="returns", source="order_lines", date_col="derdato",
        measures=_qty("return_quantity_local", "dorqtybu"),
        eq=tuple(eq), isin=(("comp_code", companies), ("salesorg", orgs)), not_in=not_in,
        order_date_from_fact=True,
    )


def orders_spec(companies, orgs, doc_type, *, channel=None):
    eq = [("g_cww007", ORDER_DIVISION), ("doc_type", doc_type)]
    if channel:
        eq.append(("distr_chan", channel))
    return FactSpec(
        name="orders", source="order_lines", date_col="derdato",
        measures=_qty("total_order_quantity_local", "dorqtybu"),
        eq=tuple(eq), isin=(("comp_code", companies), ("salesorg", orgs)),
        not_in=(("doc_number__0doc_categ", EXCLUDED_DOC_CATEGORIES),),
        order_date_from_fact=True,
    )


def shipments_spec(companies, orgs, *, division=None, channel=None):
    eq = []
    if division:
        eq.append(("g_cww007", division))
    if channel:
        eq.append(("distr_chan", channel))
    return FactSpec(
        name="shipments", source="delivery_lines", date_col="act_gi_dte",
        measures=_qty("shipped_quantity_local", "act_dl_qty"),
        eq=tuple(eq), isin=(("comp_code", companies), ("salesorg", orgs)),
        ne=(("act_gi_dte", GOODS_ISSUE_SENTINEL),),
    )


def billing_spec(companies, orgs, channel, net_types):
    return FactSpec(
        name="billing", source="billing_lines", date_col="bill_date",
        measures=_billing_measures(net_types),
        eq=(("g_cww007", ORDER_DIVISION), ("distr_chan", channel)),
        isin=(("comp_code", companies), ("salesorg", orgs), ("bill_type", net_types)),
        ne=(("bill_num__0doc_categ", EXCLUDED_BILL_CATEGORY),),
        currency_col="doc_currcy",
    )


# --- the five presets -------------------------------------------------------

NAF_PROD = VariantConfig(
    name="naf_prod",
    facts=(
        returns_spec(COMPANIES_A, SALES_ORGS_NAF, "Z4RT"),
        orders_spec(COMPANIES_A, SALES_ORGS_NAF, "Z4SD"),
        shipments_spec(COMPANIES_A, SALES_ORGS_NAF),
        billing_spec(COMPANIES_A, SALES_ORGS_NAF, "00", NET_BILL_TYPES),
    ),
    material_sources=("BC", "4S"),
    material_rank_by_source_desc=True,
    rate_source_systems=("xbc", "x4s"),
    rate_from_currencies=("MAD",),
    rate_match="month_start",
    conversion="divide",
    source_system_patterns=(("SAP%P4S%", "DataOne-P4S"), ("SAP%PBC%", "DataOne-PBC")),
    round_money=True,
)

NAF_NONPROD = NAF_PROD.with_(
    name="naf_nonprod",
    source_system_patterns=(("SAP%Q4S%", "DataOne-Q4S"), ("SAP%QBC%", "DataOne-QBC")),
)

NA_P4S = VariantConfig(
    name="na_p4s",
    facts=(
        returns_spec(COMPANIES_A, SALES_ORGS_NA, "ZPRE", division=ORDER_DIVISION,
                     categories=EXCLUDED_DOC_CATEGORIES, channel="80"),
        orders_spec(COMPANIES_B, SALES_ORGS_B, "ZPVA", channel="80"),
        shipments_spec(COMPANIES_B, SALES_ORGS_B, division=ORDER_DIVISION, channel="80"),
        billing_spec(COMPANIES_B, SALES_ORGS_B, "80", NET_BILL_TYPES_P4S),
    ),
    convert_local_amounts=True,
    gross_local_currency="eur",
    net_local_currency="eur",
    currency_group="none",
    source_system_label="DataOne-PBC",
    account_source_label="SAP-PBC-C",
    source_system_default="DataOne-PBC",
    account_source_from_xref=False,
    xref_source_system="SAP-PBC-C",
)

NA_PBC = VariantConfig(
    name="na_pbc",
    facts=(
        returns_spec(COMPANIES_A, SALES_ORGS_NA, "Z4RT"),
        orders_spec(COMPANIES_A, SALES_ORGS_NA, "Z4SD"),
        shipments_spec(COMPANIES_A, SALES_ORGS_NA),
        billing_spec(COMPANIES_A, SALES_ORGS_NA, "00", NET_BILL_TYPES),
    ),
    source_system_label="DataOne-PBC",
    account_source_label="SAP-QBC-C",
    source_system_default="DataOne-PBC",
    account_source_from_xref=False,
    xref_source_system="SAP-QBC-C",
)

NA_TEST = NA_PBC.with_(
    name="na_test",
    convert_local_amounts=True,
    gross_local_currency="raw",
    net_local_currency="eur",
    net_global_currency="raw",
    currency_group="raw",
    source_system_label="DataOne",
    account_source_label="SAP",
    source_system_default="DataOne",
    account_source_from_xref=True,
    xref_source_system=None,
    output_renames=(("opl_account_source_system_code", "opl_source_system_code"),),
)

PRESETS: dict[str, VariantConfig] = {c.name: c for c in (NAF_PROD, NAF_NONPROD, NA_P4S, NA_PBC, NA_TEST)}
