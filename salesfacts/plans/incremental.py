"""The monthly roll-up as a state that is brought up to date month by month.

The roll-up's groups hold the month, so the whole result is the union of its months.
Two tables keep them (``sources.months.MonthTable``):

* ``daily``: the unified daily facts of a month, the partial sums of its lines;
* ``monthly``: the 66-column relation of a month, rolled up from its daily facts with
  the materials and rates.

The line tables are month tables, too, binned by the day that the facts go by. A month
of ``daily`` is made from the lines of this month alone, and its entry says from which:
rows and digest of the month in each line table, and the facts' settings. A refresh
compares these entries with the line tables' present ones, without reading any line,
and reads the lines of the months that differ. A month of ``monthly`` is rolled up again
if its daily facts, the material list or a rate that covers the month differ; that
reads daily facts, never lines. Conversion rounds once per daily fact as in a full run,
so a refresh and a full run give the same rows.

Each table is replaced month by month as a whole (staged, verified, then named in its
manifest). A refresh that fails between the two leaves ``monthly`` as it was, and the
next one finds the same months to do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesfacts.config import VariantConfig
from salesfacts.functions.exprs import date_lit
from salesfacts.operators.dims import first_month, material_list
from salesfacts.operators.enrich import crm_enrichment
from salesfacts.operators.facts import build_facts
from salesfacts.operators.rollup import monthly_sales, unified_facts
from salesfacts.plans.pipeline import rates_for, reuse_dimension
from salesfacts.session import require_ansi
from salesfacts.sources.catalog import SourceCatalog
from salesfacts.sources.months import MonthTable, digest

LINE_DAYS = {"order_lines": "derdato", "delivery_lines": "act_gi_dte", "billing_lines": "bill_date"}


def line_table(spark: SparkSession, root: str, name: str) -> MonthTable:
    """The month table of a line table, sorted by its day, so that a scan skips the row groups before a floor."""
    return MonthTable(spark, f"{root}/{name}", sort=(LINE_DAYS[name],))


def line_month(name: str) -> Column:
    """The month (YYYYMM) of a line's day."""
    return F.substring(LINE_DAYS[name], 1, 6)


def result_month() -> Column:
    """The month (YYYYMM) of a row of the job's result."""
    return F.concat(F.lpad(F.col("calendar_year").cast("string"), 4, "0"), F.lpad(F.col("calendar_month").cast("string"), 2, "0"))


def publish_lines(catalog: SourceCatalog, root: str, months: Iterable[str] | None = None) -> dict[str, MonthTable]:
    """Write the catalog's line tables by month: all of them, or only the lines of ``months``."""
    out = {}
    for name in LINE_DAYS:
        out[name] = line_table(catalog.spark, root, name)
        rows = catalog.table(name)
        out[name].publish(rows if months is None else rows.where(line_month(name).isin(*months)), line_month(name), months=months)
    return out


@dataclass(frozen=True)
class Refreshed:
    """The months whose lines were read, those that were rolled up again, and the up-to-date 66-column relation."""

    lines_read: list[str]
    rolled_up: list[str]
    monthly: DataFrame


def _words(*parts) -> str:
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:16]


def _rate_digests(rates: DataFrame, cfg: VariantConfig, months: list[str]) -> dict[str, str]:
    """A digest of the rates that hold in each of ``months``; a rate counts in the months of the table that it covers."""
    if not months:
        return {}
    if cfg.rate_match == "month_start":
        each = rates.withColumn("_month", F.col("valid_from_date"))
    else:
        day = lambda m: date_lit(date(int(m[:4]), int(m[4:]), 1))
        first = F.greatest(first_month(F.col("valid_from_date")), day(months[0]))
        last = F.least(F.trunc("valid_to_date", "MM"), day(months[-1]))
        each = rates.withColumn("_month", F.explode(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))))
    found = each.groupBy(F.date_format("_month", "yyyyMM").alias("month")).agg(digest(rates).alias("d"))
    return {r["month"]: r["d"] for r in found.where(F.col("month").between(months[0], months[-1])).collect()}


def refresh(catalog: SourceCatalog, lines: dict[str, MonthTable], cfg: VariantConfig, state: str) -> Refreshed:
    """Bring the state under ``state`` up to date with the line tables and the catalog's materials and rates."""
    spark = catalog.spark
    require_ansi(spark)
    daily, monthly = MonthTable(spark, f"{state}/daily"), MonthTable(spark, f"{state}/monthly")
    floor = min(s.date_floor for s in cfg.facts)[:6]
    used = sorted({s.source for s in cfg.facts})
    now = {name: {m: e for m, e in lines[name].months().items() if m >= floor and m.isdigit()} for name in used}
    facts_as = _words(cfg.facts, cfg.source_system_label, cfg.account_source_label)
    wanted = {m: _words(facts_as, *[(n, now[n][m].rows, now[n][m].digest) for n in used if m in now[n]])
              for m in sorted({m for n in used for m in now[n]})}
    held = daily.months()
    stale = sorted({m for m, basis in wanted.items() if m not in held or held[m].basis != basis} | (held.keys() - wanted.keys()))
    if stale or not held:
        facts = build_facts(lambda name: lines[name].read(stale), cfg.facts, cfg, fuse=cfg.fuse_shared_scans)
        daily.publish(unified_facts(facts), F.concat("calendar_year", "calendar_month"), months=stale, basis=wanted)
        held = daily.months()

    materials = reuse_dimension(material_list(catalog.table("material_master"), cfg), cfg)
    rates = reuse_dimension(rates_for(catalog, cfg), cfg)
    rolled_as = _words(cfg.with_(name="", checkpoint_dims=False, fuse_shared_scans=True), materials.agg(digest(materials)).first()[0])
    in_use = [m for m in sorted(held) if m.isdigit()]
    rated = _rate_digests(rates, cfg, in_use)
    wanted = {m: _words(rolled_as, held[m].rows, held[m].digest, rated.get(m)) for m in sorted(held)}
    done = monthly.months()
    due = sorted({m for m, basis in wanted.items() if m not in done or done[m].basis != basis} | (done.keys() - wanted.keys()))
    if due or not done:
        sums = monthly_sales(daily.read(due), materials, rates, cfg)
        monthly.publish(sums, F.concat("calendar_year", "calendar_month"), months=due, basis=wanted)
    return Refreshed(stale, due, monthly.read())


def refreshed_result(catalog: SourceCatalog, lines: dict[str, MonthTable], cfg: VariantConfig, state: str,
                     load_ts: datetime | None = None) -> DataFrame:
    """The job's 73 columns from the refreshed state; only rows that can coincide are made distinct by a shuffle."""
    return crm_enrichment(refresh(catalog, lines, cfg, state).monthly, catalog.table("account_xref"), cfg, load_ts, proven=True)
