"""Tables kept by month, whose months are replaced all or none.

A run writes its months into a folder of its own, reads them back, compares rows and
content digests with what the write saw pass, and only then names the folders in
the table's manifest: one small file that is added by a single rename. Readers go by
the manifest, so they see a run's months all at once or not at all; a run that fails
at any point before leaves the old months as they were. Months that a run does not
write keep their folders. One writer at a time; readers need no lock.

Layout: ``<path>/data/<run>/month_bin=<month>/*.parquet`` and ``<path>/manifest/*.parquet``.
A month's rows are sorted by ``sort`` within each file, so row-group statistics on
these columns let a scan skip what a later floor excludes.

Each month's manifest row carries its rows and digest (a sum of row hashes, whatever
their order), by which a reader knows a changed month without reading it, and a
``basis``: what the month was computed from, in the writer's words.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesfacts.sources.files import children, exists, remove

BIN = "month_bin"
NO_MONTH = "none"
MAX_RECORDS_PER_FILE = 5_000_000
MANIFEST = "version long, month string, folder string, rows long, digest string, basis string, schema string"


class VerificationError(RuntimeError):
    """What was read back is not what was written; nothing was replaced."""


@dataclass(frozen=True)
class Month:
    """A month's entry: where it is (None: it has no rows), its rows and digest, and what it was made from."""

    month: str
    folder: str | None
    rows: int
    digest: str
    basis: str


def digest(df: DataFrame) -> Column:
    """An aggregate that is equal for equal multisets of rows."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")


def _nullable(schema: StructType) -> str:
    """The schema as JSON with every column nullable, as files are read back."""
    text = schema.json()
    for key in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{key}":false', f'"{key}":true')
    return text


class MonthTable:
    def __init__(self, spark: SparkSession, path: str, sort: Iterable[str] = ()):
        self.spark, self.path, self.sort = spark, path.rstrip("/"), tuple(sort)

    # --- reading ---------------------------------------------------------------

    def _manifest(self) -> list:
        """The latest entry of each month; as many rows as the table has had months."""
        at = f"{self.path}/manifest"
        if not exists(self.spark, at):
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(at)
        last = rows.groupBy("month").agg(F.max_by(F.struct("version", "folder", "rows", "digest", "basis", "schema"), "version").alias("m"))
        return last.select("month", "m.*").collect()

    def months(self) -> dict[str, Month]:
        """The months of the table, those without rows included."""
        return {r["month"]: Month(r["month"], r["folder"], r["rows"], r["digest"], r["basis"]) for r in self._manifest() if r["basis"] is not None}

    def read(self, months: Iterable[str] | None = None) -> DataFrame:
        """The rows of all months, or of the given ones: only their folders are listed and read."""
        rows = self._manifest()
        if not rows:
            raise ValueError(f"{self.path}: nothing was published")
        schema = StructType.fromJson(json.loads(max(rows, key=lambda r: r["version"])["schema"]))
        wanted = None if months is None else set(months)
        folders = sorted(r["folder"] for r in rows if r["folder"] and (wanted is None or r["month"] in wanted))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    # --- writing ---------------------------------------------------------------

    def publish(self, df: DataFrame, month: Column | str, months: Iterable[str] | None = None, basis: Mapping[str, str] | None = None,
                before_commit: Callable[[], None] | None = None) -> list[str]:
        """Replace the whole table by ``df``, or only the given ``months`` by its rows; returns the months now replaced.

        ``month`` (a column or an SQL expression) names a row's month. With ``months``, a row of any other month is an error, and a given month without
        rows is empty from now on. ``before_commit`` runs when all is verified and nothing replaced.
        """
        held = self._manifest()
        schema = _nullable(df.schema)
        if held and months is not None and (known := max(held, key=lambda r: r["version"])["schema"]) != schema:
            raise ValueError(f"{self.path}: the columns differ from the table's: {schema} / {known}")
        run = f"data/{uuid.uuid4().hex}"
        staged = self._stage(df, F.expr(month) if isinstance(month, str) else month, f"{self.path}/{run}")
        if months is None:
            replaced = set(staged) | {r["month"] for r in held}
        else:
            replaced = set(months)
            if strange := set(staged) - replaced:
                raise VerificationError(f"{self.path}: rows of months that are not replaced: {sorted(strange)}")
        if before_commit:
            before_commit()
        version = max((r["version"] for r in held), default=0) + 1
        entries = []
        for m in sorted(replaced):
            rows, content = staged.get(m, (0, "0"))
            kept = m in staged or months is not None
            entries.append((version, m, f"{run}/{BIN}={m}" if m in staged else None, rows, content,
                            (basis or {}).get(m, "") if kept else None, schema))
        if entries:
            self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return sorted(replaced)

    def _stage(self, df: DataFrame, month: Column, folder: str) -> dict[str, tuple[int, str]]:
        """Write ``df`` by month and read it back; rows and digest of each month, once both agree in all."""
        passed = Observation()
        binned = df.withColumn(BIN, F.coalesce(month.cast("string"), F.lit(NO_MONTH)))
        # The rebalance hint groups a month into few files; AQE deals a large month to several tasks.
        ordered = binned.hint("rebalance", BIN).sortWithinPartitions(BIN, *self.sort)
        seen = ordered.observe(passed, F.count(F.lit(1)).alias("rows"), digest(binned).alias("digest"))
        seen.write.partitionBy(BIN).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "zstd").parquet(folder)
        back = self.spark.read.schema(binned.schema).parquet(folder)
        found = back.groupBy(BIN).agg(F.count(F.lit(1)).alias("rows"), digest(back).alias("digest"), digest(df).alias("own")).collect()
        wrote = passed.get
        if (sum(r["rows"] for r in found), str(sum(int(r["digest"]) for r in found))) != (wrote["rows"], wrote["digest"]):
            raise VerificationError(f"{folder}: {wrote} went in, {[(r[BIN], r['rows'], r['digest']) for r in found]} came back")
        return {r[BIN]: (r["rows"], r["own"]) for r in found}

    # --- clearing --------------------------------------------------------------

    def expire(self) -> list[str]:
        """Remove month folders that no manifest entry names any more, failed runs' included; no reader may be at work."""
        kept = {r["folder"] for r in self._manifest() if r["folder"]}
        gone = []
        for run in children(self.spark, f"{self.path}/data"):
            months = [f"data/{run}/{m}" for m in children(self.spark, f"{self.path}/data/{run}") if m.startswith(f"{BIN}=")]
            gone += [m for m in months if m not in kept and remove(self.spark, f"{self.path}/{m}")]
            if not kept & set(months):
                remove(self.spark, f"{self.path}/data/{run}")
        return sorted(gone)
