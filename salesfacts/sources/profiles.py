"""Environment profiles: where each of the six logical tables is, in one JSON file.

    {"environment": "nonprod", "catalog": "spark_catalog", "namespace": "erp_np", "root": "s3://bucket/erp_np",
     "tables": {"order_lines": "orders_v2", "exchange_rates": {"path": "rates", "format": "parquet"}, ...}}

A name (or {"table": name}) is completed by the profile's catalog and namespace, a
relative path by its root. ``bind`` checks every binding and every table's schema
against the input contract before a row is read, and reports all that is wrong
at once, by logical name: what is not bound, what does not exist, which columns
are missing, ambiguous or too wide.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, conform


class ProfileError(ValueError):
    """All that is wrong with a profile, a line each."""


@dataclass(frozen=True)
class Binding:
    """A table name or a path, never both."""

    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def __str__(self) -> str:
        return self.table or f"{self.format}:{self.path}"

    def open(self, spark: SparkSession) -> DataFrame:
        """The bound table; its schema is read, its rows are not."""
        if self.table:
            return spark.table(self.table)
        return spark.read.format(self.format).options(**self.options).load(self.path)


@dataclass(frozen=True)
class Profile:
    environment: str
    bindings: Mapping[str, Binding]


def _qualified(name: str, catalog: str | None, namespace: str | None) -> str:
    """A table name completed from the left; dots inside backquotes do not count."""
    parts = re.findall(r"`(?:[^`]|``)*`|[^.`]+", name)
    before = [p for p in (catalog, namespace) if p]
    return ".".join([*before[:max(0, 3 - len(parts))], *parts] if len(parts) < 3 else parts)


def _located(path: str, root: str | None) -> str:
    return path if root is None or re.match(r"/|[A-Za-z][A-Za-z0-9+.-]*:", path) else f"{root.rstrip('/')}/{path}"


def parse_profile(text: str) -> Profile:
    """A profile from its JSON text; what cannot be bound at all is an error."""
    try:
        spec = json.loads(text)
    except json.JSONDecodeError as e:
        raise ProfileError(f"the profile is not JSON: {e}") from None
    if not isinstance(spec, dict) or not isinstance(spec.get("tables"), dict):
        raise ProfileError("a profile is an object with an object \"tables\"")
    known = {"environment", "catalog", "namespace", "root", "format", "tables"}
    wrong = [f"unknown setting {k}" for k in sorted(spec.keys() - known)]
    wrong += [f"unknown table {k}" for k in sorted(spec["tables"].keys() - set(LOGICAL_TABLES))]
    bindings = {}
    for name in LOGICAL_TABLES:
        at = spec["tables"].get(name)
        at = {"table": at} if isinstance(at, str) else at
        if at is None:
            wrong.append(f"{name}: not bound")
        elif not isinstance(at, dict) or ("table" in at) == ("path" in at) or at.keys() - {"table", "path", "format", "options"}:
            wrong.append(f"{name}: a binding is a table name, or an object with either table or path (and format, options)")
        elif "table" in at:
            bindings[name] = Binding(table=_qualified(at["table"], spec.get("catalog"), spec.get("namespace")))
        else:
            bindings[name] = Binding(path=_located(at["path"], spec.get("root")), format=at.get("format", spec.get("format", "parquet")),
                                     options=at.get("options", {}))
    environment = str(spec.get("environment", "unnamed"))
    if wrong:
        raise ProfileError("\n".join(f"profile {environment}: {w}" for w in wrong))
    return Profile(environment, bindings)


def load_profile(spark: SparkSession, path: str) -> Profile:
    """A profile from a file on any store that Spark reads."""
    return parse_profile(spark.read.text(path, wholetext=True).first()[0])


def bind(spark: SparkSession, profile: Profile) -> SourceCatalog:
    """The profile's tables as a catalog, each schema checked; no row is read."""
    frames, wrong = {}, []
    for name, binding in profile.bindings.items():
        try:
            frames[name] = binding.open(spark)
            conform(frames[name], name)
        except (ValueError, PySparkException) as e:
            wrong.append(f"{name} ({binding}): {str(e).splitlines()[0]}")
    if wrong:
        raise ProfileError("\n".join(f"profile {profile.environment}: {w}" for w in wrong))
    return SourceCatalog(spark, {n: (lambda d=d: d) for n, d in frames.items()})
