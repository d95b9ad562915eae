"""Logical table name -> DataFrame.

The job never names a physical location: an environment binds each of the six
logical tables to a path or a table, and the pipeline asks the catalog. Every
read is conformed to the declared input contract by name, without case: wider
tables and records, other column orders and upper-case names bind to the same
columns. Only the declared fields are read, and filters on columns that need
no cast reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesfacts.schemas import INPUT_SCHEMAS

LOGICAL_TABLES = tuple(INPUT_SCHEMAS)


def _find(fields: list[T.StructField], name: str, where: str) -> T.StructField:
    found = [f for f in fields if f.name.lower() == name.lower()]
    if not found:
        raise ValueError(f"{where}: missing column {name}")
    if len(found) > 1:
        raise ValueError(f"{where}: column {name} is ambiguous: {[f.name for f in found]}")
    return found[0]


_INTEGER_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def _fits(have: T.DataType, want: T.DecimalType) -> bool:
    """Whether every value of the type ``have`` is exactly a value of ``want``."""
    if isinstance(have, T.DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    return _INTEGER_DIGITS.get(have, 99) <= want.precision - want.scale


def _typed(c: Column, have: T.DataType, want: T.DataType, where: str) -> Column:
    """``c`` as ``want``; a number that would be rounded is an error, never a cut."""
    if have == want:
        return c
    if isinstance(want, T.DecimalType) and not _fits(have, want):
        raise ValueError(f"{where}: {have.simpleString()} is wider than the contract's {want.simpleString()}")
    return c.cast(want.simpleString())


def _record(c: Column, have: T.StructType, want: T.StructType, where: str) -> Column:
    """A record with the declared fields, by name. A NULL record stays NULL, and
    reading one of its fields still prunes the others at the scan."""
    actual = {f.name: _find(have.fields, f.name, where) for f in want.fields}
    extra = [f.name for f in have.fields if f.name not in {a.name for a in actual.values()}]
    if extra:
        c = c.dropFields(*[f"`{n}`" for n in extra])
    for f in want.fields:
        if actual[f.name].dataType != f.dataType:
            name = actual[f.name].name
            c = c.withField(f"`{name}`", _typed(c[name], actual[f.name].dataType, f.dataType, f"{where}.{name}"))
    return c


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a logical table, found by name and cast where the type differs."""
    cols = []
    for f in INPUT_SCHEMAS[name].fields:
        have = _find(df.schema.fields, f.name, name)
        c = F.col(f"`{have.name}`")
        where = f"{name}.{have.name}"
        if isinstance(f.dataType, T.StructType):
            if not isinstance(have.dataType, T.StructType):
                raise ValueError(f"{where}: a record is expected, not {have.dataType.simpleString()}")
            c = _record(c, have.dataType, f.dataType, where)
        else:
            c = _typed(c, have.dataType, f.dataType, where)
        cols.append(c.alias(f.name))
    return df.select(*cols)


class SourceCatalog:
    """Binds logical names to DataFrame factories; each call builds a fresh, lazy DataFrame."""

    def __init__(self, spark: SparkSession, factories: Mapping[str, Callable[[], DataFrame]]):
        missing = set(LOGICAL_TABLES) - set(factories)
        if missing:
            raise ValueError(f"unbound tables: {sorted(missing)}")
        self.spark = spark
        self._factories = dict(factories)
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The conformed DataFrame of a logical table. It is built once per
        catalog and shared (a DataFrame is an immutable lazy plan), which saves
        repeated file listing and footer reads on the driver."""
        if name not in self._tables:
            self._tables[name] = conform(self._factories[name](), name)
        return self._tables[name]

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet"):
        """Bind each logical table to a file path (parquet by default)."""
        return cls(spark, {n: (lambda p=p: spark.read.format(fmt).load(p)) for n, p in paths.items()})

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: Mapping[str, str]):
        """Bind each logical table to a metastore table name."""
        return cls(spark, {n: (lambda t=t: spark.table(t)) for n, t in tables.items()})

    @classmethod
    def from_standins(cls, spark: SparkSession, root: str):
        """Derive the six tables from the TPC-H-like test tables under ``root``."""
        from salesfacts.sources.standins import BUILDERS, BaseTables

        base = BaseTables(spark, root)
        return cls(spark, {n: (lambda b=b: b(base)) for n, b in BUILDERS.items()})


def write_standins(spark: SparkSession, root: str, out_dir: str, files: int | None = None) -> dict[str, str]:
    """Materialise the stand-ins as parquet once (e.g. for benchmarks), so later
    runs scan real files with pushed filters. Each table is written as the tasks
    that compute it give it, a file a task, without a further shuffle, or dealt
    to ``files`` files. The line tables' join is computed once.
    Returns logical name -> path."""
    from salesfacts.sources.standins import BUILDERS, BaseTables, kept_lines

    base = BaseTables(spark, root)
    paths = {}
    with kept_lines(spark, root):
        for name, build in BUILDERS.items():
            path = f"{out_dir}/{name}"
            rows = conform(build(base), name)
            (rows.repartition(files) if files else rows).write.mode("overwrite").option("compression", "zstd").parquet(path)
            paths[name] = path
    return paths
