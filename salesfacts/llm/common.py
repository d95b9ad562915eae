"""Helpers shared by the operators: table access, Arrow maps, checkpoints."""

from __future__ import annotations

import gc
import itertools
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from salesfacts.session import ensure_checkpoint_dir
from salesfacts.sources.files import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RELEASE_EVERY = 8  # checkpoints after which finished ones may go
_made = itertools.count(1)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the session's shared spark.checkpoint.dir and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if next(_made) % RELEASE_EVERY == 0:
        release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files, broadcasts and checkpoints of finished rounds.

    It acts on objects that the driver's JVM has collected; an iterative job calls
    this between rounds instead of waiting for the periodic collection.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table under spark.checkpoint.dir and read back.

    As ``checkpointed``, for steps of iterations: the table is compressed and its size
    is known to the planner. Such tables stay until ``discard`` or until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if next(_made) % RELEASE_EVERY == 0:
        release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    _tables[id(out)] = (weakref.ref(out), path)
    return out


_tables: dict[int, tuple[weakref.ref, str]] = {}
_counts: dict[int, tuple[weakref.ref, int]] = {}


def counted(df: DataFrame) -> DataFrame:
    """As ``stored``; the rows are counted as they are written, so that ``rows_in`` needs no job."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")))
    _counts[id(out)] = (weakref.ref(out, lambda _, key=id(out): _counts.pop(key, None)), seen.get["n"])
    return out


def rows_in(df: DataFrame) -> int:
    """The rows of ``df``: known of a table that ``counted`` wrote, of others by a job."""
    ref, n = _counts.get(id(df), (None, 0))
    return n if ref is not None and ref() is df else df.count()


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once all that is computed from them is written; others are left alone."""
    for df in tables:
        ref, path = _tables.pop(id(df), (None, None))
        if ref is not None and ref() is df:
            remove(df.sparkSession, path)


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted: by one sort, which for 64-bit numbers is many times faster than np.unique."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


SMALL_ROWS = 2_000_000  # rows of a few numbers up to which a side is broadcast


def small(df: DataFrame) -> DataFrame:
    """``df`` (materialised, rows of a few numbers) marked for broadcast if it has at most ``SMALL_ROWS`` rows."""
    n = rows_in(df) if id(df) in _counts else df.limit(SMALL_ROWS + 1).count()
    return F.broadcast(df) if n <= SMALL_ROWS else df


FEW_ROWS = 50_000  # rows of a few numbers that one partition holds


def few(df: DataFrame) -> DataFrame:
    """``df`` (materialised, rows of a few numbers) in a partition for each ``FEW_ROWS`` rows, if that makes fewer; in a
    single one grouping and joining need no shuffle, so rounds on few rows do not cost a task for each shuffle partition."""
    return df.coalesce(max(1, -(-rows_in(df) // FEW_ROWS)))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``max_bytes`` (one long value makes a run of its own)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def append_columns(df: DataFrame, column: str, fields: list[StructField],
                   make: Callable[[], Callable[[list], list[list]]], max_bytes: int = 3 << 20) -> DataFrame:
    """``df`` plus ``fields`` computed from ``column`` in Arrow batches.

    ``make`` runs once a task and returns a function from the values of a run of
    rows to one list per field. Columns of ``df`` named like a new field are
    replaced; all others pass through.
    """
    base = df.drop(*[f.name for f in fields if f.name.lower() != column.lower()])
    schema = StructType([f for f in base.schema.fields if f.name.lower() not in {x.name.lower() for x in fields}] + fields)
    arrow = to_arrow_schema(schema)
    kept = [f.name for f in schema.fields[:len(schema.fields) - len(fields)]]

    def run(batches):
        fn = make()
        for batch in batches:
            for part in slices(batch, column, max_bytes):
                new = fn(part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(v, t.type) for v, t in zip(new, list(arrow)[len(kept):])], schema=arrow)

    return base.mapInArrow(run, schema)
