"""Vector tables for the searches: valid rows, classes of equal vectors, block rows.

Equal vectors form one class that keeps its ``keep`` smallest ids, which is all a
search for the nearest ``keep - 1`` others can return of it. So a vector that a
third of all rows share is compared once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(df: DataFrame, id_col: str, vector_col: str, zero_ok: bool) -> DataFrame:
    """(vec_id, vec as array<double>): rows with an id and finite components (and one that is not 0, unless ``zero_ok``).

    Of rows that repeat an id the smallest vector stands.
    """
    good = F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero_ok:
        good &= F.exists("vec", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    return rows.where(F.col("vec_id").isNotNull() & good).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: cid (its smallest id), vec and ids (its ``keep`` smallest).

    The ranked limit is applied before the shuffle as well, so a class of any size moves ``keep`` rows a task.
    """
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("_r") <= keep)
    return first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("cid", F.col("ids")[0])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a (rows, width) array; missing components count as 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lens) and (lens == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lens), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(np.arange(len(lens)), lens), at] = flat
    return out


def best(scores: np.ndarray, cids: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the positions of its k largest scores, ties to the smaller id."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k][:, None]
    else:
        least = np.full((len(scores), 1), -np.inf)
    out = []
    for row, bar in zip(scores, least):
        at = np.flatnonzero(row >= bar[0])
        out.append(at[np.lexsort((cids[at], -row[at]))[:k]])
    return out
