"""Connected components of an edge table: numpy on as many edges as one task holds, DataFrame operations beyond."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesfacts.llm.common import counted as stored
from salesfacts.llm.common import discard, few, rows_in, small

EDGES = 3_000_000  # edges that one task holds


def joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least one that the edges (i, j) lead to: roots hang on to smaller ones, then paths are cut short."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while ((up := label[label]) != label).any():
            label = up
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _merged(edges: DataFrame) -> DataFrame:
    """(id, component) of the ids of each run of ``EDGES`` edges (a, b) of a partition, by that run alone."""
    def of(held: list[np.ndarray]) -> pa.RecordBatch:
        ids, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        i, j = at.reshape(2, -1)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[joined(len(ids), i, j)])], names=["id", "component"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if size and size + batch.num_rows > EDGES:
                yield of(held)
                held, size = [], 0
            held.append(np.stack([batch.column(c).to_numpy() for c in ("a", "b")]))
            size += batch.num_rows
        if size:
            yield of(held)

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "id long, component long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): for every id in ``edges`` (a, b) the smallest id reachable.

    Up to ``EDGES`` edges are merged in one task. Of more, each task first merges
    runs of its own into stars, and if these are still too many there follows a
    distributed union-find: each round gives an id the least label among its
    neighbours (aggregated before the shuffle, so a hub of any degree is no
    bottleneck) and then its label's label, which halves the depth of the label
    trees. Labels are stored each round, so the lineage stays short. Few edges are
    kept in one partition, where a round needs no shuffle.
    """
    edges, stars = edges.where("a <> b"), None
    size = edges.count()
    if size > EDGES:
        edges = stars = stored(_merged(edges).where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b")))
        size = rows_in(edges)
    if size <= EDGES:
        labels = stored(_merged(edges.coalesce(1)))
        discard(*([] if stars is None else [stars]))
        return labels
    pair = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")
    table = stored(few(edges).select(pair).select("p.a", "p.b").distinct())
    discard(*([] if stars is None else [stars]))
    both = few(table)
    labels = stored(both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("id"), F.least("a", "_m").alias("component")))
    while True:
        known = small(labels)  # broadcast while it is small: then a round has one shuffle
        near = both.join(known, both["b"] == known["id"]).groupBy("a").agg(F.min("component").alias("_m"))
        old = known.select(F.col("id").alias("_id"), F.col("component").alias("_old"))
        up = known.select(F.col("id").alias("_up"), F.col("component").alias("_root"))
        step = near.join(old, near["a"] == old["_id"]).select("_id", "_old", F.least("_old", "_m").alias("_new"))
        before, labels = labels, stored(step.join(up, F.col("_new") == F.col("_up")).select(
            F.col("_id").alias("id"), F.least("_new", "_root").alias("component"), "_old"))
        discard(before)
        if not labels.where(F.col("_old") != F.col("component")).limit(1).count():
            discard(table)
            return labels
