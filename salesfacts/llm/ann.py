"""Approximate nearest neighbours on shifted space-filling curves.

The vectors are projected to a few dimensions, several times by different random
directions. Each time the projected points, shifted by a random offset, get a
Hilbert key; the table is range-partitioned by it and cut into blocks of
consecutive vectors. A query is compared with the blocks whose ranks lie in a
window around its own, on every curve; the results merge and the exact inner
products rank them.

Inner products of vectors of different norms are turned into nearness by one more
component, sqrt(largest norm^2 - norm^2), for the projection only.

The window is fitted: for ``fit_queries`` queries (a bounded sample by hash) the
true neighbours are found by brute force over all vectors, and the window is the
least one that holds ``target`` of them on at least one curve. So clustered data
get narrow windows. On data without structure no curve brings neighbours together,
and the fitted windows cover about as much as a full comparison in blocks would;
every vector is indexed in either case, and none is capped.

Equal vectors are one class (``vectors.classes``).

Defined results: vectors that are null, zero or hold null or non-finite
components take no part; missing components count as 0; of rows that repeat an id
the smallest vector stands; an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesfacts.llm.common import checkpointed
from salesfacts.llm.topk import expand
from salesfacts.llm.vectors import best, classes, matrix, valid_vectors

CURVES, DIMS, BITS = 8, 4, 10
BLOCK = 2048
FIT_QUERIES, TARGET = 256, 0.95
SEED = 20


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows, dims) with ``bits`` bits a dimension.

    Each level is a Gray-code walk over the sub-cubes in a frame that the level above
    sets: the corner at which the cube is entered and the axis along which it is crossed.
    """
    n, dims = cells.shape
    full = (1 << dims) - 1

    def rotate(x, by):  # to the left, within dims bits
        by = by % dims
        return ((x << by) | (x >> (dims - by))) & full

    def trailing_ones(x):
        count = np.zeros_like(x)
        for b in range(dims):
            count += (x & ((2 << b) - 1)) == ((2 << b) - 1)
        return count

    corner, axis, key = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for level in range(bits - 1, -1, -1):
        cube = (((cells >> level) & 1) << np.arange(dims)).sum(axis=1)
        walk = rotate(cube ^ corner, dims - 1 - axis)
        index = walk.copy()  # Gray code to rank
        for shift in range(1, dims):
            index ^= walk >> shift
        key = (key << dims) | index
        before = np.where(index > 0, (index - 1) & ~1, 0)
        corner ^= rotate(before ^ (before >> 1), axis + 1)
        crossed = np.where(index == 0, 0, trailing_ones(np.where(index % 2 == 0, index - 1, index)) % dims)
        axis = (axis + crossed + 1) % dims
    return key


def _directions(width: int, curves: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.standard_normal((width + 1, curves * dims)), rng.random((curves, dims))


def _project(vectors: np.ndarray, largest: float, directions: np.ndarray) -> np.ndarray:
    rest = np.sqrt(np.maximum(largest - (vectors ** 2).sum(axis=1), 0))
    return np.hstack([vectors, rest[:, None]]) @ directions


def _keys(cls: DataFrame, width: int, largest: float, curves: int, dims: int, bits: int) -> DataFrame:
    """``cls`` (cid, vec) exploded over the curves: curve, key, cid, vec."""
    directions, shifts = _directions(width, curves, dims)
    rows = cls.select("cid", "vec")

    def moments(batches):
        for batch in batches:
            p = _project(matrix(batch.column("vec"), width), largest, directions)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p.shape[1])), pa.array(np.full(p.shape[1], float(len(p)))),
                                              pa.array(p.sum(axis=0)), pa.array((p ** 2).sum(axis=0))], names=["j", "n", "s", "ss"])

    stats = rows.mapInArrow(moments, "j long, n double, s double, ss double").groupBy("j").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()  # curves * dims rows
    mean, spread = np.zeros(curves * dims), np.ones(curves * dims)
    for r in stats:
        mean[r["j"]] = r["s"] / r["n"]
        spread[r["j"]] = math.sqrt(max(r["ss"] / r["n"] - mean[r["j"]] ** 2, 1e-12))

    def run(batches):
        for batch in batches:
            p = (_project(matrix(batch.column("vec"), width), largest, directions) - mean) / spread
            even = 1 / (1 + np.exp(np.clip(-1.702 * p, -60, 60)))  # about uniform for bell-shaped projections
            for c in range(curves):
                cells = ((even[:, c * dims:(c + 1) * dims] + shifts[c]) / 2 * (1 << bits)).astype(np.int64)
                key = hilbert_key(np.minimum(cells, (1 << bits) - 1), bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), c, dtype=np.int32)), pa.array(key), batch.column("cid"), batch.column("vec")],
                                                 names=["curve", "key", "cid", "vec"])

    return rows.mapInArrow(run, "curve int, key long, cid long, vec array<double>")


def build_index(cls: DataFrame, curves: int = CURVES, dims: int = DIMS, bits: int = BITS, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Blocks of consecutive vectors on each curve: curve, bid, first (rank of its first vector), n, v (cid, vec).

    Returns the blocks (materialised) and the vectors' width.
    """
    size = cls.agg(F.max(F.size("vec")).alias("d"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    width, largest = size["d"] or 1, size["m"] or 0.0
    keyed = _keys(cls, width, largest, curves, dims, bits)
    shares = int(cls.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches):
        """A sorted partition into blocks; a block ends at ``block`` vectors or with its curve."""
        held: list[pa.RecordBatch] = []

        def flush(rows):
            t = pa.Table.from_batches(rows).combine_chunks()
            v = pa.StructArray.from_arrays([t.column("cid").combine_chunks(), t.column("vec").combine_chunks()], names=["cid", "vec"])
            return pa.RecordBatch.from_arrays([t.column("curve").combine_chunks().slice(0, 1), t.column("key").combine_chunks().slice(0, 1),
                                               t.column("cid").combine_chunks().slice(0, 1), pa.array([t.num_rows]),
                                               pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), v)],
                                              names=["curve", "key", "low", "n", "v"])

        count, last = 0, None
        for batch in batches:
            curve = batch.column("curve").to_numpy()
            at = 0
            while at < len(curve):
                if last is not None and (count == block or curve[at] != last):
                    yield flush(held)
                    held, count = [], 0
                last = curve[at]
                same = int(np.searchsorted(curve[at:], last, side="right"))
                take = min(same, block - count)
                held.append(batch.slice(at, take))
                count, at = count + take, at + take
        if held:
            yield flush(held)

    sorted_rows = keyed.repartitionByRange(shares, "curve", "key", "cid").sortWithinPartitions("curve", "key", "cid")
    blocks = checkpointed(sorted_rows.mapInArrow(cut, "curve int, key long, low long, n long, v array<struct<cid: long, vec: array<double>>>"))
    along = Window.partitionBy("curve").orderBy("key", "low")  # one row a block
    order = blocks.select("curve", "key", "low", (F.sum("n").over(along) - F.col("n")).alias("first"), F.row_number().over(along).alias("bid"))
    return checkpointed(blocks.join(order, ["curve", "key", "low"]).select("curve", "bid", "first", "n", "v")), width


def _members(blocks: DataFrame) -> DataFrame:
    return blocks.select("curve", "first", F.posexplode("v").alias("i", "x")).select(
        "curve", (F.col("first") + F.col("i")).alias("rank"), F.col("x.cid").alias("cid"))


def fit_window(blocks: DataFrame, cls: DataFrame, queries: DataFrame, width: int, k: int, fit_queries: int, target: float) -> int:
    """The least window (ranks to either side) that holds ``target`` of the sampled queries' true neighbours on some curve."""
    sample = queries.orderBy(F.xxhash64("cid"), "cid").limit(fit_queries).select("cid", "vec").collect()  # fit_queries rows
    if not sample:
        return 0
    ids = np.array([r["cid"] for r in sample])
    vectors = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        vectors[i, :len(r["vec"])] = r["vec"]

    def run(batches):
        for batch in batches:
            cids = batch.column("cid").to_numpy()
            scores = vectors @ matrix(batch.column("vec"), width).T
            scores[ids[:, None] == cids[None, :]] = -np.inf
            for i, at in enumerate(best(scores, cids, k)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), ids[i])), pa.array(cids[at]), pa.array(scores[i, at])], names=["q", "cid", "score"])

    near = (cls.select("cid", "vec").mapInArrow(run, "q long, cid long, score double").where(F.col("score") > float("-inf"))
            .withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cid"))).where(F.col("_r") <= k))
    ranks = _members(blocks)
    asked = ranks.join(F.broadcast(cls.sparkSession.createDataFrame([(int(i),) for i in ids], "q long")), F.col("cid") == F.col("q")).select(
        "q", "curve", F.col("rank").alias("qrank"))
    gaps = (near.select("q", "cid").join(ranks, "cid").join(asked, ["q", "curve"])
            .groupBy("q", "cid").agg(F.min(F.abs(F.col("rank") - F.col("qrank"))).alias("gap")))
    got = gaps.agg(F.percentile("gap", target).alias("w")).first()["w"]
    return math.ceil(got or 0)


def search(df: DataFrame, id_col: str, vector_col: str, k: int, query_every: int, curves: int = CURVES, block: int = BLOCK,
           fit_queries: int = FIT_QUERIES, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, by inner product."""
    rows = checkpointed(valid_vectors(df, id_col, vector_col, zero_ok=False))
    keep = k + 1
    cls = checkpointed(classes(rows, keep))
    asked = rows.where(F.col("vec_id") % query_every == 0).groupBy("vec").agg(F.min("vec_id").alias("_q")).select("vec")
    queries = checkpointed(cls.join(asked, "vec", "left_semi").select("cid", "vec"))
    blocks, width = build_index(cls, curves, block=block)
    window = fit_window(blocks, cls, queries, width, k, fit_queries, target)

    flagged = queries.select(F.col("cid").alias("_q"))
    homes = (blocks.select("curve", "bid", "first", "n", F.explode("v").alias("x")).join(flagged, F.col("x.cid") == F.col("_q"))
             .groupBy("curve", "bid").agg(F.first("first").alias("qfirst"), F.first("n").alias("qn"), F.collect_list("x").alias("q")))
    # A home block's queries see the blocks that its window overlaps: an equi-join on spans of `block` ranks.
    span = lambda a, b: F.explode(F.sequence((a / block).cast("long"), (b / block).cast("long")))
    reach = homes.select("curve", F.col("bid").alias("qbid"), span(F.greatest(F.col("qfirst") - window, F.lit(0)), F.col("qfirst") + F.col("qn") - 1 + window).alias("_s"))
    lie = blocks.select("curve", "bid", span(F.col("first"), F.col("first") + F.col("n") - 1).alias("_s"))
    pairs = reach.join(lie, ["curve", "_s"]).select("curve", "qbid", "bid").distinct()
    met = (pairs.join(homes.select("curve", F.col("bid").alias("qbid"), "q"), ["curve", "qbid"])
           .join(blocks.select("curve", "bid", "v"), ["curve", "bid"]).select("q", "v"))

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                q, v = row.column("q").flatten(), row.column("v").flatten()
                cids = v.field("cid").to_numpy()
                scores = matrix(q.field("vec"), width) @ matrix(v.field("vec"), width).T
                top = best(scores, cids, keep)
                n = [len(t) for t in top]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q.field("cid").to_numpy(), n)), pa.array(cids[np.concatenate(top)]),
                                                  pa.array(np.concatenate([s[t] for s, t in zip(scores, top)]))], names=["qcid", "cid", "score"])

    near = met.mapInArrow(compare, "qcid long, cid long, score double").groupBy("qcid", "cid").agg(F.max("score").alias("score"))
    first = near.withColumn("_r", F.row_number().over(Window.partitionBy("qcid").orderBy(F.desc("score"), "cid"))).where(F.col("_r") <= keep)
    return expand(first.drop("_r"), rows, cls, k, query_every)
