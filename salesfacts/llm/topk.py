"""Exact top-k search by a three-phase uniform threshold.

The components are cut into ``lists`` ranges. For a query each range is a list of
local scores (partial inner products) over all vectors; a vector's score is the
sum over the lists.

1. Each list gives its k best local scores. The exact totals of those vectors
   give a safe cutoff t: the k-th best of them is at most the k-th best of all.
2. Each query row carries its cutoff to all parts. Each list gives every entry of
   t / lists or more: a vector with a total of t or more has at least one.
3. A gathered vector that did not appear in all lists gets its missing local
   scores resolved; totals then decide, ties to the smaller id.

Vectors meet queries in blocks of bounded size. Equal vectors are one class
(``vectors.classes``); k + 1 classes are kept, as a query's own class may lead.

Defined results: invalid vectors (null, null or non-finite components) take no
part; missing components count as 0; of rows that repeat an id the smallest
vector stands; an empty table or one without queries gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesfacts.llm.common import checkpointed
from salesfacts.llm.vectors import best, classes, matrix, valid_vectors

BLOCK = 4096

GATHERED = "qcid long, chunk long, cids array<long>, scores array<double>"


def _arrow(rows, names, types):
    cols = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _gather(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """From rows that hold a block of query parts and a block of vector parts: a list's entries for each query.

    Without cutoffs the k best; with them all that reach a query's.
    """
    def run(batches):
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                q, v = row.column("q").flatten(), row.column("v").flatten()
                cids = v.field("cid").to_numpy()
                scores = matrix(q.field("part"), width) @ matrix(v.field("part"), width).T
                cut = q.field("cut").to_numpy(zero_copy_only=False)
                chunk = row.column("chunk")[0].as_py()
                if np.isnan(cut).all():
                    picked = best(scores, cids, k)
                else:
                    picked = [np.flatnonzero(s >= c) for s, c in zip(scores, cut)]
                rows = [(qc, chunk, cids[at], s[at]) for qc, at, s in zip(q.field("cid").to_numpy().tolist(), picked, scores) if len(at)]
                yield _arrow(rows, ["qcid", "chunk", "cids", "scores"], types)

    return pairs.mapInArrow(run, GATHERED)


def _resolve(found: DataFrame, width: int, k: int) -> DataFrame:
    """From rows that hold a block of vectors and the entries gathered in it: each query's k best totals."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                v, found = row.column("v").flatten(), row.column("found").flatten()
                cids, vectors = v.field("cid").to_numpy(), matrix(v.field("part"), width)
                order = np.argsort(cids, kind="stable")
                queries = matrix(found.field("qvec"), width)
                rows = []
                for n, (qc, entries) in enumerate(zip(found.field("qcid").to_pylist(), found.field("cids"))):
                    at = order[np.searchsorted(cids[order], np.asarray(entries.values))]
                    scores = vectors[at] @ queries[n]
                    top = best(scores[None, :], cids[at], k)[0]
                    rows += [(qc, int(cids[at[j]]), int(scores[j])) for j in top]
                yield _arrow(rows, ["qcid", "cid", "score"], [pa.int64()] * 3)

    return found.mapInArrow(run, "qcid long, cid long, score long")


def top_k(df: DataFrame, id_col: str, vector_col: str, k: int, query_every: int, scale: int = 256, lists: int = 2,
          block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best by the integer inner product of floor(scale * component)."""
    rows = valid_vectors(df, id_col, vector_col, zero_ok=True).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))
    rows = checkpointed(rows)
    keep = k + 1
    cls = checkpointed(classes(rows, keep))
    size = cls.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    width = size["d"] or 1
    part = math.ceil(width / lists)
    chunks = max(1, math.ceil(size["n"] / block))
    asked = rows.where(F.col("vec_id") % query_every == 0).groupBy("vec").agg(F.min("vec_id").alias("_q")).select("vec")
    queries = checkpointed(cls.join(asked, "vec", "left_semi").select(F.col("cid").alias("qcid"), F.col("vec").alias("qvec")))
    qblocks = max(1, math.ceil(queries.count() / block))

    def share(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n))

    pieces = F.explode(F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda g: F.struct(
        g.alias("g"), F.slice("vec", g * part + 1, F.lit(part)).alias("part"))))

    def blocks(frame: DataFrame) -> DataFrame:
        return frame.select("cid", F.col("cid").alias("_c"), "cut", share("cid", qblocks).alias("qb"), pieces.alias("p")).groupBy(
            "qb", "p.g").agg(F.collect_list(F.struct("cid", "cut", "p.part")).alias("q"))

    vectors = (cls.select("cid", share("cid", chunks).alias("chunk"), pieces.alias("p")).groupBy("chunk", "p.g")
               .agg(F.collect_list(F.struct("cid", "p.part")).alias("v"))
               .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1)))))
    asked_rows = queries.select(F.col("qcid").alias("cid"), F.col("qvec").alias("vec"))

    def entries(cuts: DataFrame) -> DataFrame:
        return _gather(vectors.join(blocks(cuts), ["qb", "g"]).select("chunk", "v", "q"), part, keep)

    # phase 1: local score lists, and the cutoff from the exact totals of what they name
    local = entries(asked_rows.withColumn("cut", F.lit(float("nan"))))
    named = local.select("qcid", F.explode("cids").alias("cid")).distinct()
    dot = F.aggregate(F.zip_with("vec", "qvec", lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    totals = named.join(queries, "qcid").join(cls.select("cid", "vec"), "cid").select("qcid", "cid", dot.alias("total"))
    kth = Window.partitionBy("qcid").orderBy(F.desc("total"), "cid")
    cutoffs = totals.withColumn("_r", F.row_number().over(kth)).where(F.col("_r") == keep).select("qcid", (F.col("total") / lists).alias("cut"))
    with_cut = checkpointed(queries.join(cutoffs, "qcid", "left").select(
        F.col("qcid").alias("cid"), F.col("qvec").alias("vec"), F.coalesce("cut", F.lit(float("-inf"))).alias("cut")))
    # phase 2: all entries that reach a query's share of its cutoff
    enough = entries(with_cut).groupBy("qcid", "chunk").agg(F.array_distinct(F.flatten(F.collect_list("cids"))).alias("cids"))
    # phase 3: exact totals, block by block, and the k best of all blocks
    per_chunk = (enough.join(queries, "qcid").withColumn("qb", share("qcid", qblocks)).groupBy("chunk", "qb")
                 .agg(F.collect_list(F.struct("qcid", "qvec", "cids")).alias("found")))
    whole = cls.select(share("cid", chunks).alias("chunk"), F.struct("cid", F.col("vec").alias("part")).alias("v")).groupBy("chunk").agg(
        F.collect_list("v").alias("v"))
    scored = _resolve(per_chunk.join(whole, "chunk").select("v", "found"), width, keep)
    first = scored.withColumn("_r", F.row_number().over(Window.partitionBy("qcid").orderBy(F.desc("score"), "cid"))).where(F.col("_r") <= keep)
    return expand(first.drop("_r"), rows, cls, k, query_every)


def expand(first: DataFrame, rows: DataFrame, cls: DataFrame, k: int, query_every: int) -> DataFrame:
    """From classes (qcid, cid, score) to rows: each query id gets its k best other ids."""
    lead = Window.partitionBy("qcid").orderBy(F.desc("score"), "vec_id")
    listed = (first.join(cls.select("cid", "ids"), "cid").select("qcid", "score", F.explode("ids").alias("vec_id"))
              .withColumn("_r", F.row_number().over(lead)).where(F.col("_r") <= k + 1)
              .groupBy("qcid").agg(F.sort_array(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("near")))
    ids = (rows.where(F.col("vec_id") % query_every == 0).join(cls.select("vec", F.col("cid").alias("qcid")), "vec")
           .select("qcid", F.col("vec_id").alias("query_id")))
    own = ids.join(listed, "qcid").select("query_id", F.slice(F.expr("filter(near, x -> x.vec_id <> query_id)"), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")
