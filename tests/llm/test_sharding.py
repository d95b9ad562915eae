"""Shards against a plain sort, with repeated rows, null columns and every source's share."""

import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from salesfacts.llm import sharding
from salesfacts.llm.sharding import SEED, assign_shards, write_shards

from .conftest import DOC_SCHEMA, empty


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def _brute(rows, shards):
    """(id, text) of each (shard, slot) by the definition; rows are (id, text, source)."""
    named = [("s" + s if s is not None else "", _md5(f"{SEED}:{'' if i is None else f'd{i}'}:{'' if t is None else 't' + _md5(t)}"), i, t) for i, t, s in rows]
    by = {}
    for s, k, i, t in sorted(named, key=lambda r: (r[0], r[1])):
        by.setdefault(s, []).append((k, i, t))
    order = []
    for s, members in by.items():
        u = (int(_md5(f"{SEED}:{s}")[:8], 16) + 0.5) / 2.0 ** 32
        order += [((r + u) / len(members), s, k, r, i, t) for r, (k, i, t) in enumerate(members)]
    out = {}
    for at, row in enumerate(sorted(order, key=lambda r: r[:4])):
        shard = ((at + 1) * shards - 1) // len(order)
        out[shard, at - shard * len(order) // shards] = row[4:]
    return out


def _got(df):
    return {(r["shard"], r["slot"]): (r["doc_id"], r["size"], r["text_crc32"]) for r in df.collect()}


def _wanted(rows, shards):
    return {k: (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, (i, t) in _brute(rows, shards).items()}


def test_odd_rows_equal_the_plain_sort(odd_docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    assert _got(assign_shards(odd_docs, 5)) == _wanted(rows, 5)
    assert assign_shards(empty(odd_docs)).count() == 0


def test_a_hot_source_and_a_hot_row(spark, monkeypatch):
    """A third of all rows are one row, another third one source; many sources hold one row each."""
    monkeypatch.setattr(sharding, "COPIES", 7)
    rows = [(None, "the same", "hot")] * 400 + [(i, f"text {i}", "big") for i in range(400)] + [(i, f"t {i}", f"s{i}") for i in range(1000, 1350)]
    rows += [(2000 + i, None, None) for i in range(40)]
    df = spark.createDataFrame([(i, t, None, s, 1) for i, t, s in rows], DOC_SCHEMA)
    got = assign_shards(df, 16)
    assert _got(got) == _wanted(rows, 16)
    sizes = Counter(k[0] for k in _got(got))
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    for source, n in (("shot", 400), ("sbig", 400)):
        shares = Counter(r["shard"] for r in got.where(F.col("_source") == source).collect())
        assert max(abs(shares[s] - n / 16) for s in range(16)) <= 5  # the single rows fall as their seeded starts do


def test_whole_rows_are_written_by_shard(spark, odd_docs, tmp_path):
    more = odd_docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1.5))
    back = write_shards(more, str(tmp_path / "out"), 3)
    plain = lambda df: Counter(tuple(r) for r in df.select(odd_docs.columns).collect())
    assert plain(back) == plain(odd_docs)
    places = [(r["shard"], r["slot"]) for r in back.collect()]
    assert len(set(places)) == len(places) == 12 and Counter(s for s, _ in places) == {0: 4, 1: 4, 2: 4}
    for path in (tmp_path / "out").glob("shard=*/*.parquet"):
        slots = [r["slot"] for r in spark.read.parquet(str(path)).collect()]
        assert slots == sorted(slots)


def test_no_python_in_the_plan(odd_docs):
    plan = assign_shards(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
