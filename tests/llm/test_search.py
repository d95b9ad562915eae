"""Both searches against brute force, with equal vectors, ties and invalid rows."""

import numpy as np
import pytest

from salesfacts.llm.ann import hilbert_key, search
from salesfacts.llm.topk import top_k


def _brute(vectors, every, k, fn):
    ids = np.array(sorted(vectors))
    m = np.stack([fn(np.array(vectors[i], dtype=float)) for i in ids])
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = m @ m[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    out = {i: v / np.linalg.norm(v) for i, v in enumerate(rng.standard_normal((900, 12)))}
    for i in range(200, 480):
        out[i] = out[200]  # a third of all rows are one vector
    for i in range(500, 600):
        out[i] = out[500] + 1e-3 * rng.standard_normal(12)
    return {i: [float(np.float32(x)) for x in v] for i, v in out.items()}


@pytest.fixture(scope="module")
def table(spark, vectors):
    bad = [(5000, None), (5001, [None] * 12), (5002, [float("nan")] * 12), (5003, [float("inf")] * 12), (None, [1.0] * 12), (0, vectors[0])]
    rows = [(i, [*v], 7) for i, v in vectors.items()] + [(i, v, 7) for i, v in bad]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def test_exact_top_k(table, vectors):
    want = _brute(vectors, 50, 5, lambda x: np.floor(256 * x))
    got = {}
    for r in top_k(table, "vec_id", "embedding", 5, 50, block=128).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], float(r["score"])))
    assert got == want


def test_more_neighbours_than_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in top_k(df, "vec_id", "embedding", 5, 50).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 128 * 256), (0, 2, 2, -256 * 256)]
    near = [tuple(r)[:3] for r in search(df, "vec_id", "embedding", 20, 20).orderBy("rank").collect()]
    assert near == [(0, 1, 1), (0, 2, 2)]
    assert top_k(df.where("false"), "vec_id", "embedding", 5, 50).count() == 0
    assert search(df.where("false"), "vec_id", "embedding", 20, 20).count() == 0


def test_neighbours_reach_the_recall(table, vectors):
    want = _brute(vectors, 20, 20, lambda x: x)
    got = {}
    for r in search(table, "vec_id", "embedding", 20, 20, block=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {q: {i: s for i, s in v} for q, v in want.items()}
    assert all(abs(s - float(np.dot(vectors[q], vectors[i]))) < 1e-9 for q, v in got.items() for i, s in v)
    assert [i for i, _ in got[200 if 200 in got else 220]] == [i for i, _ in want[200]] and exact  # ties go to the smaller ids


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = hilbert_key(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()
