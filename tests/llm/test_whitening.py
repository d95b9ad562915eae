"""Whitening against exact rational moments, and the eigenvectors on clustered spectra."""

from fractions import Fraction

import numpy as np
import pytest

from salesfacts.llm.queries import QUERIES
from salesfacts.llm.whitening import eigenvectors, moments, whitened_embeddings, good_vector

from conftest import SF_SMALL

from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, n string"


def _with_spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(q), dtype=np.longdouble) - 0.5 * (q.T @ q))
    v = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (v + v.T) / 2, q


@pytest.mark.parametrize("values", [
    np.linspace(5, 1, 24),
    [3, 2, 1 + 3e-9, 1 + 2e-9, 1 + 1e-9, 1, 0.5],  # closer than float32 tells apart
    [7, 2, 2, 2, 1, 1e-6, 1e-6, 0],  # equal ones: any basis of their space
    [1e12, 1e3, 1, 1e-3], [4.0], [1, 1, 1],
], ids=["apart", "cluster", "equal", "scales", "one", "identity"])
def test_eigenvectors_to_the_last_digits(values):
    v, q = _with_spectrum(values)
    e, x = eigenvectors(v)
    size = float(max(values))
    assert np.abs(e - np.array(sorted(values, reverse=True), dtype=np.longdouble)).max() <= 1e-16 * size
    assert np.abs(x.T @ x - np.eye(len(x))).max() <= 1e-17
    assert np.abs(v @ x - x * e).max() <= 1e-16 * size
    for i, at in enumerate(sorted(values, reverse=True)):
        same = [j for j, w in enumerate(values) if w == at]
        gap = min([abs(at - w) for w in values if w != at], default=size) / size
        off = x[:, i] - q[:, same] @ (q[:, same].T @ x[:, i])  # what lies outside the eigenvalue's own space
        assert float(np.abs(off).max()) <= max(1e-16, 1e-17 / gap)


def _table(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((120, 12)) * np.linspace(2, 0.2, 12) @ np.linalg.qr(rng.standard_normal((12, 12)))[0]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)] + [(200 + i, [0.25] * 12) for i in range(60)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, [0.5] * 12), (300, [1.0] * 5)]
    bad = [(500, None), (501, [None] * 12), (502, [float("nan")] * 12), (503, [float("inf")] + [0.0] * 11)]
    return rows, spark.createDataFrame([(i, v, "x") for i, v in rows + bad], SCHEMA).repartition(6)


def _exact(rows, width):
    x = [[int(np.floor(1024 * np.float64(np.float32(c)))) + 100_000 for c in (*v, *[0.0] * (width - len(v)))] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    v = [[Fraction(sum(n * n * r[i] * r[j] for r in x) - n * s[i] * s[j], n ** 3) for j in range(width)] for i in range(width)]
    return x, n, s, v


def test_moments_are_exact(spark):
    rows, df = _table(spark)
    x, n, s, v = _exact(rows, 12)
    m = moments(df.select(F.col("embedding").cast("array<double>").alias("_vec")).where(good_vector(F.col("_vec"))))
    assert (m.n, m.sums) == (n, s)
    assert all(Fraction(int(m.scatter[i, j]), n * n) == v[i][j] for i in range(12) for j in range(12))


def test_whitened_rows(spark):
    rows, df = _table(spark)
    x, n, s, v = _exact(rows, 12)
    e, vec = eigenvectors(np.array([[float(c) for c in r] for r in v]))
    by = lambda i, q: (i is None, i or 0, q)
    got = sorted(whitened_embeddings(df).collect(), key=lambda r: by(r["vec_id"], int(r["deviation"])))
    deviations = [[n * a - b for a, b in zip(r, s)] for r in x]
    want = sorted(zip((i for i, _ in rows), deviations), key=lambda r: by(r[0], sum(c * c for c in r[1])))
    assert [(r["vec_id"], int(r["deviation"]), r["n"]) for r in got] == [(i, sum(c * c for c in d), n) for i, d in want]
    for r, (_, d) in zip(got, want):
        white = (np.array(d, dtype=float) / n) @ (vec[:, :8] / np.sqrt(e[:8])).astype(float)
        assert np.abs(np.array(r["whitened"]) - white).max() < 1e-9
        assert np.abs(np.array(r["explained"]) - (e[:8] / e.sum()).astype(float)).max() < 1e-12
        assert r["identity_error"] < 1e-9


def test_no_variance_few_rows_and_none(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25, 1.0], "x")], SCHEMA)
    r = whitened_embeddings(one).collect()
    assert [(x["vec_id"], x["n"], int(x["deviation"]), list(x["whitened"]), list(x["explained"]), x["identity_error"]) for x in r] == [(1, 1, 0, [None] * 3, [None] * 3, None)]
    two = whitened_embeddings(spark.createDataFrame([(1, [0.5, 0.25], "x"), (2, [0.75, 0.25], "y")], SCHEMA)).orderBy("vec_id").collect()
    assert [abs(x["whitened"][0]) for x in two] == [1.0, 1.0] and two[0]["whitened"][1] is None and two[0]["identity_error"] < 1e-12
    assert whitened_embeddings(one.where("false")).count() == 0


def test_query_on_the_given_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op13_embedding_whitening"](spark, SF_SMALL).toPandas()
    assert len(got) == 8 * len(rows) and set(got["component"]) == set(range(1, 9))
    x = np.floor(1024 * np.array([v for _, v in rows], dtype=float))
    e, vec = np.linalg.eigh(np.cov(x.T, bias=True))
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    want = (x - x.mean(axis=0)) @ (vec[:, ::-1][:, :8] / np.sqrt(e[::-1][:8]))
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-8
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
