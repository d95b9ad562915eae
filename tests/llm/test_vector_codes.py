"""Codes against plain squared distances in unbounded integers."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesfacts.llm.codes import books_sha256, nearest, transformed, vector_codes, walsh
from salesfacts.llm.queries import QUERIES

from conftest import SF_SMALL


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 16])
def test_walsh_rows_in_sequency_order_scale_distances(width):
    h = walsh(width)
    p = len(h)
    assert (h @ h.T == p * np.eye(p)).all()
    assert ((np.diff(h, axis=1) != 0).sum(axis=1) == np.arange(p)).all()
    rows = np.random.default_rng(width).integers(-500, 500, (40, width))
    t = transformed(rows)
    assert (((t[:, None] - t) ** 2).sum(-1) == p * ((rows[:, None] - rows) ** 2).sum(-1)).all()


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 6).flatmap(lambda w: st.tuples(
    st.lists(st.lists(st.integers(-3, 3), min_size=w, max_size=w), min_size=1, max_size=20),
    st.lists(st.lists(st.integers(-3, 3), min_size=w, max_size=w), min_size=1, max_size=9))), st.sampled_from([1, 1 << 40]))
def test_nearest_is_exact_with_ties_to_the_lower_index(data, factor):
    rows, entries = (np.array(d, dtype=np.int64) for d in data)
    code, dist = nearest(rows * factor, entries * factor)
    plain = [[sum((int(x) - int(y)) ** 2 for x, y in zip(r * factor, e * factor)) for e in entries] for r in rows]
    assert [int(c) for c in code] == [min(range(len(entries)), key=lambda j: (d[j], j)) for d in plain]
    assert [int(d) for d in dist] == [min(d) for d in plain]


def _brute(rows, parts, entries, rounds, scale=256):
    """rows: (id, vector, label) that are kept."""
    width = -(-max(len(v) for _, v, _ in rows) // parts)
    cut = lambda v: [[int(np.floor(scale * x)) for x in (*v, *[0.0] * (parts * width - len(v)))[p * width:(p + 1) * width]] for p in range(parts)]
    numbers = [cut(v) for _, v, _ in rows]
    first = sorted((r[0], tuple(r[1]), i) for i, r in enumerate(rows) if r[0] is not None)[:entries]
    books = [[numbers[i][p] for _, _, i in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        moved = []
        for p in range(parts):
            members = {}
            for x in numbers:
                members.setdefault(near(x[p], books[p])[1], []).append(x[p])
            moved.append([[sum(c) // len(c) for c in zip(*members[j])] if j in members else e for j, e in enumerate(books[p])])
        books = moved
    done = [[near(x[p], books[p]) for p in range(parts)] for x in numbers]
    errors = [sum(d for d, _ in row) for row in done]
    labels = {}
    for (_, _, label), e in zip(rows, errors):
        labels[label] = labels.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted((i if i is not None else -1, [j for _, j in row], e, labels[label]) for (i, _, label), row, e in zip(rows, done, errors)), sha


def _got(df, **kw):
    coded, books = vector_codes(df, **kw)
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, list(r["codes"]), r["error"], r["label_error"]) for r in coded.collect()), books_sha256(books)


SCHEMA = "vec_id long, embedding array<float>, label int, error string"


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(10)], int(i % 3) if i % 4 else None) for i in range(150)]
    rows += [(200 + i, rows[5][1], 1) for i in range(80)]  # a third of all rows are one vector
    rows += [(7, rows[9][1], 2), (7, rows[9][1], 2), (None, rows[11][1], 2), (400, [0.0] * 10, None), (401, [1.0] * 4, 1), (402, [], 1), (403, [1e9] * 10, 5)]
    bad = [(500, None, 1), (501, [None] * 10, 1), (502, [float("nan")] * 10, 1), (503, [float("-inf")] + [0.0] * 9, 1)]
    df = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows + bad], SCHEMA).repartition(5)
    got, sha = _got(df, parts=3, entries=12)
    want, want_sha = _brute([(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows], 3, 12, 2)
    assert got == want and sha == want_sha


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(3, [0.5, -0.25], None, "x"), (1, [0.125, 2.0], None, "y")], SCHEMA)
    assert _got(df, parts=2, entries=64) == _brute([(3, [0.5, -0.25], None), (1, [0.125, 2.0], None)], 2, 64, 2)
    coded, books = vector_codes(df.where("false"))
    assert coded.count() == 0 and books.shape[1] == 0


def test_query_equals_brute_force_on_the_given_table(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()][:]
    want, sha = _brute(rows, 16, 64, 2)
    got = sorted((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in QUERIES["op12_vector_codes"](spark, SF_SMALL).collect())
    assert got == [(i, "".join(f"{c:02x}" for c in codes), e, le, sha) for i, codes, e, le in want]
