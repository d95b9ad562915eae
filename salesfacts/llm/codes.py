"""Vector codes by product quantisation in whole numbers, with Walsh-Hadamard early elimination.

Components become integers floor(scale * x); vectors are cut into equal parts, each
part position with its own codebook. Nearest entries are found on transforms: parts
and entries are padded with zeros to a power of two P and multiplied by the integer
Walsh-Hadamard matrix, rows in sequency order (by number of sign changes), which
scales every squared distance by P exactly. Squared differences of coefficients
are added up in that order, the low sequencies of smooth parts first. After the
first coefficient one entry's whole distance gives a row its bound; an entry whose
sum exceeds the bound leaves, since sums only grow, and the bound falls as
entries are completed. No floating point takes part after the floor.

Each round the tasks return sums and counts by (part, entry), one set a task, that
Spark adds as decimals; the driver holds the codebooks only (parts x entries x
width numbers, whatever the table's size). Codes of the last round are stored once, and
errors are summed by label before any join.

Defined results: vectors that are null or hold a null, NaN or infinite component are
dropped; vectors shorter than the longest count as zero-padded, and so is a
length that the parts do not divide; an empty vector is a vector of zeros; a null id is
coded but starts no entry; repeated rows are rows each; with fewer ids than entries
the codebooks are as short; null labels are a label of their own; an empty table gives
no rows. A component so large that an exact distance leaves 64 bits is computed
in unbounded integers; if a row's final error is beyond ``long`` the job ends with an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.llm.common import stored

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
ROWS = 2048  # rows compared at a time


def walsh(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of the least power of two from ``width`` on, rows by number of sign changes."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < width:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def transformed(values: np.ndarray) -> np.ndarray:
    """Coefficients of rows padded with zeros, in sequency order."""
    h = walsh(values.shape[1])
    return values @ h[:, :values.shape[1]].T.astype(values.dtype)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest entry (ties to the lower index) and the squared distance, exactly.

    ``rows`` and ``entries`` are whole numbers (n, width) and (k, width).
    """
    width = len(walsh(rows.shape[1]))
    # The sum of width squares of differences of coefficients, each of width terms.
    exact = np.dtype(object if 4 * width ** 3 * max(_most(rows), _most(entries)) ** 2 >= 1 << 63 else np.int64)
    a, e = transformed(rows.astype(exact)), transformed(entries.astype(exact))
    n = len(a)
    sums = (a[:, :1] - e[:, 0]) ** 2
    first = sums.argmin(axis=1)
    bound = ((a - e[first]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for j in range(1, width):
        sums = sums + (a[row, j] - e[entry, j]) ** 2
        if j + 1 < width:
            live = sums <= bound[row]
            if j == 1:  # a second bound: the entry that leads after two coefficients
                starts = np.searchsorted(row, np.arange(n))
                lead = np.lexsort((_ordered(sums), row))[starts]
                bound = np.minimum(bound, ((a - e[entry[lead]]) ** 2).sum(axis=1))
                live = sums <= bound[row]
            row, entry, sums = row[live], entry[live], sums[live]
    best = np.lexsort((entry, _ordered(sums), row))[np.searchsorted(row, np.arange(n))]
    return entry[best], sums[best] // width


def _ordered(values: np.ndarray) -> np.ndarray:
    """Numbers in the order of ``values``, which may be unbounded integers."""
    return np.unique(values, return_inverse=True)[1] if values.dtype == object else values


def _most(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def good_vector(vec: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    return F.coalesce(vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole_numbers(column: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of a list<double> column as (rows, width), zeros where a vector is shorter; int64, or objects beyond 2 ** 62."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lens = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() >= 2.0 ** 62:
        flat = np.array([int(x) for x in flat], dtype=object)
    else:
        flat = flat.astype(np.int64)
    out = np.zeros((len(lens), width), dtype=flat.dtype)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def _cut(column: pa.Array, scale: int, parts: int, width: int) -> np.ndarray:
    """(rows, parts, width) whole numbers."""
    return whole_numbers(column, scale, parts * width).reshape(-1, parts, width)


def _assigned(numbers: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row and part."""
    done = [nearest(numbers[:, p], books[p]) for p in range(len(books))]
    return np.stack([d[0] for d in done], axis=1), np.stack([d[1] for d in done], axis=1)


def _sums(vectors: DataFrame, books: np.ndarray, scale: int) -> DataFrame:
    """(part, entry, total, n): componentwise sums of the parts that each entry is nearest to."""
    parts, entries, width = books.shape
    spread = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books, totals, counts = spread.value, np.zeros((parts, entries, width), dtype=object), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                numbers = _cut(batch.slice(at, ROWS).column("_vec"), scale, parts, width)
                codes, _ = _assigned(numbers, books)
                one = np.zeros((parts, entries, width), dtype=object if _most(numbers) * ROWS >= 1 << 63 else np.int64)
                for p in range(parts):
                    np.add.at(one[p], codes[:, p], numbers[:, p].astype(one.dtype))
                    counts[p] += np.bincount(codes[:, p], minlength=entries)
                totals = totals + one
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays([
                pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
                pa.array([[int(x) for x in totals[p, e]] for p, e in zip(part, entry)], pa.list_(pa.decimal128(38, 0))),
                pa.array(counts[part, entry])], names=["part", "entry", "total", "n"])

    found = vectors.select("_vec").mapInArrow(run, "part int, entry int, total array<decimal(38,0)>, n long")
    return found.groupBy("part", "entry").agg(*[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)], F.sum("n").alias("n"))


def train_codebooks(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of ``vectors`` (_id, _vec): the vectors of the smallest ids, moved ``rounds`` times to the floors of means."""
    length = vectors.agg(F.max(F.size("_vec"))).first()[0] or 0
    width = max(1, -(-length // parts))
    first = vectors.where("_id IS NOT NULL").orderBy("_id", "_vec").limit(entries).select("_vec").collect()
    seeds = pa.array([r["_vec"] for r in first], pa.list_(pa.float64()))
    books = _cut(seeds, scale, parts, width).transpose(1, 0, 2).copy()
    if not len(first):
        return books
    for _ in range(rounds):
        moved = books.astype(object)
        for r in _sums(vectors, books, scale).collect():  # parts * entries rows at most
            moved[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
        books = moved.astype(np.int64) if _most(moved) < 1 << 62 else moved
    return books


def encode_vectors(vectors: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``vectors`` (_id, _label, _vec) as (_id, _label, codes array<int>, error long)."""
    parts, entries, width = books.shape
    if not entries:
        return vectors.where("false").select("_id", "_label", F.lit(None).cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
    spread = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = spread.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                codes, errors = _assigned(_cut(piece.column("_vec"), scale, parts, width), books)
                yield pa.RecordBatch.from_arrays([
                    piece.column("_id"), piece.column("_label"), pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())),
                    pa.array([int(x) for x in errors.sum(axis=1)], pa.int64())], names=["_id", "_label", "codes", "error"])

    kinds = dict(vectors.dtypes)
    return vectors.select("_id", "_label", "_vec").mapInArrow(run, f"_id {kinds['_id']}, _label {kinds['_label']}, codes array<int>, error long")


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes, error, label_error) of the kept vectors of ``df``, and the codebooks."""
    vectors = df.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("string").alias("_label"),
                        F.col(vector_col).cast("array<double>").alias("_vec")).where(good_vector(F.col("_vec")))
    books = train_codebooks(vectors, scale, parts, entries, rounds)
    coded = stored(encode_vectors(vectors, books, scale))
    # One row a label after a partial sum; AQE splits the join where one label holds much of the table.
    sums = coded.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_l")
    out = coded.join(sums, F.col("_label").eqNullSafe(F.col("_l"))).drop("_l")
    return out.select(F.col("_id").alias("vec_id"), F.col("_label").alias("label"), "codes", "error", "label_error"), books


def code_text(codes: Column) -> Column:
    """The codes' indexes, two hexadecimal digits each, in part order."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def codes_sql(table: str = "embeddings", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The query's rows in DuckDB SQL, by plain squared differences of components."""
    ctes = {
        "kept": f"""SELECT vec_id, label, embedding FROM {table} WHERE embedding IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM (SELECT unnest(embedding) AS c) WHERE c IS NULL OR isnan(c) OR isinf(c))""",
        "flat": f"""SELECT vec_id, i - 1 AS i, CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, unnest(embedding) AS c, generate_subscripts(embedding, 1) AS i FROM kept)""",
        "width": f"SELECT (max(i) + {parts}) // {parts} AS w FROM flat",
        "comps": "SELECT vec_id, CAST(i // w AS INTEGER) AS part, i % w AS j, x FROM flat, width",
        "seeds": f"SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}",
        "book0": "SELECT part, entry, j, x FROM comps JOIN seeds USING (vec_id)",
    }
    for r in range(rounds + 1):
        ctes[f"dist{r}"] = f"""SELECT c.vec_id, c.part, b.entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS d
  FROM comps c JOIN book{r} b ON c.part = b.part AND c.j = b.j GROUP BY c.vec_id, c.part, b.entry"""
        ctes[f"near{r}"] = f"SELECT vec_id, part, d, entry FROM dist{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1"
        if r < rounds:
            ctes[f"mean{r}"] = f"""SELECT part, entry, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
    SELECT part, entry, j, sum(x) AS s, count(*) AS n FROM comps JOIN near{r} USING (vec_id, part) GROUP BY part, entry, j)"""
            ctes[f"book{r + 1}"] = f"SELECT part, entry, j, COALESCE(m.x, b.x) AS x FROM book{r} b LEFT JOIN mean{r} m USING (part, entry, j)"
    ctes["books"] = f"SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM book{rounds}"
    ctes["coded"] = f"""SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id"""
    return ("WITH " + ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in ctes.items())
            + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (vec_id), books""")
