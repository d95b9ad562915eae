"""Fuzzy line deduplication by MinHash: banded signatures, exact Jaccard, distributed union-find.

A line's normal form is lower-cased and trimmed; lines of at least ``MIN_CHARS``
characters take part. Equal lines are one (by a 64-bit hash). A line's signature has
the least token of its ``SHINGLE``-character shingles under ``BANDS * ROWS`` hash functions,
and each ``ROWS`` of them are a band: of lines at similarity 0.8 0.998 share one or more.
Every line goes to its bands with a print of two bits of each token. Lines that share a
band are compared by their prints, where they meet: unlike lines that have some token in common meet
in a share of all pairs, which grows faster than the corpus, and end there. Of a
band, each part that pairs with like prints hold together is a set of lines to compare, and a set that several
bands hold is one. Its lines are compared first by their ``SKETCH`` smallest hashes, and where
enough of these are the same by the exact Jaccard similarity of their full sets of
shingles (as 64-bit hashes). Only these lines' texts are read again.

The sets, bands from here on, are worked through in ``STEPS`` parts by key, each after the links of those
before it were merged into components, so a band whose lines are of one component
by then is done without moving a text. Of the others:

* a band of at most ``LEAF`` lines is compared within: two lines only while they are of
  different components, so a group of alike lines costs about as many comparisons
  as it has lines;
* one with at most ``LEAF`` lines outside its largest component compares those with
  all of it, in blocks;
* in any other band all lines are compared with one line, chosen by hash, and are
  then dealt to bands of the same key and further signatures, from other hash functions, until these
  are small or of one component.

No band is cut. The links' components keep the one line that stands first (by doc_id,
then place). Spark splits lines, groups bands, joins texts and merges components;
signatures and comparisons are numpy over Arrow batches, since character shingles by
built-in functions cost more than the scan they belong to (README).

Defined results: null text stays null and has no lines; blank lines are kept,
short ones unless ``short_repeats`` (then the first of equal ones is); a null doc_id
keeps its row unchanged; rows that repeat a doc_id share their decisions; a document
may lose all its lines and then has an empty text; an empty table gives no rows;
``n_lines`` and ``n_dropped`` replace columns of that name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesfacts.llm.common import discard, distinct_sorted, release, slices, small, stored
from salesfacts.llm.components import components, joined

MIN_CHARS = 16
SIMILARITY = 0.8
SHINGLE = 5
BANDS, ROWS = 12, 4
STEPS = 2
LEAF = 512  # lines up to which a band is compared within
BLOCK = 256  # lines of a larger band that one row holds
SKETCH, LIKELY = 16, 0.375  # smallest hashes compared first; the share that alike lines are sure to have in common
SLICE_BYTES = 1 << 19
SIGNED_BYTES = 1 << 17  # lines signed at once: their tokens stay in the cache of a core
SEEN = 100_000  # hashes of lines that a task remembers
UNLIKE = 18  # tokens in which the prints of alike lines may differ: of 48 pairs of bits 7.2 at similarity 0.8, 4.4 standard deviations
DEALT, MOST = 1 << 17, 1 << 21  # records of bands that a task deals at once, and that are grouped at once
WITHIN = 4096  # lines up to which all prints of a band are compared
PAIRS = 1 << 21  # pairs of lines of which the prints are compared, or that are held, at once
_RECORD = np.dtype([("key", "<u4"), ("h", "<u8"), ("low", "<u8"), ("high", "<u4")])
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(4)
_MULTIPLY = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def _kept(df: DataFrame) -> DataFrame:
    """``df`` stored; the shuffle files that it was made from go at once, not with a later collection of the driver's."""
    out = stored(df)
    release(df.sparkSession)
    return out


def _lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(doc_id, n, line, h) of the lines that take part (``short``: of all that are not blank); line in normal form."""
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "raw"))
    rows = rows.select("doc_id", "n", F.trim(F.lower("raw")).alias("line")).where(
        F.col("line").rlike(r"\S") if short else F.char_length("line") >= MIN_CHARS)
    return rows.withColumn("h", F.xxhash64("line"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _windows(lines: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(line's place, 64-bit hash) of each shingle of the lines (of the line, if it is shorter); ``seed`` names the hash function."""
    lines = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lens = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    n = max(0, len(points) - SHINGLE + 1)
    h = np.full(n, seed + 1, dtype=np.uint64)
    for j in range(SHINGLE):
        h = (h ^ points[j:n + j]) * _MIX
        h ^= h >> np.uint64(29)
    owner = np.repeat(np.arange(len(lines)), lens)[:n]
    inside = np.arange(n) <= np.repeat(np.cumsum(lens), lens)[:n] - SHINGLE
    return owner[inside], _mixed(h[inside])


def line_sets(lines: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each line's shingles."""
    owner, h = _windows(lines, 0)
    return [distinct_sorted(x) for x in np.split(h, np.searchsorted(owner, np.arange(1, len(lines))))]


def smallest(lines: list[str], k: int, seed: int = 0) -> np.ndarray:
    """(lines, k): each line's ``k`` smallest distinct 40-bit hashes of shingles, sorted; 0 fills short rows."""
    owner, h = _windows(lines, seed)
    both = distinct_sorted((owner.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)) | np.uint64(1))
    owner = (both >> np.uint64(40)).astype(np.int64)
    place = np.arange(len(both)) - np.searchsorted(owner, owner)
    out = np.zeros((len(lines), k), dtype=np.uint64)
    low = place < k
    out[owner[low], place[low]] = both[low] & np.uint64((1 << 40) - 1)
    return out


def minwise(lines: list[str], seed: int = 0) -> np.ndarray:
    """(functions, lines): the least token of each line's shingles under each of ``BANDS * ROWS`` hash functions."""
    owner, h = _windows(lines, seed)
    begin, tokens = np.searchsorted(owner, np.arange(len(lines))), (h >> np.uint64(32)).astype(np.uint32)
    out, mixed = np.zeros((BANDS * ROWS, len(lines)), dtype=np.uint32), np.empty_like(tokens)
    for i in range(BANDS * ROWS if lines else 0):  # each function permutes the 32-bit tokens
        np.multiply(np.bitwise_xor(tokens, _FLIP[i], out=mixed), _MULTIPLY[i], out=mixed)
        np.minimum.reduceat(mixed, begin, out=out[i])
    return out


def _of_bands(least: np.ndarray) -> np.ndarray:
    """(bands, lines): the keys of the bands of minwise tokens."""
    keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[:, None], least.shape[1], axis=1)
    for i, tokens in enumerate(least):
        keys[i // ROWS] = _mixed(keys[i // ROWS] * _MIX + tokens)
    return keys


def band_keys(lines: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(place of the line, key) for each of a line's ``BANDS`` bands."""
    return np.tile(np.arange(len(lines)), BANDS), _of_bands(minwise(lines, seed)).ravel()


def prints(least: np.ndarray) -> np.ndarray:
    """(2, lines): two bits of each minwise token."""
    bits = ((least * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64)
    out = np.zeros((2, least.shape[1]), dtype=np.uint64)
    for i, two in enumerate(bits):
        out[i // 32] |= two << np.uint64(2 * (i % 32))
    return out


def _unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many tokens the prints differ."""
    x = a ^ b
    low, high = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555))
    return low + high


def groups(h: np.ndarray, marks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, h) of the lines of bands that may be alike: the lines ``h`` with prints ``marks`` of bands of
    ``sizes``, one after the other, in parts that likely pairs hold together; ``set`` names a part by its lines."""
    n, first = len(h), np.repeat(np.cumsum(sizes) - sizes, sizes)
    after = np.repeat(sizes, sizes) - (np.arange(n) - first)  # lines of the band from this one on
    many = np.repeat(sizes > WITHIN, sizes)  # these are told apart in rounds
    label, pairs, size = np.arange(n), [], 0
    at, d = np.flatnonzero(~many & (after > 1)), 1
    while len(at):
        hit = at[_unlike(marks[:, at], marks[:, at + d]) <= UNLIKE]
        pairs.append(np.stack([hit, hit + d]))
        size, d = size + len(hit), d + 1
        at = at[after[at] > d]
        if pairs and (size > PAIRS or not len(at)):
            label = joined(n, *np.concatenate(pairs, axis=1))
            pairs = [np.stack([label, np.arange(n)])[:, label < np.arange(n)]]
            size = pairs[0].shape[1]
    label = np.where(many, first, label)
    order = np.argsort(label, kind="stable")
    begin = np.flatnonzero(np.diff(label[order], prepend=-1))
    count = np.diff(begin, append=n)
    name = _mixed(np.add.reduceat(_mixed(h[order]), begin) + count.astype(np.uint64)) if n else h
    more = np.repeat(count > 1, count)
    return np.repeat(name, count)[more], h[order][more]


def _keys(rows: DataFrame, seed: int = 0) -> DataFrame:
    """(key, h), distinct, of the bands that lines (h, line) share with others; with a column ``key`` the new keys are parts of it."""
    parts = "key" in rows.columns

    def run(batches):
        seen: set = set()
        for batch in batches:
            for piece in slices(batch, "line", SLICE_BYTES):
                h = piece.column("h").to_numpy()
                old = piece.column("key").to_numpy() if parts else np.zeros(len(h), dtype=np.int64)
                fresh = [i for i, x in enumerate(zip(old.tolist(), h.tolist()) if parts else h.tolist()) if x not in seen and not seen.add(x)]
                if len(seen) > SEEN:
                    seen.clear()  # repeats then go in Spark's distinct
                if fresh:
                    lines = piece.column("line").take(pa.array(fresh)).to_pylist()
                    place, keys = band_keys(lines, seed)
                    h, old = h[fresh][place], old[fresh][place]
                    keys = _mixed(keys ^ old.view(np.uint64)) if parts else keys
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(h)], names=["key", "h"])

    band = Window.partitionBy("key")  # one exchange for both: shared or not, and distinct
    keys = rows.mapInArrow(run, "key long, h long").select("key", "h", F.min("h").over(band).alias("_lo"), F.max("h").over(band).alias("_hi"))
    return keys.where("_lo <> _hi").select("key", "h").distinct()


def _met(records: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(set, h) as ``groups`` of the bands of a bucket's records."""
    both = (records["key"].astype(np.uint64) << np.uint64(32)) | (records["h"] & np.uint64(0xFFFFFFFF))
    order = np.argsort(both)
    both, h = both[order], records["h"][order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (both[1:] != both[:-1]) | (h[1:] != h[:-1])
    order, h, key = order[new], h[new], both[new] >> np.uint64(32)
    sizes = np.diff(np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1))), append=len(key))
    of = np.repeat(sizes, sizes)
    rows = np.argsort(of, kind="stable")[np.count_nonzero(of == 1):]  # bands of one size follow each other
    sizes = np.sort(sizes[sizes > 1])
    marks = np.stack([records["low"], records["high"].astype(np.uint64)])
    cuts = np.flatnonzero(np.diff(np.cumsum(np.minimum(sizes, WITHIN) * sizes) // PAIRS, prepend=0))
    ends = np.cumsum(sizes)
    for some in np.split(np.arange(len(sizes)), cuts):
        if len(some):
            own = rows[ends[some[0]] - sizes[some[0]]:ends[some[-1]]]
            yield groups(h[own], marks[:, order[own]], sizes[some])


def _shared(rows: DataFrame) -> DataFrame:
    """(key, h), distinct: sets of lines (h, line) that share a band and whose prints are of likely pairs.

    The lines' records are dealt to buckets of bands, thousands in a row, and grouped there by numpy: a row for each
    line and band would cost more than its signature. A set that several bands hold comes once. A bucket
    of over ``MOST`` records gives all of its lines by band, for Spark to group.
    """
    buckets = 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, records = np.concatenate([k for k, _ in held]), np.concatenate([r for _, r in held])
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket)
        records, ends = records[order], np.cumsum(np.bincount(bucket, minlength=buckets))
        filled = np.flatnonzero(np.diff(ends, prepend=0))
        offsets = np.concatenate([[0], ends[filled]]).astype(np.int32) * _RECORD.itemsize
        blobs = pa.Array.from_buffers(pa.binary(), len(filled), [None, pa.py_buffer(offsets), pa.py_buffer(records.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(filled), blobs], names=["bucket", "records"])

    def signed(batches):
        seen, held, size = set(), [], 0
        for batch in batches:
            for piece in slices(batch, "line", SIGNED_BYTES):
                h = piece.column("h").to_numpy()
                fresh = [i for i, x in enumerate(h.tolist()) if x not in seen and not seen.add(x)]
                if len(seen) > SEEN:
                    seen.clear()  # repeats then go in the bucket
                if fresh:
                    least = minwise(piece.column("line").take(pa.array(fresh)).to_pylist())
                    keys, marks = _of_bands(least).ravel(), prints(least)
                    records = np.empty((BANDS, len(fresh)), dtype=_RECORD)
                    records["h"], records["low"], records["high"] = h[fresh].view(np.uint64), *marks
                    records = records.ravel()
                    records["key"] = keys >> np.uint64(32)
                    held.append((keys, records))
                    size += len(keys)
                if size > DEALT:
                    yield deal(held)
                    held, size = [], 0
        if held:
            yield deal(held)

    def met(batches):
        def out(key, h):
            return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (key, h)], names=["key", "h"])

        def raw(bucket, records):
            return out(_mixed((records["key"].astype(np.uint64) << np.uint64(32)) + np.uint64(bucket)), records["h"].copy())

        last, held, size = None, [], 0
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("records")):
                if bucket != last:
                    if held and size <= MOST:
                        yield from (out(*found) for found in _met(np.concatenate(held)))
                    last, held, size = bucket, [], 0
                held.append(np.frombuffer(blob.as_buffer(), dtype=_RECORD))
                size += len(held[-1])
                if size > MOST:
                    yield raw(bucket, np.concatenate(held))
                    held = []
        if held and size <= MOST:
            yield from (out(*found) for found in _met(np.concatenate(held)))

    dealt = rows.select("h", "line").mapInArrow(signed, "bucket long, records binary")
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(met, "key long, h long").distinct()


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)) - 1e-9:
        return False
    if len(a) > len(b):
        a, b = b, a
    common = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return common >= SIMILARITY * (len(a) + len(b) - common) - 1e-9


def _sketched(texts: DataFrame) -> DataFrame:
    """``texts`` (h, line) plus sk: the line's ``SKETCH`` smallest hashes, 4 bytes each."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, "line", SLICE_BYTES):
                low = (smallest(piece.column("line").to_pylist(), SKETCH) >> np.uint64(8)).astype("<u4")
                yield pa.RecordBatch.from_arrays([piece.column("h"), piece.column("line"), pa.array([r.tobytes() for r in low], pa.binary())],
                                                 names=["h", "line", "sk"])

    return texts.mapInArrow(run, "h long, line string, sk binary")


def _partners(sketches: np.ndarray, comps: np.ndarray, first: int) -> np.ndarray:
    """Which lines have a likely partner of another component, among pairs of the first ``first`` lines with all."""
    n = len(sketches)
    sizes = (sketches > 0).sum(axis=1)
    out = np.zeros(n, dtype=bool)
    for i in range(min(first, n)):
        rest = i + 1 + np.flatnonzero(comps[i + 1:] != comps[i])
        if len(rest):
            own = sketches[i, :sizes[i]]
            common = (sketches[rest][:, :, None] == own).any(axis=1).sum(axis=1)
            hit = rest[common >= LIKELY * np.minimum(sizes[rest], sizes[i]) - 1e-9]
            out[hit] = True
            out[i] |= len(hit) > 0
    return out


def _flat(column: pa.Array) -> tuple[pa.StructArray, np.ndarray]:
    """The members of a column of arrays, one after the other, and how many each row has."""
    return column.flatten(), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)


def _places(xn: np.ndarray, yn: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each row the places of its lines where all lines ``x`` stand before all ``y``, and how many of them are ``x``."""
    xe, ye = np.cumsum(xn), np.cumsum(yn) + xn.sum()
    for a, n, b, m in zip((xe - xn).tolist(), xn.tolist(), (ye - yn).tolist(), yn.tolist()):
        yield np.concatenate([np.arange(a, a + n), np.arange(b, b + m)]), n


def _likely(rows: DataFrame) -> DataFrame:
    """(key, s, side, h, comp): of each row's lines ``x`` (side 0) and ``y`` (side 1), arrays of (h, comp, sk), those with a likely
    partner of another component, among the pairs of ``x`` with itself and with ``y``; a null ``y`` is none."""
    def run(batches):
        for batch in batches:
            (x, xn), (y, yn) = (_flat(batch.column(c)) for c in ("x", "y"))
            h, comp = (np.concatenate([v.field(c).to_numpy() for v in (x, y)]) for c in ("h", "comp"))
            sk = np.frombuffer(b"".join(x.field("sk").to_pylist() + y.field("sk").to_pylist()), dtype="<u4").reshape(-1, SKETCH)
            places, counts, sides = [], [], []
            for own, first in _places(xn, yn):
                at = _partners(sk[own], comp[own], first).nonzero()[0]
                places.append(own[at])
                counts.append(len(at))
                sides.append(at >= first)
            if sum(counts):
                at = np.concatenate(places)
                named = [np.repeat(batch.column(c).to_numpy(), counts) for c in ("key", "s")]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*named, np.concatenate(sides).astype(np.int64), h[at], comp[at])],
                                                 names=["key", "s", "side", "h", "comp"])

    return rows.select("key", "s", "x", "y").mapInArrow(run, "key long, s long, side long, h long, comp long")


def links_between(hs: list[int], comps: list[int], sets: list[np.ndarray], first: int) -> list[tuple[int, int]]:
    """Confirmed pairs of the first ``first`` lines with those after them; only while of different components."""
    up: dict[int, int] = {c: c for c in comps}

    def find(c: int) -> int:
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    n, out = len(hs), []
    for i in range(min(first, n)):
        for j in range(i + 1, n):
            a, b = find(comps[i]), find(comps[j])
            if a != b and _alike(sets[i], sets[j]):
                up[a] = b
                out.append((hs[i], hs[j]))
    return out


def _compared(rows: DataFrame) -> DataFrame:
    """(a, b): confirmed links of each row's lines ``x`` with each other and with its lines ``y``, arrays of (h, comp, line); a null ``y`` is none."""
    def run(batches):
        for batch in batches:
            found: list[tuple[int, int]] = []
            (x, xn), (y, yn) = (_flat(batch.column(c)) for c in ("x", "y"))
            h, comp = (np.concatenate([v.field(c).to_numpy() for v in (x, y)]) for c in ("h", "comp"))
            lines = pa.concat_arrays([x.field("line"), y.field("line")])
            bytes_of = pc.binary_length(lines).to_numpy(zero_copy_only=False)
            held, size, rest = [], 0, len(xn)
            for at, first in _places(xn, yn):
                held.append((at, first))
                size, rest = size + bytes_of[at].sum(), rest - 1
                if size > SLICE_BYTES or not rest:
                    sets = line_sets(lines.take(pa.array(np.concatenate([at for at, _ in held]))).to_pylist())
                    begin = 0
                    for at, first in held:
                        found += links_between(h[at].tolist(), comp[at].tolist(), sets[begin:begin + len(at)], first)
                        begin += len(at)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return rows.select("x", "y").mapInArrow(run, "a long, b long")


def _band_round(bands: DataFrame, known: DataFrame, texts: DataFrame, turn: int) -> tuple[DataFrame | None, DataFrame | None]:
    """The links confirmed in bands (key, h) under the components ``known``, and the bands that are left for the next round."""
    marked = _kept(bands.join(small(known), bands["h"] == known["id"], "left").select("key", "h", F.coalesce("component", "h").alias("comp")))
    parts = marked.groupBy("key", "comp").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("h")).alias("all"))
    open_ = parts.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"),
                                     F.bit_xor("all").alias("all")).where("comps > 1")
    # alike lines share most of their bands: of those that hold the same lines (by a 64-bit hash) one is compared
    open_ = open_.groupBy("size", "all").agg(F.min(F.struct("key", "top")).alias("o")).select("o.key", "size", "o.top")
    met = _kept(marked.join(open_, "key").select("key", "h", "comp", "size", F.col("top.comp").alias("top"), (F.col("size") - F.col("top.n")).alias("outside")))
    discard(marked)
    kind = F.when(F.col("size") <= LEAF, "few").when(F.col("outside") <= LEAF, "ruled").otherwise("wide")
    kinds = {r["kind"] for r in met.groupBy(kind.alias("kind")).count().collect()}  # 3 rows
    if not kinds:
        discard(met)
        return None, None
    member, none, zero = F.struct("h", "comp", "sk"), F.lit(None).cast("array<struct<h: long, comp: long, sk: binary>>"), F.lit(0).cast("long").alias("s")
    block = F.pmod(F.xxhash64("h"), F.ceil(F.col("size") / BLOCK)).alias("s")
    rows = met.withColumn("kind", kind).join(texts.select("h", "sk"), "h")
    work = []
    if "few" in kinds:
        work.append(rows.where("kind = 'few'").groupBy("key").agg(F.collect_list(member).alias("x")).select("key", zero, "x", none.alias("y")))
    if "ruled" in kinds:
        ruled = rows.where("kind = 'ruled'")
        out = ruled.where("comp <> top").groupBy("key").agg(F.collect_list(member).alias("x"))
        inside = ruled.where("comp = top").groupBy("key", block).agg(F.collect_list(member).alias("y"))
        work.append(inside.join(out, "key").select("key", "s", "x", "y"))
    if "wide" in kinds:
        wide = rows.where("kind = 'wide'")
        pivots = wide.groupBy("key").agg(F.min_by(member, F.xxhash64("h", "key", F.lit(turn))).alias("p")).select("key", F.array("p").alias("x"))
        work.append(wide.groupBy("key", block).agg(F.collect_list(member).alias("y")).join(pivots, "key").select("key", "s", "x", "y"))
    likely = _kept(reduce(DataFrame.union, [_likely(w) for w in work]))
    side = lambda k: F.collect_list(F.when(F.col("side") == k, F.struct("h", "comp", "line")))
    members = likely.join(texts.select("h", "line"), "h").groupBy("key", "s").agg(side(0).alias("x"), side(1).alias("y"))
    links = _kept(_compared(members))
    left = _kept(_keys(met.where(kind == "wide").select("key", "h").join(texts.select("h", "line"), "h"), turn + 1)) if "wide" in kinds else None
    discard(met, likely)
    return links, left


def _linked(docs: DataFrame) -> DataFrame:
    """(id, component) of the hashes of lines that are linked with another's."""
    spark = docs.sparkSession
    active = _kept(_shared(_lines(docs).select("h", "line")))
    need = _kept(active.select("h").distinct())
    texts = _kept(_sketched(_lines(docs).select("h", "line").join(small(need), "h").groupBy("h").agg(F.min("line").alias("line"))))
    discard(need)
    found = []
    known = spark.createDataFrame([], "id long, component long")
    for step in range(STEPS):
        bands, turn = active.where(F.pmod("key", F.lit(STEPS)) == step), 0
        while bands is not None:
            links, left = _band_round(bands, known, texts, turn)
            if turn:
                discard(bands)
            if links is not None and links.limit(1).count():
                found.append(links)
                discard(known)
                known = components(reduce(DataFrame.union, found))
            bands, turn = left, turn + 1
            release(spark)
    discard(active, texts)
    return known


def dedup_lines(docs: DataFrame, short_repeats: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated lines dropped from ``text``, plus n_lines and n_dropped.

    ``short_repeats``: exact repeats of lines too short for shingles go, too, unless blank.
    """
    lines = docs.select("doc_id", "text")
    linked = _linked(lines)
    component = small(linked).select(F.col("id").alias("h"), "component")
    places = _lines(lines, short_repeats).select("doc_id", "n", "h").join(component, "h", "left").select(
        "doc_id", "n", F.coalesce("component", "h").alias("component"))
    places = _kept(places)
    discard(linked)
    first = places.groupBy("component").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.count("*").alias("m")).where("m > 1")
    first = _kept(first.select("component", F.col("first.doc_id").alias("_doc"), F.col("first.n").alias("_n")))
    extra = places.join(small(first), "component").where((F.col("doc_id") != F.col("_doc")) | (F.col("n") != F.col("_n")))
    drops = _kept(extra.groupBy("doc_id").agg(F.sort_array(F.collect_set("n")).alias("_drop")))
    discard(places, first)
    out = docs.drop("n_lines", "n_dropped").join(drops.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    kept = F.expr("array_join(filter(split(text, '\\n'), (x, i) -> NOT array_contains(_drop, i)), '\\n')")
    return (out.withColumn("n_lines", F.coalesce(F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))), F.lit(0)))
            .withColumn("n_dropped", F.coalesce(F.when(F.col("_drop").isNotNull(), F.size("_drop")), F.lit(0)))
            .withColumn("text", F.when(F.col("_drop").isNull(), F.col("text")).otherwise(kept)).drop("_drop"))
