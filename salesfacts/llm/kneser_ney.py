"""Interpolated modified Kneser-Ney models over the characters of words, trained and applied by sharded joins.

A word is the symbols START, its characters, END; the model gives each symbol after
START a probability from up to ``order - 1`` symbols before it in the word. Working
on characters keeps the model's size near that of the language, while a word never
seen still gets a probability from its parts.

A token may carry the end of the word before it: ``tail + "\\n" + word``. Its symbols
are the tail, START, the word's characters, END; only those after START are
predicted, but the n-grams reach into the tail. So models cross word edges. A tail
has ``order - 2`` symbols, or is the whole word before it with its START. N-grams that
begin with START keep their raw counts. ``RUNNING`` in place of a token function means
that every word but a text's first follows such a tail; those n-grams are read off the symbols of
whole texts, without a string for each token.

Training counts n-grams with Spark (raw counts for the highest order and for
n-grams at a word's start, distinct left neighbours for the others), takes the
three discounts of each order from its counts of counts, and writes the model as
rows (key, values), one for each n-gram and the empty one: its discounted relative
frequency, and the weight that the next lower order gets after it as a context. Keys
are 64-bit hashes.

Several models can be trained at once (``classes``): they share the counts of the
orders up to ``shared``, so rare expressions back off to the same distribution.

Scoring cuts the texts into blocks. A block's distinct words give the distinct keys
they need; keys and model rows meet by key shard, and the answers return to the
block, where words get their log-probabilities. So neither model nor texts pass
through one place, and a block needs memory for its own words only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from salesfacts.llm.common import discard, distinct_sorted, release, slices, stored

START, END = 2, 3
BLOCK_CHARS, RUNNING_BLOCK_CHARS = 12_000_000, 32_000_000
SLICE_CHARS = 2 << 20
WORDS = 25_000  # distinct words whose symbols are laid out at a time
RUN_CHARS = 1 << 19  # of running text laid out at a time
RUNS = 24  # whose probabilities are looked up together
RUN_GRAMS = 400_000  # distinct n-grams of running text that are held while they are counted
RUNNING = None
LEAST_SHARDS = 64
POOL = -1  # the class under which shared orders are counted
ALPHABET = 65_536  # the uniform distribution below the unigrams

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def word_symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the tokens in a row, each symbol's place in its token, each token's symbol count, and which symbols are predicted."""
    joined = "".join(words)
    if "\n" in joined:
        return _tailed_symbols(words)
    flat = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lens + 2)
    out = np.full(int(ends[-1]) if len(words) else 0, END, dtype=np.uint64)
    starts = ends - lens - 2
    place = np.arange(len(out)) - np.repeat(starts, lens + 2)
    out[place == 0] = START
    inner = np.ones(len(out), dtype=bool)
    inner[starts] = False
    inner[ends - 1] = False
    out[inner] = flat
    return out, place, lens + 2, place >= 1


def _tailed_symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    whole = [w if "\n" in w else "\n" + w for w in words]
    lens = np.fromiter(map(len, whole), dtype=np.int64, count=len(whole)) + 1
    edges = np.fromiter((w.index("\n") for w in whole), dtype=np.int64, count=len(whole))
    ends = np.cumsum(lens)
    place = np.arange(int(ends[-1])) - np.repeat(ends - lens, lens)
    out = np.full(int(ends[-1]), END, dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends - 1] = False
    out[inner] = np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out[ends - lens + edges] = START
    return out, place, lens, place > np.repeat(edges, lens)


def gram_hashes(symbols: np.ndarray, order: int) -> list[np.ndarray]:
    """hashes[k][i] of the k symbols that end at i (valid from place k - 1 on)."""
    hashes = [np.zeros(len(symbols), dtype=np.uint64)]
    for k in range(1, order + 1):
        left = np.zeros(len(symbols), dtype=np.uint64)
        left[1:] = hashes[k - 1][:-1]
        hashes.append(_mix(left * _A + symbols + np.uint64(k)))
    return hashes


def gram_key(h: np.ndarray, k: int) -> np.ndarray:
    """Key of the n-grams of ``k`` symbols with hashes ``h``."""
    return _mix(h + np.uint64(2 * k))


# --- running text -----------------------------------------------------------------------


class _Grams:
    """Distinct longest n-grams: ``s`` (n, order) their last symbols, ``size`` how many of these count, ``key`` their names."""

    def __init__(self, s: np.ndarray, size: np.ndarray, key: np.ndarray, times: np.ndarray):
        self.s, self.size, self.key, self.times = s, size, key, times

    @staticmethod
    def merged(parts: list[_Grams], order: int) -> _Grams:
        if not parts:
            return _Grams(np.empty((0, order), dtype=np.uint32), np.empty(0, dtype=np.int8), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
        code, key = pd.factorize(np.concatenate([p.key for p in parts]))
        at = np.empty(len(key), dtype=np.int64)
        at[code] = np.arange(len(code))
        times = np.bincount(code, weights=np.concatenate([p.times for p in parts]), minlength=len(key)).astype(np.int64)
        return _Grams(np.concatenate([p.s for p in parts])[at], np.concatenate([p.size for p in parts])[at], key, times)

    def orders(self):
        """For each k: which n-grams reach it, and the hashes of their last k symbols, of these without the last and without the first."""
        below = np.zeros(len(self.key), dtype=np.uint64)
        for k in range(1, self.s.shape[1] + 1):
            h = np.zeros(len(self.key), dtype=np.uint64)
            for j in range(1, k + 1):
                ctx = h
                h = _mix(ctx * _A + self.s[:, j - k - 1] + np.uint64(j))
            yield k, np.flatnonzero(self.size >= k), h, ctx, below
            below = h


def running_pieces(texts: Iterable[str]):
    """Runs of pieces of texts, about ``RUN_CHARS`` together: (number of the text, its words after a space each, symbols that only lead to the others)."""
    run, size = [], 0
    for i, t in enumerate(texts):
        words, at = " ".join(t.split()), 0
        while at < len(words):
            cut = words.find(" ", at + RUN_CHARS)
            cut = len(words) if cut < 0 else cut
            lead = words[words.rfind(" ", 0, at - 1) + 1:at - 1] + " " if at else ""
            piece = (i, f" {lead}{words[at:cut]}", len(lead))
            if run and size + len(piece[1]) > RUN_CHARS:
                yield run
                run, size = [], 0
            run.append(piece)
            size += len(piece[1])
            at = cut + 1
    if run:
        yield run


def running_grams(run: list[tuple[int, str, int]], order: int) -> tuple[np.ndarray, _Grams, np.ndarray]:
    """The longest n-gram of each predicted symbol of a run's pieces, as a number among the distinct ones; these; and each piece's predicted symbols."""
    _, laid, leads = zip(*run)
    joined = "\n".join([*laid, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start, last = points == 32, points == 10  # each word's START, and the place after a text's last word
    at = np.flatnonzero(start)
    first = np.ones(len(at), dtype=bool)
    first[1:] = last[at[1:] - 1]
    reach = np.where(first, at, np.roll(at, 1))  # n-grams reach to the START of the word before
    word = np.cumsum(start) - 1 - start
    word[at[first]] += 1
    longest = np.minimum(np.arange(1, len(points) + 1) - reach[word], order).astype(np.int8)
    known = np.where(start, np.uint64(START), points)
    edges = np.flatnonzero(start | last)
    symbols = known.copy()
    symbols[edges] = END
    h = key = np.zeros(len(points), dtype=np.uint64)
    for k in range(1, order + 1):
        left = np.zeros(len(points), dtype=np.uint64)
        left[1:] = h[:-1]
        left *= _A
        h = _mix(left + symbols + np.uint64(k))
        key = np.where(longest >= k, h, key)
        if k < order:
            h[edges] = _mix(left[edges] + known[edges] + np.uint64(k))
    predicted = np.ones(len(points), dtype=bool)
    for i, lead in zip(at[first].tolist(), leads):
        predicted[i:i + 1 + lead] = False
    key = gram_key(key, longest.astype(np.uint64))[predicted]
    number, names = pd.factorize(key)
    place = np.empty(len(names), dtype=np.int64)
    place[number] = np.flatnonzero(predicted)
    s = known.astype(np.uint32)[np.maximum(place[:, None] + np.arange(1 - order, 1), 0)]
    s[:, -1] = symbols[place]
    return number, _Grams(s, longest[place], names, np.bincount(number, minlength=len(names))), np.fromiter(map(len, laid), dtype=np.int64, count=len(laid)) - leads


def running_keys(texts: Iterable[str], order: int) -> np.ndarray:
    """As ``distinct_keys``, for running texts; sorted."""
    found, held = _Grams.merged([], order), []
    for run in running_pieces(texts):
        held.append(running_grams(run, order)[1])
        if sum(len(g.key) for g in held) > RUN_GRAMS:
            found, held = _Grams.merged([found, *held], order), []
    keys = [gram_key(np.zeros(1, dtype=np.uint64), 0)]
    for k, at, h, ctx, _ in _Grams.merged([found, *held], order).orders():
        keys += [distinct_sorted(gram_key(h[at], k)), distinct_sorted(gram_key(ctx[at], k - 1))]
    return distinct_sorted(np.concatenate(keys))


def running_logprobs(texts: list[str], order: int, keys: pd.Index, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, classes) log-probabilities and each text's predicted symbols."""
    classes = values.shape[1] // 2
    out, symbols = np.zeros((len(texts), classes)), np.zeros(len(texts), dtype=np.int64)
    pieces = running_pieces(texts)
    while runs := list(islice(pieces, RUNS)):
        held, found = [], _Grams.merged([], order)
        for run in runs:
            number, grams, sizes = running_grams(run, order)
            held.append((number.astype(np.int32), grams.key, sizes))
            found = _Grams.merged([found, grams], order)
        p = np.full((len(found.key), classes), 1 / ALPHABET)
        for k, at, h, ctx, _ in found.orders():
            share, weight = _looked(keys, values, gram_key(h[at], k))[:, :classes], _looked(keys, values, gram_key(ctx[at], k - 1))[:, classes:]
            p[at] = share + weight * p[at]
        logs, places = np.log(np.maximum(p, 1e-12)), pd.Index(found.key)
        for run, (number, key, sizes) in zip(runs, held):
            owner, own = [i for i, _, _ in run], logs[places.get_indexer(key)]
            np.add.at(symbols, owner, sizes)
            for c in range(classes):
                np.add.at(out[:, c], owner, np.add.reduceat(own[:, c][number], np.cumsum(sizes) - sizes))
    return out, symbols


# --- training ---------------------------------------------------------------------------


def count_grams(texts: DataFrame, order: int, tokens: Callable[[str], list[str]] | None) -> DataFrame:
    """(tag, gram, ctx, suffix, c) from ``texts`` (cls int, text), counted map-side per run of rows and then by Spark.

    ``tag`` packs class, order and whether the n-gram starts its word (see ``_untag``).
    """
    def run_on(batches):
        held: dict[int, _Grams] = {}
        for batch in batches:
            for part in slices(batch, "text", RUN_CHARS):
                by_class: dict[int, list[str]] = {}
                for cls, text in zip(part.column("cls").to_pylist(), part.column("text").to_pylist()):
                    by_class.setdefault(cls, []).append(text or "")
                for cls, own in by_class.items():
                    for run in running_pieces(own):
                        grams = running_grams(run, order)[1]
                        held[cls] = _Grams.merged([held[cls], grams], order) if cls in held else grams
                        if len(held[cls].key) > RUN_GRAMS:
                            yield from _counted(cls, held.pop(cls))
        for cls, grams in held.items():
            yield from _counted(cls, grams)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                by_class: dict[int, Counter] = {}
                for cls, text in zip(part.column("cls").to_pylist(), part.column("text").to_pylist()):
                    by_class.setdefault(cls, Counter()).update(tokens(text or ""))
                for cls, words in by_class.items():
                    if words:
                        yield from _grams(cls, words, order)

    return texts.select("cls", "text").mapInArrow(run_on if tokens is RUNNING else run, "tag int, gram long, ctx long, suffix long, c long").groupBy("tag", "gram").agg(
        F.first("ctx").alias("ctx"), F.first("suffix").alias("suffix"), F.sum("c").alias("c"))


def _untag(df: DataFrame) -> DataFrame:
    return df.select(F.expr("tag div 64 - 1").cast("int").alias("cls"), F.expr("(tag & 63) div 2").cast("int").alias("k"),
                     (F.col("tag") % 2 == 1).alias("initial"), *[c for c in df.columns if c != "tag"])


def _grams(cls: int, words: Counter, order: int):
    symbols, place, lens, predicted = word_symbols(list(words))
    times = np.repeat(np.fromiter(words.values(), dtype=np.int64, count=len(words)), lens)
    h = gram_hashes(symbols, order)
    for k in range(1, order + 1):
        at = np.flatnonzero((place >= k - 1) & predicted)
        grams, first, back = np.unique(h[k][at], return_index=True, return_inverse=True)
        first = at[first]
        n = len(grams)
        yield pa.RecordBatch.from_arrays([
            pa.array((64 * (cls + 1) + 2 * k + (symbols[first - k + 1] == START)).astype(np.int32)), pa.array(grams.view(np.int64)),
            pa.array(h[k - 1][first - 1].view(np.int64)), pa.array(h[k - 1][first].view(np.int64)),
            pa.array(np.bincount(back, weights=times[at]).astype(np.int64))], names=["tag", "gram", "ctx", "suffix", "c"])


def _counted(cls: int, grams: _Grams):
    for k, at, h, ctx, suffix in grams.orders():
        code, found = pd.factorize(h[at])
        first = np.empty(len(found), dtype=np.int64)
        first[code] = at
        yield pa.RecordBatch.from_arrays([
            pa.array((64 * (cls + 1) + 2 * k + (grams.s[first, -k] == START)).astype(np.int32)), pa.array(found.view(np.int64)),
            pa.array(ctx[first].view(np.int64)), pa.array(suffix[first].view(np.int64)),
            pa.array(np.bincount(code, weights=grams.times[at], minlength=len(found)).astype(np.int64))], names=["tag", "gram", "ctx", "suffix", "c"])


def train(counts: DataFrame, order: int, classes: int = 1, shared: int = 0) -> DataFrame:
    """The model's rows (key, v: each class's share, then each class's weight, 4 bytes each) from ``count_grams``, stored."""
    tables = [stored(counts)]
    counts = _untag(tables[0])
    pooled = counts.groupBy("k", "gram").agg(F.first("ctx").alias("ctx"), F.first("suffix").alias("suffix"), F.first("initial").alias("initial"),
                                             F.sum("c").alias("c")).withColumn("cls", F.lit(POOL)) if shared else None
    own = counts if not shared else counts.union(pooled.select(counts.columns))
    wanted = (F.col("k") > shared) if not shared else ((F.col("cls") == POOL) == (F.col("k") <= shared))
    left = own.where("k >= 2").groupBy("cls", (F.col("k") - 1).alias("k"), F.col("suffix").alias("gram")).agg(F.count("*").alias("n_left"))
    tables.append(stored(own.where(wanted).join(left, ["cls", "k", "gram"], "left").select(
        F.expr("(cls + 1) * 64 + 2 * k").alias("tag"), "gram", "ctx",
        F.when((F.col("k") == order) | F.col("initial"), F.col("c")).otherwise(F.coalesce("n_left", "c")).alias("c"))))
    adjusted = _untag(tables[1])
    rows = adjusted.where("c <= 4").groupBy("cls", "k", "c").count().collect()  # at most 4 a class and order
    n = {(r["cls"], r["k"], r["c"]): r["count"] for r in rows}
    discounts = []
    for cls in ([POOL] if shared else []) + list(range(classes)):
        for k in range(1, order + 1):
            n1, n2, n3, n4 = (n.get((cls, k, i), 0) for i in range(1, 5))
            y = n1 / (n1 + 2 * n2) if n1 else 0.5
            d = [min(max(i - (i + 1) * y * b / a, 0.1), i) if a and b else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            discounts.append((cls, k, *map(float, d)))
    table = F.broadcast(counts.sparkSession.createDataFrame(discounts, "cls int, k int, d1 double, d2 double, d3 double"))
    cut = adjusted.join(table, ["cls", "k"]).withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
    contexts = cut.groupBy("cls", "k", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
    none = F.lit(None).cast("double")
    grams = cut.join(contexts, ["cls", "k", "ctx"]).select("cls", "k", F.col("gram").alias("h"),
                                                         ((F.col("c") - F.col("d")) / F.col("total")).alias("share"), none.alias("weight"))
    values = grams.union(contexts.select("cls", F.col("k") - 1, F.col("ctx").alias("h"), none, F.col("left") / F.col("total")))

    def each(column: str, absent: float) -> list:
        """A value a class. A class that never saw a context leaves all of its weight to the lower order."""
        return [F.coalesce(F.max(F.when(F.col("cls").isin(POOL, c), F.col(column))), F.lit(absent)).cast("float").alias(f"{column}{c}") for c in range(classes)]

    wide = values.groupBy("k", "h").agg(*each("share", 0.0), *each("weight", 1.0))
    names = [f.name for f in wide.schema.fields[2:]]

    def keyed(batches):
        for b in batches:
            key = _mix(b.column("h").to_numpy().view(np.uint64) + np.uint64(2) * b.column("k").to_numpy().astype(np.uint64))
            v = np.stack([b.column(n).to_numpy() for n in names], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array([r.tobytes() for r in v.astype("<f4")], pa.binary())], names=["key", "v"])

    model = stored(wide.mapInArrow(keyed, "key long, v binary"))
    discard(*tables)
    del counts, pooled, own, left, adjusted, cut, contexts, grams, values, wide, tables
    release(model.sparkSession)  # the counts' shuffles
    return model


# --- scoring ----------------------------------------------------------------------------


def distinct_keys(words: list[str], order: int) -> np.ndarray:
    """Keys of all n-grams of the words, the empty one included; a context of one order is an n-gram of the order below."""
    symbols, place, _, predicted = word_symbols(words)
    h = gram_hashes(symbols, order)
    found = [gram_key(np.zeros(1, dtype=np.uint64), 0)]
    for k in range(1, order + 1):
        at = place >= k - 1
        found.append(gram_key(pd.unique(h[k][at & predicted if k == order else at]), k))
    return np.concatenate(found)


def _looked(keys: pd.Index, values: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The values of ``k``. Absent n-grams have share 0 and leave all weight below."""
    absent = np.repeat([0.0, 1.0], values.shape[1] // 2)
    at = keys.get_indexer(k)
    return np.where((at < 0)[:, None], absent, values[at]) if len(keys) else np.tile(absent, (len(k), 1))


def word_logprobs(words: list[str], order: int, keys: pd.Index, values: np.ndarray) -> np.ndarray:
    """(words, classes) log-probabilities; ``values`` (keys, shares and weights)."""
    if len(words) > WORDS:
        return np.concatenate([word_logprobs(words[at:at + WORDS], order, keys, values) for at in range(0, len(words), WORDS)])
    symbols, place, lens, predicted = word_symbols(words)
    h = gram_hashes(symbols, order)
    classes = values.shape[1] // 2
    look = lambda k: _looked(keys, values, k)
    p = [np.full(len(symbols), 1 / ALPHABET) for _ in range(classes)]
    below = np.zeros(len(symbols), dtype=np.int64)  # number of the context among the distinct n-grams one order below
    weights = look(gram_key(np.zeros(1, dtype=np.uint64), 0))[:, classes:]
    for k in range(1, order + 1):
        valid = np.flatnonzero(place >= k - 1)
        number, grams = pd.factorize(h[k][valid])
        code = np.zeros(len(symbols), dtype=np.int64)
        code[valid] = number
        at = valid[predicted[valid]]
        both = look(gram_key(grams, k))
        for c in range(classes):
            p[c][at] = both[:, c][code[at]] + weights[:, c][below[at - 1]] * p[c][at]
        below, weights = code, both[:, classes:]
    owner = np.repeat(np.arange(len(words)), lens)
    out = np.empty((len(words), classes))
    for c in range(classes):
        logs = np.log(np.maximum(p[c], 1e-12))
        logs[~predicted] = 0  # START and what stands before it are given
        out[:, c] = np.bincount(owner, weights=logs, minlength=len(words))
    return out


def _pack(items: list[bytes]) -> bytes:
    head = np.array([len(items), *map(len, items)], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(items))


def _unpack(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31)
    n = int(np.frombuffer(raw[:4], dtype="<u4")[0])
    lens = np.frombuffer(raw[4:4 + 4 * n], dtype="<u4").tolist()
    out, at = [], 4 + 4 * n
    for k in lens:
        out.append(raw[at:at + k])
        at += k
    return out


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences, byte by byte, so that the leading bytes, mostly zeros, compress."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_keys(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _pack_values(v: np.ndarray) -> bytes:
    """Rows of numbers of 4 bytes, byte by byte: n-grams that were seen once share most of theirs."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(v, dtype="<f4").view(np.uint8).reshape(len(v), 4 * v.shape[1]).T.tobytes())


def _unpack_values(data: bytes, columns: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4 * columns, -1).T).view("<f4")


def _runs(batches, block_chars: int):
    """(name, ids, texts as bytes): runs of a task's rows of about ``block_chars`` bytes, named by their ids."""
    ids, held, size = [], [], 0
    for part in (p for batch in batches for p in slices(batch, "text", SLICE_CHARS)):
        for i, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
            b = (t or "").encode()
            if held and size + len(b) > block_chars:
                yield xxhash.xxh3_64_intdigest(b"".join(ids)) - (1 << 63), ids, held
                ids, held, size = [], [], 0
            ids.append(i)
            held.append(b)
            size += len(b)
    if held:
        yield xxhash.xxh3_64_intdigest(b"".join(ids)) - (1 << 63), ids, held


def _words_of(texts: list[bytes], tokens) -> list[str]:
    seen: set[str] = set()
    for b in texts:
        seen.update(tokens(b.decode()))
    return list(seen)


def score(texts: DataFrame, model: DataFrame, order: int, classes: int, tokens: Callable[[str], list[str]] | None,
          features: Callable[[np.ndarray, np.ndarray], list[float]], names: list[str]) -> DataFrame:
    """(id, *names) for ``texts`` (id binary, text): ``features(logprobs (words, classes), symbols (words,))`` of each text.

    Running text counts as one word (as none, if it is blank).

    The rows are read twice, for the blocks' keys and for their texts, in the same
    order and partitions both times: rows that do not come straight from files, but
    from a shuffle, are stored first. A block is named by the ids in it.
    """
    rows = texts.select("id", "text")
    if "Exchange" in rows._jdf.queryExecution().executedPlan().toString():
        rows = stored(rows)
    shards = LEAST_SHARDS  # a power of two that follows the session's partitions: a key's shard is its low bits
    while shards < int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        shards *= 2

    block_chars = RUNNING_BLOCK_CHARS if tokens is RUNNING else BLOCK_CHARS

    def hold(batches):
        for block, ids, held in _runs(batches, block_chars):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_pack(ids)], pa.binary()), pa.array([_pack(held)], pa.binary())],
                                             names=["block", "ids", "payload"])

    def ask(batches):
        """A block's distinct keys by shard, sorted."""
        for block, _, held in _runs(batches, block_chars):
            if tokens is RUNNING:
                keys = running_keys((b.decode() for b in held), order)
            else:
                words = _words_of(held, tokens)
                found = [np.empty(0, dtype=np.uint64)]
                for at in range(0, len(words), WORDS):
                    found.append(distinct_keys(words[at:at + WORDS], order))
                keys = distinct_sorted(np.concatenate(found))
                del words, found
            shard = (keys & np.uint64(shards - 1)).astype(np.int64)
            cuts = np.searchsorted(np.sort(shard), np.arange(shards + 1))
            keys = keys[np.argsort(shard, kind="stable")]
            parts = [keys[cuts[s]:cuts[s + 1]] for s in range(shards)]
            some = [s for s in range(shards) if s == 0 or len(parts[s])]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()),
                                              pa.array([_pack_keys(parts[s]) for s in some], pa.binary())], names=["shard", "block", "keys"])

    held = rows.mapInArrow(hold, "block long, ids binary, payload binary")
    asked = rows.mapInArrow(ask, "shard int, block long, keys binary")
    known = model.select(F.expr(f"CAST(key & {shards - 1} AS INT)").alias("shard"), "key", "v")

    def answer(key, left, right):
        """Of the keys that a shard's blocks ask for those that it holds, with their values."""
        model_keys, model_values = [], []
        for b in right:
            model_keys.append(b.column("key").to_numpy().view(np.uint64))
            model_values.append(np.frombuffer(b"".join(b.column("v").to_pylist()), dtype="<f4").reshape(-1, 2 * classes))
        mk = np.concatenate(model_keys) if model_keys else np.empty(0, dtype=np.uint64)
        mv = np.concatenate(model_values) if model_values else np.empty((0, 2 * classes), dtype=np.float32)
        order_ = np.argsort(mk)
        mk, mv = mk[order_], mv[order_]
        for b in left:
            for block, data in zip(b.column("block").to_pylist(), b.column("keys")):
                keys = _unpack_keys(data.as_py())
                at = np.minimum(np.searchsorted(mk, keys), max(len(mk) - 1, 0))
                hit = mk[at] == keys if len(mk) else np.zeros(len(keys), dtype=bool)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_pack_keys(keys[hit])], pa.binary()),
                                                  pa.array([_pack_values(mv[at[hit]])], pa.binary())], names=["block", "keys", "vals"])

    answers = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(on_tables(answer, "block long, keys binary, vals binary"), "block long, keys binary, vals binary")

    def finish(key, left, right):
        keys, vals = [np.empty(0, dtype=np.uint64)], [np.empty((0, 2 * classes), dtype=np.float32)]
        left, right = list(left), list(right)
        if sum(b.num_rows for b in left) and not sum(b.num_rows for b in right):
            raise RuntimeError("a block of texts has no answers")
        for b in right:
            for k, v in zip(b.column("keys"), b.column("vals")):
                keys.append(_unpack_keys(k.as_py()))
                vals.append(_unpack_values(v.as_py(), 2 * classes))
        keys, vals = np.concatenate(keys), np.concatenate(vals)
        keys, first = np.unique(keys, return_index=True)
        keys, vals = pd.Index(keys), vals[first]
        for b in left:
            for ids, payload in zip(b.column("ids"), b.column("payload")):
                yield from _score_block(_unpack(ids.as_py()), _unpack(payload.as_py()), keys, vals)

    def _score_running(ids, payload, keys, vals):
        logs, sizes = running_logprobs([b.decode() for b in payload], order, keys, vals)
        some = (sizes > 0).astype(int)
        cols = zip(*[features(logs[i:i + some[i]], sizes[i:i + some[i]]) for i in range(len(ids))])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), *[pa.array(c, pa.float64()) for c in cols]], names=["id", *names])

    def _score_block(ids, payload, keys, vals):
        if tokens is RUNNING:
            yield from _score_running(ids, payload, keys, vals)
            return
        number: dict[str, int] = {}
        logs, sizes = np.empty((0, classes)), np.empty(0)
        at = 0
        while at < len(payload):
            run, size = [], 0
            while at + len(run) < len(payload) and (not run or size + len(payload[at + len(run)]) <= SLICE_CHARS):
                run.append(tokens(payload[at + len(run)].decode()))
                size += len(payload[at + len(run) - 1])
            new = list(set().union(*run).difference(number))
            number.update(zip(new, range(len(number), len(number) + len(new))))
            if new:
                logs = np.concatenate([logs, word_logprobs(new, order, keys, vals)])
                sizes = np.concatenate([sizes, np.fromiter((len(w) - w.find("\n") for w in new), dtype=np.float64, count=len(new))])
            rows = []
            for words in run:
                w = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
                rows.append(features(logs[w], sizes[w]))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at:at + len(run)], pa.binary()), *[pa.array(c, pa.float64()) for c in cols]], names=["id", *names])
            at += len(run)

    schema = "id binary, " + ", ".join(f"{n} double" for n in names)
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(on_tables(finish, schema), schema)


def on_tables(fn, schema: str):
    """A cogroup function over record batches as one over tables."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = list(fn(key, left.to_batches(), right.to_batches()))
        return pa.Table.from_batches(out, schema=arrow) if out else arrow.empty_table()

    return run
