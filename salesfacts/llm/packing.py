"""Best-fit packing planned on the length histogram.

Documents are tokenised once and cut into pieces of at most ``max_len`` tokens.
The packing is planned on the histogram of piece lengths (at most ``max_len``
rows, whatever the corpus size), best fit in decreasing length, and the plan
says which ranks of a length go to which sequences. Each piece then takes its
slot by a join on its rank within its length.

Defined results: a null or empty text is one piece holding only the end id;
repeated rows are packed each; an empty table gives no rows; extra columns of
the input are not carried (the result is one row a piece).
"""

from __future__ import annotations

import bisect
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from salesfacts.llm.common import checkpointed, slices

MAX_LEN = 2048
END_ID = 0
RANK_BLOCK = 1024
CACHE_WORDS = 400_000
_COMBINING = re.compile("[\u0300-\u036f]")


class WordTokenizer:
    """Token ids of whole texts by a ``tokenizers`` file, remembering words.

    The vocabulary's pre-tokenizer always breaks at white space, so a text's ids
    are those of its space-separated words, joined. It also lower-cases, so words
    are remembered with A-Z lower-cased (not in texts with combining marks, which
    compose with some lower-case letters only). Two generations of at most
    ``cache_words`` words bound the memory. A text that holds an added token, such
    as <|endoftext|>, is encoded whole: the tokenizer cuts it there first.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.limit, self.young, self.old = cache_words, {"": b""}, {}

    def _learn(self, words: list[str]) -> None:
        import numpy as np

        groups = [words[i:i + 512] for i in range(0, len(words), 512)]
        for i in range(0, len(groups), 16):
            part = groups[i:i + 16]
            for group, e in zip(part, self.tokenizer.encode_batch(part, is_pretokenized=True, add_special_tokens=False)):
                ids = np.asarray(e.ids, dtype="<u4").tobytes()
                cuts = (4 * np.searchsorted(np.asarray(e.word_ids, dtype=np.int64), np.arange(len(group) + 1))).tolist()
                for k, w in enumerate(group):
                    self.young[w] = ids[cuts[k]:cuts[k + 1]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        whole = [bool(t and self.added and self.added.search(t)) for t in texts]
        split = [[] if w else (t if _COMBINING.search(t) else t.encode().lower().decode()).replace("\n", " ").split(" ") if t else [] for t, w in zip(texts, whole)]
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {"": b""}
        need = set().union(*split).difference(self.young) if split else set()
        known = need & self.old.keys()
        self.young.update((w, self.old[w]) for w in known)
        self._learn(sorted(need - known))
        return [self._whole(t) if w else b"".join(map(self.young.__getitem__, words)) for t, w, words in zip(texts, whole, split)]

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per Python worker: a worker that runs several tasks keeps its words."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


PIECES = StructType([StructField("doc_id", LongType()), StructField("piece", IntegerType()), StructField("start", LongType()),
                     StructField("length", LongType()), StructField("ids_crc32", LongType())])


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document's ids (its words' ids, then ``end_id``)."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), tok.encode(part.column("text").to_pylist())):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                        cut = ids[at:at + 4 * max_len]
                        rows.append((doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                                 names=PIECES.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, int, int, int, int]]:
    """Best fit in decreasing length over counts.

    Returns (length, first rank, end rank, first sequence, offset): rank r of the
    length goes to sequence ``first sequence + r - first rank`` at the offset.
    Open sequences are held as runs of consecutive numbers with the same room, so
    the work follows the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence, how many)]
    sizes: list[int] = []  # rooms with open sequences, ascending
    slots, fresh = [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                bisect.insort(sizes, left)
            room[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):  # the tightest open sequences that take the length
                left = sizes[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left]
                    sizes.pop(at)
            else:
                left, first = max_len, fresh
                n = -(-todo // (max_len // length))
                fresh += n
            each = left // length
            full = min(n, todo // each)
            for k in range(each):
                if full:
                    slots.append((length, rank, rank + full, first, max_len - left + k * length))
                    rank += full
            todo -= full * each
            put(left - each * length, first, full)
            first, n = first + full, n - full
            if n and todo:  # fewer pieces are left than the next sequence takes
                for k in range(todo):
                    slots.append((length, rank, rank + 1, first, max_len - left + k * length))
                    rank += 1
                put(left - todo * length, first, 1)
                first, n, todo = first + 1, n - 1, 0
            put(left, first, n)
    return slots


def place(parts: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``parts`` (with doc_id, piece, length; materialised) plus sequence_id and offset.

    The rank of a piece within its length is its rank within a hash share of the
    rows plus the counts of the earlier shares, so a length that a third of all
    pieces have is ranked by many tasks.
    """
    spark = parts.sparkSession
    shares = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares)))
    counts = checkpointed(parts.groupBy("_share", "length").agg(F.count("*").alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most max_len rows
    slots = plan(histogram, max_len)
    blocks = spark.createDataFrame(slots, "length long, _lo long, _hi long, _seq long, offset long").withColumn(
        "_block", F.explode(F.sequence(F.expr(f"_lo div {RANK_BLOCK}"), F.expr(f"(_hi - 1) div {RANK_BLOCK}"))))
    before = counts.select("_share", "length", (F.sum("_n").over(Window.partitionBy("length").orderBy("_share")) - F.col("_n")).alias("_before"))
    ranked = parts.repartition("_share").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_share", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(before, ["_share", "length"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    ranked = ranked.withColumn("_block", F.expr(f"_rank div {RANK_BLOCK}"))
    placed = ranked.join(blocks, ["length", "_block"]).where("_rank >= _lo and _rank < _hi")
    return placed.withColumn("sequence_id", F.col("_seq") + F.col("_rank") - F.col("_lo"))


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = checkpointed(pieces(docs, tokenizer_path, max_len, end_id))
    return place(parts, max_len).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
