"""Byte-level BPE encoding and decoding by recursive DuckDB queries.

Texts are split by the vocabulary's pattern. The distinct words of a run of rows
become token-position rows in an in-process DuckDB, one per Python worker. A
recursive query joins neighbouring positions with the merge table and contracts
each word's leftmost pair of least rank until no pair has a rank. Decoding joins
ids with the vocabulary and aggregates the bytes in position order.

Words over ``LONG_WORD`` bytes (runs without any break) would need as many
iterations as they have bytes, each over all their rows; the same rule is applied
to them over a heap of pairs, which is exact as well. The query keeps the rows of all
its steps, about half the square of a word's length; its runs are bounded by that.

Defined results: null text gives no ids; repeated rows are encoded each; an empty
table gives no rows; input columns named ``ids`` / ``decoded`` are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField

from salesfacts.llm.common import append_columns

LONG_WORD = 256
CACHE_WORDS = 350_000
BATCH_WORDS, BATCH_SQUARES = 40_000, 8_000_000  # words of a run of the recursive query, and the sum of their squared lengths

ENCODE = """
WITH RECURSIVE step AS (
  SELECT word, pos, tok, false AS done FROM positions
  UNION ALL
  (WITH pairs AS (
     SELECT word, pos, tok, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos
     FROM step WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)),
   ranked AS (
     SELECT p.*, m.rank FROM pairs p LEFT JOIN merges m ON m.pair = p.tok::BIGINT * 65536 + p.next_tok),
   best AS (
     SELECT word, min((rank::BIGINT << 40) | (pos::BIGINT << 20) | next_pos::BIGINT) AS b
     FROM ranked GROUP BY word)
   SELECT r.word, r.pos, CASE WHEN r.pos = ((b >> 20) & 1048575) THEN (b >> 40)::INT ELSE r.tok END, b IS NULL
   FROM ranked r JOIN best USING (word) WHERE b IS NULL OR r.pos <> (b & 1048575)))
SELECT word, list(tok ORDER BY pos) AS ids FROM step WHERE done GROUP BY word ORDER BY word
"""

DECODE = """
SELECT seq, list(v.bytes ORDER BY pos) AS parts
FROM positions LEFT JOIN vocabulary v ON v.id = positions.tok GROUP BY seq ORDER BY seq
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _runs(items: list, squares: list[int]) -> Iterator[list]:
    """Cut items into runs of at most ``BATCH_WORDS`` whose squares sum up to at most ``BATCH_SQUARES``."""
    start, held = 0, 0
    for i, n in enumerate(squares):
        if i > start and (held + n > BATCH_SQUARES or i - start == BATCH_WORDS):
            yield items[start:i]
            start, held = i, 0
        held += n
    if start < len(items):
        yield items[start:]


class Bpe:
    """The merge table and vocabulary in DuckDB, with words remembered in two generations of ``cache_words``."""

    def __init__(self, ranks_path: str, pattern: str, cache_words: int = CACHE_WORDS):
        import duckdb
        import pyarrow as pa
        import regex

        self.ranks = read_ranks(ranks_path)
        self.split = regex.compile(pattern).findall
        self.limit, self.young, self.old = cache_words, {}, {}
        self.bytes_young: dict[bytes, bytes] = {}
        pairs = [(left * 65536 + right, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
                 if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.db.register("m", pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "rank": pa.array([r for _, r in pairs], pa.int32())}))
        self.db.register("v", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array(list(self.ranks), pa.binary())}))
        self.db.execute("CREATE TABLE merges AS FROM m")
        self.db.execute("CREATE TABLE vocabulary AS FROM v")

    def _rows(self, name: str, lists, key: str, of_byte=None):
        import numpy as np
        import pyarrow as pa

        lens = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // (1 if of_byte is not None else 4)
        flat = np.frombuffer(b"".join(lists), dtype=np.uint8 if of_byte is not None else "<u4")
        starts = np.cumsum(lens) - lens
        self.db.register(name, pa.table({
            key: np.repeat(np.arange(len(lists), dtype=np.int32), lens),
            "pos": (np.arange(len(flat)) - np.repeat(starts, lens)).astype(np.int32),
            "tok": of_byte[flat] if of_byte is not None else flat.astype(np.int32)}))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (little-endian unsigned 32-bit) by the recursive query."""
        import numpy as np

        out: list[bytes] = [b""] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        for part in _runs(short, [len(words[i]) ** 2 for i in short]):
            self._rows("positions", [words[i] for i in part], "word", of_byte)
            got = self.db.sql(ENCODE).to_arrow_table().column("ids").combine_chunks()
            offsets = (4 * got.offsets.to_numpy()).tolist()
            flat = got.values.to_numpy().astype("<u4").tobytes()
            for k, i in enumerate(part):
                out[i] = flat[offsets[k]:offsets[k + 1]]
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = np.array(self.contract_long(w), dtype="<u4").tobytes()
        return out

    def contract_long(self, word: bytes) -> list[int]:
        """Contract the leftmost pair of least rank, over a heap of the word's pairs."""
        parts = [word[i:i + 1] for i in range(len(word))]
        after, before, alive = list(range(1, len(parts))) + [-1], [-1, *range(len(parts) - 1)], [True] * len(parts)
        heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or len(parts[i]) + len(parts[j]) != size:
                continue  # one side was contracted meanwhile
            parts[i], alive[j], after[i] = parts[i] + parts[j], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and (r := self.ranks.get(parts[a] + parts[after[a]])) is not None:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[after[a]])))
        return [self.ranks[p] for p, live in zip(parts, alive) if live]

    def decode(self, sequences: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence, joined in position order. A run's lists lie one after the other in one buffer
        of bytes; ids that the vocabulary lacks give none."""
        import numpy as np
        import pyarrow as pa

        out: list[bytes] = [b""] * len(sequences)
        some = [i for i, s in enumerate(sequences) if s]
        for at in range(0, len(some), 40_000):
            part = some[at:at + 40_000]
            self._rows("positions", [sequences[i] for i in part], "seq")
            lists = self.db.sql(DECODE).to_arrow_table().column("parts").combine_chunks()
            parts = lists.values.cast(pa.large_binary())
            _, offsets, data = parts.buffers()
            cut = np.frombuffer(offsets, dtype=np.int64)[parts.offset + lists.offsets.to_numpy()].tolist()
            data = data.to_pybytes() if data is not None else b""
            for k, i in enumerate(part):
                out[i] = data[cut[k]:cut[k + 1]]
        return out

    def learn(self, words: set[str]) -> None:
        if len(self.young) > self.limit:
            self.old, self.young, self.bytes_young = self.young, {}, {}
        need = words.difference(self.young)
        known = need & self.old.keys()
        self.young.update((w, self.old[w]) for w in known)
        new = sorted(need - known)
        self.young.update(zip(new, self.encode_words([w.encode() for w in new])))
        undecoded = sorted({self.young[w] for w in need}.difference(self.bytes_young))
        self.bytes_young.update(zip(undecoded, self.decode(undecoded)))

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Each text's ids, and the bytes that those ids decode to."""
        split = [self.split(t) if t else [] for t in texts]
        self.learn(set().union(*split) if split else set())
        ids = [list(map(self.young.__getitem__, words)) for words in split]
        return [b"".join(x) for x in ids], [b"".join(map(self.bytes_young.__getitem__, x)) for x in ids]


_BPE: dict[tuple[str, str], Bpe] = {}


def _bpe(path: str, pattern: str) -> Bpe:
    """One per Python worker: a worker that runs several tasks keeps its words."""
    if (path, pattern) not in _BPE:
        _BPE[path, pattern] = Bpe(path, pattern)
    return _BPE[path, pattern]


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` plus ``ids`` (binary: little-endian unsigned 32-bit) and ``decoded`` (binary: the bytes the ids stand for)."""
    return append_columns(df, text_col, [StructField("ids", BinaryType()), StructField("decoded", BinaryType())],
                          lambda: lambda texts: list(_bpe(ranks_path, pattern).encode(texts)))


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``df`` plus ``decoded`` for any column of binary ids (null: no bytes)."""
    return append_columns(df, ids_col, [StructField("decoded", BinaryType())],
                          lambda: lambda ids: [_bpe(ranks_path, pattern).decode([x or b"" for x in ids])])
