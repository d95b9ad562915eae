"""BPE against the tiktoken library and packing against the tokenizers library."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesfacts.llm.bpe import Bpe, decode, encode
from salesfacts.llm.packing import WordTokenizer, pack, place, plan
from salesfacts.llm.queries import QUERIES, split_pattern, tokenizer_file

from conftest import SF_SMALL
from .conftest import empty

RANKS = tokenizer_file("byte_bpe_50k.tiktoken")
WORDS = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return Bpe(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
def test_encode_equals_tiktoken_and_decodes(bpe, tik, texts):
    ids, decoded = bpe.encode(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [tik.encode_ordinary(t) for t in texts]
    assert decoded == [t.encode() for t in texts] == bpe.decode(ids)


def test_unknown_ids_give_no_bytes_and_move_no_other_text(bpe):
    unknown, known = np.array([65_000], "<u4").tobytes(), bpe.encode(["two words"])[0][0]
    assert bpe.decode([unknown, known, b"", known + unknown]) == [b"", b"two words", b"", b"two words"]


def test_long_words_follow_the_same_rule(bpe, tik):
    for t in ("a" * 5000, "abcab" * 400, "=" * 1000, " " * 700 + "x", "thththeererin" * 90):
        assert np.frombuffer(bpe.encode([t])[0][0], "<u4").tolist() == tik.encode_ordinary(t)
    words = [b"thereinthe" * 20, b"hello" * 30]
    assert [bpe.contract_long(w) for w in words] == [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_words(words)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbBjJtTwW \n\t\u030c\u0331\u0308éÉ\u0130ΣσςK'.,1\u00a0", max_size=30), min_size=1, max_size=6))
def test_remembered_words_equal_the_tokenizer(texts):
    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    assert [np.frombuffer(x, "<u4").tolist() for x in WordTokenizer(WORDS, 5).encode(texts)] == [
        e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_encode_frame_with_odd_rows(spark, odd_docs, tik):
    df = odd_docs.withColumn("ids", F.lit("clash"))
    out = encode(df, RANKS, split_pattern()).collect()
    assert len(out) == df.count()
    for r in out:
        t = r["text"] or ""
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == tik.encode_ordinary(t) and bytes(r["decoded"]).decode() == t
    assert encode(empty(df), RANKS, split_pattern()).count() == 0
    again = decode(encode(df, RANKS, split_pattern()).drop("decoded"), RANKS, split_pattern()).collect()
    assert sorted(bytes(r["decoded"]) for r in again) == sorted((r["text"] or "").encode() for r in out)


def test_query_digests(spark, tik):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in QUERIES["op1_byte_bpe"](spark, SF_SMALL).collect():
        ids = np.array(tik.encode_ordinary(texts[r["doc_id"]]), dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def _gapless(rows, max_len=2048):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_len
    return by


def test_pieces_equal_the_tokenizer_and_fill_sequences(spark, odd_docs):
    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    rows = pack(odd_docs, WORDS).collect()
    want = []
    for r in odd_docs.collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want += [(r["doc_id"], k, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(key, want)) == sorted(key((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    by = _gapless(rows)
    assert len(by) == -(-sum(r["length"] for r in rows) // 2048) or len(by) <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert pack(empty(odd_docs), WORDS).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25))
def test_plan_gives_every_rank_one_slot(histogram):
    slots, used, seen = plan(histogram, 50), {}, {}
    for length, lo, hi, seq, offset in slots:
        for k in range(hi - lo):
            seen.setdefault(length, []).append(lo + k)
            used.setdefault(seq + k, []).append((offset, length))
    assert {n: sorted(v) for n, v in seen.items()} == {n: list(range(c)) for n, c in histogram.items()}
    total = 0
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 50
        total += at
    least = max(-(-total // 50), sum(c for n, c in histogram.items() if n > 25))
    assert len(used) <= 1.5 * least + 1


def test_a_length_that_all_pieces_share_is_ranked_by_many_shares(spark):
    parts = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).alias("start"),
                                     F.lit(300).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    rows = place(parts).collect()
    assert len(rows) == 5000 and len(_gapless(rows)) == -(-5000 // 6)


def test_many_distinct_long_words_fit_the_memory(bpe):
    rng = np.random.default_rng(3)
    words = [rng.integers(97, 123, rng.integers(230, 251), dtype=np.uint8).tobytes() for _ in range(1300)]
    got = bpe.encode_words(words)
    assert [np.frombuffer(x, "<u4").tolist() for x in got[::40]] == [bpe.contract_long(w) for w in words[::40]]
    assert bpe.decode(got) == words



def test_added_tokens_equal_the_unchanged_tokenizer():
    tok = Tokenizer.from_file(WORDS)
    texts = ["a b <|endoftext|> c", "x<|startoftext|>y", "<|endoftext|>", "<|ENDOFTEXT|> z", "<|endoftext| > Plain text", "ordinary words", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in WordTokenizer(WORDS, 5).encode(texts)] == [
        e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
