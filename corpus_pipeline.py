"""Corpus cleaning: documents -> toxicity filter -> line dedup -> near-dedup -> secret redaction -> packed sequences.

Each stage works on everything its predecessor kept and returns the columns of
documents (the last one: a row a piece with its place). ``run`` materialises every
stage as Parquet under spark.checkpoint.dir, so a later stage never recomputes an
earlier one, also after lost executors; a stage's table goes when the next one stands.

Defined results, stage by stage: a null or empty text passes the toxicity filter if its
score does, has no lines to lose, is no near copy, holds no secret and is packed as an
empty document; a null doc_id is scored, keeps its lines, is no near copy and is packed; rows
that repeat are judged alike, and of their near copies all but those with the least id
go; an empty table gives no rows, and without labels of both classes no document is toxic.
Columns of ``docs`` that are named like an operator's results keep their own values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesfacts.llm.line_dedup import dedup_lines
from salesfacts.llm.near_dup import near_duplicates
from salesfacts.llm.packing import pack
from salesfacts.llm.queries import tokenizer_file
from salesfacts.llm.secrets import find_secrets, redact
from salesfacts.llm.toxicity import score_toxicity
from salesfacts.session import ensure_checkpoint_dir
from salesfacts.sources.files import remove

# Packing has no SQL form (a tokenizer), nor have the trained scores; tests compare with brute force.
ORACLE_SQL = None


def _counted(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, n_chars following the text."""
    kinds = dict(df.dtypes)
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.char_length("text").cast(kinds["n_chars"]))
    return df.select(columns)


def _beside(docs: DataFrame, results: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` on ``docs`` with the columns named like its ``results`` put aside meanwhile."""
    aside = {c: f"_own_{c}" for c in docs.columns if c.lower() in results}
    done = stage(docs.withColumnsRenamed(aside))
    return done.drop(*aside).withColumnsRenamed({own: c for c, own in aside.items()}).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _beside(docs, ("score", "predicted"), lambda d: score_toxicity(d, labels).where("predicted = 0"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of alike lines the first stays; a document keeps its row even if all its lines stand elsewhere."""
    return _counted(_beside(docs, ("n_lines", "n_dropped"), lambda d: dedup_lines(d, short_repeats=True)), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (shingles of five words, similarity 0.8)."""
    return _beside(docs, ("n_shingles", "component_id", "kept"), lambda d: near_duplicates(d, shingle=5, similarity=0.8).where("kept"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret's characters are replaced by a mark."""
    found = _beside(docs, ("spans",), lambda d: find_secrets(d).withColumn("text", redact(F.col("text"), F.col("spans"))))
    return _counted(found, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{i}")
        docs = spark.read.parquet(f"{out}/{i}")
        if i:
            remove(spark, f"{out}/{i - 1}")
    return docs
