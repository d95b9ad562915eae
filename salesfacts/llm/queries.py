"""The operators applied to whole tables with production parameters: one query each."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesfacts.llm.common import table


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file; SALESFACTS_TOKENIZERS names another folder."""
    if folder := os.environ.get("SALESFACTS_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.bpe import encode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode(docs, tokenizer_file("byte_bpe_50k.tiktoken"), split_pattern())
    return done.select("doc_id", F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=20, query_every=20)


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short_repeats=True).select("doc_id", "n_lines", "n_dropped", "text")


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.near_dup import near_duplicates

    done = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2, similarity=0.8)
    return done.select("doc_id", "n_shingles", "component_id", "kept")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.secrets import BASE_RULES, find_secrets, span_text

    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["ord"] < len(BASE_RULES))
    counts = [F.expr(f"size(filter(spans, s -> s.ord = {i}))").cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=5, query_every=50)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.toxicity import held_out, score_toxicity

    scored = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.quality import quality

    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    done = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), trusted)
    return done.select("doc_id", "lang", "perplexity", "threshold", "kept")


def op11_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.sharding import assign_shards

    placed = assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.codes import books_sha256, code_text, vector_codes

    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", code_text(F.col("codes")).alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesfacts.llm.whitening import whitened_embeddings

    rows = whitened_embeddings(table(spark, sf_dir, "embeddings"))
    each = rows.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "explained", "identity_error",
                       F.posexplode("whitened").alias("_i", "whitened"))
    return each.select("vec_id", (F.col("_i") + 1).alias("component"), "n", "deviation", "whitened",
                       F.col("explained")[F.col("_i")].alias("explained"), "identity_error")


def _oracles() -> dict[str, str]:
    from salesfacts.llm.codes import codes_sql
    from salesfacts.llm.sharding import shards_sql

    return {"op11_interleaved_shards": shards_sql(), "op12_vector_codes": codes_sql()}


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_hilbert_neighbours": op2_hilbert_neighbours,
    "op3_html_main_text": op3_html_main_text,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_chosen_path": op5_chosen_path,
    "op6_secret_scan": op6_secret_scan,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_interleaved_shards": op11_interleaved_shards,
    "op12_vector_codes": op12_vector_codes,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = _oracles()
