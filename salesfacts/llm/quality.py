"""Quality by perplexity under Kneser-Ney models of trusted text.

Interpolated modified Kneser-Ney models over the characters of words and across
their edges (``kneser_ney``) are trained on the trusted texts: those labelled of good
quality. All texts fall into ``FOLDS`` parts by a hash of the text; there is a model of the
trusted texts of each part, all trained and applied in one pass, and a text is
scored by the model of the next part. So no text, trusted or not, is scored by a model
that has seen it, and a trusted text's perplexity is what an unseen good text's would be.

A document's perplexity is exp of its mean negative log-likelihood a symbol, found by
sharded joins with the models' counts. Each language has its own threshold: the
``quantile`` of the perplexities of its trusted texts. Documents above it are not
kept.

Defined results: a null, empty or blank text has no perplexity (null) and is not
kept; a language without trusted texts uses the threshold of all of them; a null
language is a language of its own; without any trusted text all documents with
words are kept; where one part has no trusted text, its model gives every symbol the
same probability; repeated rows get the same result; an empty table gives no rows;
``perplexity``, ``threshold`` and ``kept`` replace columns of that name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.llm.common import checkpointed, discard
from salesfacts.llm.kneser_ney import RUNNING, count_grams, score, train
from salesfacts.llm.toxicity import SMALL_LABELS, text_id

ORDER = 5
QUANTILE = 0.98
FOLDS = 2


def tokens(text: str, order: int = ORDER) -> list[str]:
    """The words, each after the last symbols of the word before it, as ``RUNNING`` text has them (``kneser_ney``)."""
    words = text.split()
    tails = {w: ("\x02" + w)[2 - order:] if order > 2 else "" for w in set(words)}
    return words[:1] + [f"{tails[a]}\n{b}" for a, b in zip(words, words[1:])]


def features(logs: np.ndarray, sizes: np.ndarray) -> list[float]:
    """The text's log-likelihood under each part's model, and its symbols."""
    return [*map(float, logs.sum(axis=0)), float(sizes.sum())]


def fold(text: Column) -> Column:
    """The part that a text falls into."""
    return F.pmod(F.xxhash64(F.lit(11), text), F.lit(FOLDS)).cast("int")


def quality(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, order: int = ORDER) -> DataFrame:
    """``docs`` (doc_id, text, lang, ...) plus perplexity, threshold and kept; ``trusted_ids`` (doc_id) names the trusted texts."""
    trusted = checkpointed(trusted_ids.select(F.col("doc_id").cast("long").alias("_id")).where("_id IS NOT NULL").distinct())
    if trusted.count() <= SMALL_LABELS:
        trusted = F.broadcast(trusted)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"), "lang")
    # Not named, so that nothing holds the counts' shuffles once the model stands.
    model = train(count_grams(texts.join(trusted, "_id").select(fold(F.col("text")).alias("cls"), "text"), order, RUNNING), order, classes=FOLDS)
    logs = [f"logs{i}" for i in range(FOLDS)]
    # The part is the last byte of the id that the scores carry.
    named = texts.select(F.concat(text_id(F.col("text")), F.unhex(F.lpad(F.hex(fold(F.col("text"))), 2, "0"))).alias("id"), "text")
    scored = score(named, model, order, FOLDS, RUNNING, features, [*logs, "symbols"]).dropDuplicates(["id"])
    part = F.conv(F.hex(F.substring("id", 17, 1)), 16, 10).cast("int")
    seen_by = F.element_at(F.array(*logs), F.pmod(part + 1, F.lit(FOLDS)) + 1)
    scored = checkpointed(scored.select(F.substring("id", 1, 16).alias("_text_id"), F.when(F.col("symbols") > 0, F.exp(-seen_by / F.col("symbols"))).alias("perplexity")))
    discard(model)
    sample = texts.join(trusted, "_id").select("lang", text_id(F.col("text")).alias("_text_id")).join(scored, "_text_id").where("perplexity IS NOT NULL")
    limits = sample.rollup("lang").agg(F.grouping("lang").alias("_all"), F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    limits = checkpointed(limits)
    overall = limits.where("_all = 1").select("threshold").first()
    limits = limits.where("_all = 0").select(F.col("lang").alias("_lang"), "threshold")
    out = docs.drop("perplexity", "threshold", "kept").withColumn("_text_id", text_id(F.col("text").cast("string")))
    out = out.join(scored, "_text_id", "left").join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_text_id", "_lang")
    out = out.withColumn("threshold", F.coalesce("threshold", F.lit(overall["threshold"] if overall else None).cast("double")))
    return out.withColumn("kept", F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
