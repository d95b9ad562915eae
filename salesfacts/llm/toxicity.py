"""Toxicity by class-conditional Kneser-Ney models.

Two character models of the words are trained, on toxic and on ordinary labelled
texts (``kneser_ney``); both back off to shared low-order counts, so an expression
that one class saw rarely or never is judged by its parts. A word's evidence is the
difference of its log-likelihoods under the two. A text's features are that
difference normalised by length (the mean over its words, the best mean over
``WINDOW`` words in a row, the best single words), and a logistic function of them
is the score. Its few weights are fitted on labelled rows that the models have not
seen, at most ``FIT_ROWS`` of them, chosen by hash; the counts use all others.

A text's score depends on the text alone. Equal texts share it.

Defined results: a null, empty or blank text has no evidence (features 0) and gets
the score that goes with that; a null or repeated doc_id is scored like any row; a
label that is null is ignored, and an id labelled both ways counts as toxic; without
labels of both classes every score is 0; ``score`` and ``predicted`` replace columns
of that name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesfacts.llm.common import checkpointed, discard
from salesfacts.llm.kneser_ney import count_grams, score, train

ORDER, SHARED = 5, 2
WINDOW = 16
FIT_ROWS = 20_000
THRESHOLD = 0.3
SMALL_LABELS = 2_000_000  # rows (16 bytes each) up to which labels are broadcast
FEATURES = ["f_mean", "f_window", "f_first", "f_second", "f_third"]


def tokens(text: str) -> list[str]:
    return text.lower().split()


def features(logs: np.ndarray, sizes: np.ndarray) -> list[float]:
    if not len(logs):
        return [0.0] * len(FEATURES)
    diff = logs[:, 0] - logs[:, 1]
    total = np.concatenate([[0.0], np.cumsum(diff)])
    w = min(WINDOW, len(diff))
    best = np.sort(np.partition(diff, -3)[-3:])[::-1] if len(diff) >= 3 else np.sort(diff)[::-1]
    best = np.concatenate([best, np.zeros(3 - len(best))])
    return [float(total[-1] / len(diff)), float((total[w:] - total[:-w]).max() / WINDOW), *map(float, best)]


def text_id(text: Column) -> Column:
    """16 bytes that name a text."""
    return F.unhex(F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(3), text)), 16, "0")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def _fit(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic weights (bias first) by Newton steps with a small penalty, on standardised features."""
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.hstack([np.ones((len(x), 1)), (x - mean) / spread])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * np.r_[0, w[1:]]
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, spread


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, order: int = ORDER, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, ...) plus score (0 to 1) and predicted (1 if score >= threshold).

    Labels (doc_id, toxic) of rows that ``held_out`` names are not read.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("toxic").alias("toxic")))
    known = checkpointed(known)
    if known.count() <= SMALL_LABELS:
        known = F.broadcast(known)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    labelled = texts.join(known, "_id")
    fits = F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4)) == 3
    # Not named, so that nothing holds the counts' shuffles once the model stands.
    model = train(count_grams(labelled.where(~fits).select((1 - F.col("toxic")).cast("int").alias("cls"), "text"), order, tokens), order, classes=2, shared=SHARED)
    scored = checkpointed(score(texts.select(text_id(F.col("text")).alias("id"), "text"), model, order, 2, tokens, features, FEATURES)
                          .dropDuplicates(["id"]))
    discard(model)
    sample = (labelled.where(fits).select(text_id(F.col("text")).alias("id"), "toxic", F.xxhash64("_id").alias("_h"))
              .orderBy("_h").limit(fit_rows).join(scored, "id").collect())  # at most fit_rows rows of a few numbers
    out = docs.drop("score", "predicted").withColumn("_text_id", text_id(F.col("text").cast("string")))
    out = out.join(scored.withColumnRenamed("id", "_text_id"), "_text_id", "left")
    if {r["toxic"] for r in sample} >= {0, 1}:
        w, mean, spread = _fit(sample)
        z = F.lit(float(w[0]))
        for f, a, m, s in zip(FEATURES, w[1:], mean, spread):
            z = z + F.lit(float(a)) * (F.col(f) - float(m)) / float(s)
        value = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    else:
        value = F.lit(0.0)
    return out.withColumn("score", value).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("_text_id", *FEATURES)
