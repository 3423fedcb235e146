"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams of a text that don't cross words, hashed, present or not.  For
each feature the log ratio of its shares among toxic and other labelled
texts is counted over all labelled rows; it scales the feature.  A logistic
regression on the scaled features is fitted on a bounded sample of the labelled
rows, with its intercept corrected for the sample's share of toxic rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.llm import chargrams
from lapline.llm.common import pieces, remainder, with_columns

SIZES, BITS = (3, 4, 5, 6), 18
#: Labelled rows of each class that the linear classifier is fitted on.
SAMPLE_PER_CLASS = 1000
#: Every feature keeps its ratio, however rare or near to 0; the smoothing alone damps rare ones.
MIN_TEXTS, MIN_RATIO = 0, 0.0
#: Features of the sample that one part of a gradient step reads.
_STEP_FEATURES = 1 << 20
_BATCH = 1 << 19
SMOOTHING, PENALTY, STEPS = 1.0, 0.3, 200
#: Largest label table that is broadcast; beyond it labels and texts meet by a shuffled join.
BROADCAST_LABELS = 2_000_000


class Model(NamedTuple):
    weights: np.ndarray  # log-count ratio times fitted weight, for each feature
    bias: float


def _features(texts: list[str | None], scratch: np.ndarray):
    """The distinct features of each text."""
    for f in chargrams.by_text(texts, SIZES, BITS, within_words=True):
        yield chargrams.distinct(f, scratch)


def _scratch() -> np.ndarray:
    return np.zeros(1 << BITS, np.int32)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of the documents with a label; a document labelled both ways is toxic, null labels don't count."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")) \
        .where("_id is not null and toxic is not null").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    if labels.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")) \
        .join(marks, "_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def log_count_ratios(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """The ratio of each feature over all (text, toxic) rows, and the number of rows of both classes."""

    def count(batches):
        scratch, n, texts = _scratch(), np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for whole in batches:
            for batch in pieces(whole, "text", _BATCH):
                toxic = np.asarray(batch.column(1))
                for f, c in zip(_features(batch.column(0).to_pylist(), scratch), toxic.tolist(), strict=True):
                    n[c, f] += 1
                    texts[c] += 1
        has = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, has]), pa.array(np.r_[texts[0], n[0, has]]), pa.array(np.r_[texts[1], n[1, has]])],
            names=["feature", "n0", "n1"])

    found = rows.select("text", "toxic").mapInArrow(count, "feature long, n0 long, n1 long") \
        .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    real = found["feature"] >= 0
    n = np.zeros((2, 1 << BITS))
    n[0, found["feature"][real]] = found["n0"][real]
    n[1, found["feature"][real]] = found["n1"][real]
    share = (n + SMOOTHING) / (n + SMOOTHING).sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    none, toxic = (int(found[c][~real].sum()) for c in ("n0", "n1"))
    return ratio, none, toxic


def distinct_texts(rows: DataFrame) -> tuple[int, int]:
    """The number of distinct texts (by their hashes) among the other and the toxic rows."""
    found = rows.select("toxic", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")).distinct().groupBy("toxic").count().collect()
    number = {r["toxic"]: r["count"] for r in found}
    return number.get(0, 0), number.get(1, 0)


def labelled_sample(rows: DataFrame, per_class: int, counts: tuple[int, int], ratio: np.ndarray) -> list:
    """At most about ``per_class`` distinct texts of either class, by a hash of the text, as (toxic, features whose ratio isn't 0).

    ``counts`` are the distinct texts of both classes.  Copies of a text are drawn or left together, and count once:
    however many they are, the sample stays small and the class's other texts are drawn as without them.
    """
    sent = rows.sparkSession.sparkContext.broadcast(ratio != 0)
    share = F.when(F.col("toxic") == 1, per_class / max(1, counts[1])).otherwise(per_class / max(1, counts[0]))
    drawn = rows.select("toxic", "text").where(
        F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 20)) < F.least(F.lit(1.0), share) * (1 << 20)) \
        .distinct()

    def read(batches):
        scratch, used = _scratch(), sent.value
        for whole in batches:
            for batch in pieces(whole, "text", _BATCH):
                found = [f[used[f]].tobytes() for f in _features(batch.column(1).to_pylist(), scratch)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["toxic", "features"])

    return drawn.mapInArrow(read, "toxic int, features binary").collect()


def _fit(features: list[np.ndarray], truth: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features, by full-batch gradient steps with momentum, added up over parts of the sample."""
    used = np.unique(np.concatenate(features)) if features else np.empty(0, np.int64)
    used = used[ratio[used] != 0]
    place = np.full(len(ratio), -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    rows = [place[f][place[f] >= 0] for f in features]
    lengths = np.array([len(r) for r in rows])
    scale = ratio[used]
    # parts of whole examples: temporary arrays are as long as a part, not as the sample
    part = np.cumsum(lengths) // _STEP_FEATURES
    bounds = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist(), len(rows)]
    parts = [(a, b, np.concatenate(rows[a:b]), np.repeat(np.arange(b - a, dtype=np.int32), lengths[a:b]))
             for a, b in zip(bounds, bounds[1:])]
    del rows
    w, b = np.zeros(len(used)), 0.0
    v, vb = np.zeros_like(w), 0.0
    # a bound on the curvature: the largest squared length of an example
    number = len(lengths)
    lengths2 = np.concatenate([np.bincount(o, weights=scale[f] ** 2, minlength=e - a) for a, e, f, o in parts])
    rate = 1.0 / (0.25 * (np.mean(lengths2) * 4 + 1) + PENALTY / max(1, number))
    for _ in range(STEPS):
        scaled, g, gb = scale * w, np.zeros(len(used)), 0.0
        for a, e, f, o in parts:
            z = np.bincount(o, weights=scaled[f], minlength=e - a) + b
            d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - truth[a:e]) / number
            g += np.bincount(f, weights=d[o], minlength=len(used))
            gb += d.sum()
        v, vb = 0.9 * v - rate * (g * scale + PENALTY / number * w), 0.9 * vb - rate * gb
        w, b = w + v, b + vb
    out = np.zeros(len(ratio))
    out[used] = w * scale
    return out, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on the labelled documents.  With rows of one class only, or none, the score is the smoothed share of toxic rows."""
    rows = labelled(docs, labels, id_col, text_col, label_col)
    ratio, none, toxic = log_count_ratios(rows)
    if not none or not toxic:
        return Model(np.zeros(1 << BITS), float(np.log((toxic + 1) / (none + 1))))
    drawn = sorted(labelled_sample(rows, per_class, distinct_texts(rows), ratio), key=lambda r: (r["toxic"], r["features"]))
    truth = np.array([r["toxic"] for r in drawn], float)
    if not 0 < truth.sum() < len(truth):
        return Model(ratio / 10, float(np.log(toxic / none)))
    w, b = _fit([np.frombuffer(r["features"], np.int32) for r in drawn], truth, ratio)
    drawn_odds = truth.sum() / (len(truth) - truth.sum())
    return Model(w, float(b + np.log(toxic / none) - np.log(drawn_odds)))


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) under ``names``; all rows and other columns stay.

    Null and empty texts have no features and score by the intercept.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        weights, bias = sent.value
        weights, scratch = weights.astype(np.float32), _scratch()

        def compute(batch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            z = np.array([weights[f].sum(dtype=np.float64) for f in _features(texts, scratch)]) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            return [score, (score >= 0.5).astype(np.int32)]

        return compute

    return with_columns(docs, make, [(names[0], T.DoubleType()), (names[1], T.IntegerType())], text_col, _BATCH)


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_remainder: int = 0, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted): learn outside the held-out fold and score every document."""
    held = remainder(id_col, modulus) == held_remainder
    model = train(docs.where(~held), labels, id_col, text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return predict(narrow, model).drop("text")
