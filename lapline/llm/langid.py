"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the character n-grams of a text, hashed; a feature's value is
its share of the text's n-grams times its inverse document frequency, which
is counted over all training texts.  The weights are fitted with
follow-the-regularised-leader (per-coordinate steps, elastic-net penalty) on a
bounded sample of the labelled texts, and a temperature is fitted on texts of the
sample that the weights haven't seen.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.llm import chargrams
from lapline.llm.common import cut, pieces, remainder, with_columns

UNDETERMINED = "und"
SIZES, BITS = (1, 2, 3), 16
#: Labelled texts of each language that the weights and the temperature are fitted on.
SAMPLE_PER_LANGUAGE = 600
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.3, 1.0, 0.02, 0.01
#: Largest table of languages and their texts' numbers that is broadcast.
BROADCAST_LANGUAGES = 100_000
_SCALE = 50.0
_BATCH = 1 << 19
_LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # (features, languages), times the inverse document frequencies
    bias: np.ndarray
    temperature: float


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of a one-column table each feature occurs (an array of fixed length), and the number of texts."""

    def count(batches):
        df, n, scratch = np.zeros(1 << BITS, np.int64), 0, np.zeros(1 << BITS, np.int32)
        for whole in batches:
            for batch in pieces(whole, "text", _BATCH):
                for features in chargrams.by_text(batch.column(0).to_pylist(), SIZES, BITS):
                    df[chargrams.distinct(features, scratch)] += 1
                n += batch.num_rows
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, has]), pa.array(np.r_[n, df[has]].astype(np.int64))], names=["feature", "n"])

    found = texts.toDF("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << BITS, np.int64)
    real = found["feature"] >= 0
    df[found["feature"][real]] = found["n"][real]
    return df, int(found["n"][~real].sum())


def labelled_sample(docs: DataFrame, text_col: str, lang_col: str, per_language: int) -> list:
    """At most about ``per_language`` distinct texts of every language, by a hash of the text, as (lang, part, features, counts).

    Copies of a text are drawn or left together, and count once, also in a language's share: however many they are,
    the sample stays small and the language's other texts are drawn as without them.
    """
    known = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("text is not null and lang is not null")
    sizes = cut(known.select("lang", F.xxhash64("text").alias("t")).distinct().groupBy("lang").count())
    if sizes.count() <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count"))
    hashed = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 20))
    drawn = known.withColumn("h", hashed).join(sizes, "lang").where(F.col("h") < share * (1 << 20)) \
        .dropDuplicates(["lang", "text"])

    def read(batches):
        for whole in batches:
            for batch in pieces(whole, "text", _BATCH):
                found = [np.unique(f, return_counts=True)
                         for f in chargrams.by_text(batch.column(1).to_pylist(), SIZES, BITS)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2),
                     pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()),
                     pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary())],
                    names=["lang", "part", "features", "counts"])

    part = F.pmod(F.xxhash64("h"), F.lit(5)).cast("int")
    return drawn.select("lang", "text", part.alias("part")).mapInArrow(
        read, "lang string, part int, features binary, counts binary").collect()


def _ftrl(examples, classes: int, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial follow-the-regularised-leader over (features, values, class); returns weights and bias."""
    z, n = np.zeros((1 << BITS, classes)), np.zeros((1 << BITS, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    draw = np.random.default_rng(7)
    for _ in range(epochs):
        for i in draw.permutation(len(examples)):
            f, x, c = examples[i]
            w, wb = weights(z[f], n[f]), -zb / ((BETA + np.sqrt(nb)) / ALPHA)
            p = _softmax(x @ w + wb)
            p[c] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA
            z[f] += g - step * w
            n[f] += g * g
            step = (np.sqrt(nb + p * p) - np.sqrt(nb)) / ALPHA
            zb += p - step * wb
            nb += p * p
    return weights(z, n), -zb / ((BETA + np.sqrt(nb)) / ALPHA)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE,
          epochs: int = EPOCHS) -> Model:
    """Fit on the labelled rows of ``docs``; rows with a null text or language teach nothing.  No rows: no languages."""
    rows = sorted(labelled_sample(docs, text_col, lang_col, per_language), key=lambda r: (r["lang"], r["features"], r["counts"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)
    df, number = document_frequencies(docs.where(F.col(lang_col).isNotNull()).select(text_col))
    idf = np.log((1 + number) / (1 + df)) + 1
    examples, held = [], []
    for r in rows:
        f, n = np.frombuffer(r["features"], np.int32), np.frombuffer(r["counts"], np.int32)
        if len(f):
            (held if r["part"] == 0 else examples).append((f, _SCALE * n / n.sum() * idf[f], languages.index(r["lang"])))
    w, b = _ftrl(examples, len(languages), epochs)
    temperature = 1.0
    if held:
        logits = np.array([x @ w[f] + b for f, x, _ in held])
        truth = np.array([c for *_, c in held])
        tried = np.exp(np.linspace(math.log(0.05), math.log(20), 121))
        loss = [-np.log(np.maximum(1e-12, _softmax(logits / t)[np.arange(len(truth)), truth])).mean() for t in tried]
        temperature = float(tried[int(np.argmin(loss))])
    return Model(languages, w * idf[:, None] * _SCALE, b, temperature)


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Append ``lang_pred`` and ``score`` (the calibrated probability) under ``names``; all rows and other columns stay.

    A null text or one without a letter is ``und`` with score 0, and so is
    every text if no language was learned.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        languages, w, b, temperature = sent.value
        tables = [np.ascontiguousarray(w[:, k], np.float32) for k in range(len(languages))]

        def compute(batch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            out, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if languages:
                total, number = chargrams.sums(texts, SIZES, BITS, tables)
                p = _softmax((total / np.maximum(1, number)[:, None] + b) / temperature)
                for i, x in enumerate(texts):
                    if x and _LETTER.search(x):
                        out[i], score[i] = languages[int(p[i].argmax())], p[i].max()
            return [out, score]

        return compute

    return with_columns(docs, make, [(names[0], T.StringType()), (names[1], T.DoubleType())], text_col, _BATCH)


def identify(docs: DataFrame, modulus: int = 4, held_remainder: int = 2, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn outside the held-out fold and predict every document."""
    held = remainder(id_col, modulus) == held_remainder
    model = train(docs.where(~held).select(text_col, lang_col), text_col, lang_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return predict(narrow, model).drop("text")
