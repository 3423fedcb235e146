"""The corpus pipeline: language, toxicity, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.llm import langid, mix, packing, simhash, toxicity
from lapline.llm.common import fresh, ship_package, stored

#: A text of a language that was learned is kept from this calibrated probability on.
LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled rows teach; texts that are null, without letters or undecided go.

    Repeated rows and null ids are judged each by its text; columns of any name pass as they are (in all stages); an empty table stays empty.
    """
    ship_package(spark)
    model = langid.train(docs)
    lang, score = (fresh(docs.columns, n) for n in ("lang_pred", "score"))
    read = langid.predict(docs, model, names=(lang, score))
    return read.where((F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)) \
        .select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that aren't predicted toxic; null and empty texts go by the share of toxic labels alone."""
    ship_package(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, predicted = (fresh(docs.columns, n) for n in ("score", "predicted"))
    return toxicity.predict(docs, model, names=(score, predicted)).where(F.col(predicted) == 0).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one with the smallest id, null ids last.

    Of repeated rows one stays; null and empty texts are one group.
    """
    ship_package(spark)
    return simhash.keep_representatives(docs).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each copy that it takes; documents without words aren't taken, null sources are one source."""
    ship_package(spark)
    return mix.mix_texts(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the mixed documents with their places in sequences; a null text is packed as its end alone."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("toxicity", clean),
    ("near-duplicates", distinct),
    ("mixture", mixture),
    ("packing", packed),
]

#: Fitted models and a tokenizer: SQL can't express the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
