from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lapline.llm import langid, simhash, toxicity
from lapline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near-duplicates", "mixture", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_filters_take_effect_and_keep_the_rest(stages, spark):
    docs, language, clean, distinct, mixture, packed = stages
    found = langid.predict(docs, langid.train(docs))
    assert ids(language) == ids(found.where(f"lang_pred != 'und' and score >= {corpus_pipeline.LEAST_LANGUAGE_SCORE}"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert ids(clean) == ids(toxicity.predict(language, toxicity.train(language, labels)).where("predicted = 0"))
    groups = simhash.near_duplicates(clean).collect()
    assert ids(distinct) == sorted({r["component_id"] for r in groups})
    assert set(ids(mixture)) <= set(ids(distinct)) and mixture.count() > 0
    rows = mixture.count()
    assert packed.where("piece = 0").count() == rows


def test_queries_are_registered():
    assert set(ORACLES) <= set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None


CLASHING = ("score", "lang_pred", "predicted", "_lang_text", "_mix_row", "_simhash_print", "row", "print", "least_id", "first_print",
            "text_key", "sequence_id", "size")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables_and_clashing_names(spark, odd_documents, no_documents, documents, name, stage):
    sf = "/root/testdata/sf0.001"
    plain = [c for c in documents.columns]
    odd = odd_documents.select(*plain).unionByName(documents)
    clashing = odd
    for c in CLASHING:
        clashing = clashing.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    kept = stage(spark, clashing, sf).collect()
    assert len(stage(spark, no_documents, sf).collect()) == 0
    if name == "packing":
        pieces = Counter(r["doc_id"] for r in kept if r["piece"] == 0)
        assert pieces == Counter(r["doc_id"] for r in odd.collect())
        return
    # the caller's values come through, and the same rows stay as without them
    assert kept[0].asDict().keys() == set(clashing.columns)
    for r in kept:
        assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)
    # a group whose smallest id is null or repeated may keep either copy: texts tell
    assert sorted((r["text"] or "") for r in kept) == sorted((r["text"] or "") for r in stage(spark, odd, sf).collect())
    assert {tuple(r[c] for c in plain) for r in kept} <= {tuple(r) for r in odd.collect()}
