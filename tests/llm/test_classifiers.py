import zlib

import numpy as np
from pyspark.sql import functions as F

from lapline.llm import chargrams, langid, toxicity
from tests.llm.conftest import SF_MID


def fold(doc_id, m):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % m


def features(text, sizes, bits, within_words=False):
    """One n-gram at a time."""
    codes = [32 if 9 <= ord(c) <= 13 else ord(c) for c in f" {(text or '').lower()} "]
    out = []
    for n in sizes:
        for i in range(len(codes) - n + 1):
            if within_words and 32 in codes[i + 1:i + n - 1]:
                continue
            h = codes[i] * 0x01000193 % 2**32
            for k in range(1, n):
                h = (h ^ (codes[i + k] * (2 * k + 3) % 2**32)) * 0x01000193 % 2**32
            out.append(((h ^ (h >> 15)) * 0x9E3779B1 % 2**32) >> (32 - bits))
    return np.array(out, np.int64)


def test_grams_of_many_texts_at_once():
    texts = ["Ab c", None, "", "x", "Größe  und\tMaß\n", "a b", "word"]
    for sizes, within in (((1, 2, 3), False), ((3, 4, 5, 6), True)):
        for text, got in zip(texts, chargrams.by_text(texts, sizes, 16, within)):
            assert got.tolist() == features(text, sizes, 16, within).tolist()


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = langid.identify(docs).collect()
    assert len(found) == len(truth)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    right = np.array([r["lang_pred"] == truth[r["doc_id"]] for r in held])
    assert right.mean() > 0.95
    assert abs(right.mean() - np.mean([r["score"] for r in held])) < 0.06  # calibrated


def test_document_frequencies_are_exact(spark, documents):
    texts = [r["text"] for r in documents.collect()]
    df, n = langid.document_frequencies(documents.select("text").repartition(3))
    plain = np.zeros_like(df)
    for t in texts:
        plain[np.unique(features(t, langid.SIZES, langid.BITS))] += 1
    assert n == len(texts) and (df == plain).all()


def test_score_is_the_linear_model_of_whole_text(spark, documents):
    model = langid.train(documents)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(documents, model).collect()}
    for r in documents.collect():
        f = features(r["text"], langid.SIZES, langid.BITS)
        p = langid._softmax((model.weights[f].sum(axis=0) / len(f) + model.bias) / model.temperature)
        lang, score = found[r["doc_id"]]
        assert lang == model.languages[int(p.argmax())] and abs(score - p.max()) < 1e-4


def test_weights_are_sparse(spark, documents):
    model = langid.train(documents)
    assert (model.weights == 0).all(axis=1).mean() > 0.5


def test_language_of_odd_texts(spark, odd_documents, no_documents):
    found = langid.identify(odd_documents).collect()
    assert len(found) == 10
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in found if r["doc_id"] in (2, 3, 4, 7))
    assert all(r["lang_pred"] in ("en", "de", "und") for r in found)
    assert langid.identify(no_documents).count() == 0
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}
    kept = langid.predict(odd_documents, langid.train(odd_documents))
    assert set(kept.columns) == set(odd_documents.columns) and kept.count() == 10


def test_toxicity_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    found = toxicity.score_documents(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) and r["predicted"] == (r["score"] >= 0.5) for r in found)
    held = [(r["score"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    toxic, other = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in toxic for b in other]) > 0.7  # 49 toxic rows in all


def test_ratios_are_exact(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = toxicity.labelled(documents, labels)
    ratio, none, toxic = toxicity.log_count_ratios(rows.repartition(3))
    n, texts = np.zeros((2, 1 << toxicity.BITS)), [0, 0]
    for r in rows.collect():
        n[r["toxic"], np.unique(features(r["text"], toxicity.SIZES, toxicity.BITS, True))] += 1
        texts[r["toxic"]] += 1
    share = (n + 1) / (n + 1).sum(axis=1, keepdims=True)
    assert [none, toxic] == texts
    plain = np.log(share[1] / share[0])
    used = (n.sum(axis=0) >= toxicity.MIN_TEXTS) & (np.abs(plain) >= toxicity.MIN_RATIO)
    assert np.allclose(ratio, np.where(used, plain, 0))


def test_toxicity_of_odd_tables(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (5, 1, 0), (6, 0, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.score_documents(odd_documents, labels).collect()
    assert len(found) == 10 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score_documents(no_documents, labels).count() == 0
    none = toxicity.score_documents(odd_documents, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    plain = toxicity.labelled(odd_documents, labels).collect()
    try:
        keep, toxicity.BROADCAST_LABELS = toxicity.BROADCAST_LABELS, 0
        assert sorted(map(str, toxicity.labelled(odd_documents, labels).collect())) == sorted(map(str, plain))
    finally:
        toxicity.BROADCAST_LABELS = keep


def test_samples_stay_small_however_many_copies(spark):
    """A third of the rows are copies of a text that is drawn: it counts once in the sample, and in all rows' statistics."""
    rows = [(f"text number {i} of many", "en" if i % 2 else "de", int(i % 3 == 0)) for i in range(2000)]
    plain = spark.createDataFrame(rows, "text string, lang string, toxic int")
    drawn = langid.labelled_sample(plain, "text", "lang", 50)
    assert 0 < len(drawn) < 200
    low = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 20))
    first = plain.orderBy(low).first()["text"]
    copied = plain.unionByName(plain.where(F.col("text") == first).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(1000)))).drop("copy"))
    assert len(langid.labelled_sample(copied, "text", "lang", 50)) < 200
    ratio = np.ones(1 << toxicity.BITS)
    assert 0 < len(toxicity.labelled_sample(copied, 50, (1333, 667), ratio)) < 300


def test_rare_decisive_words_keep_their_ratio(spark):
    """Nine toxic texts and no other have the marker: its n-grams decide, whatever the size of the table."""
    rows = [(f"plain words {i % 7} of a text" + (" clown" if i < 9 else ""), int(i < 9)) for i in range(300)]
    ratio, none, toxic = toxicity.log_count_ratios(spark.createDataFrame(rows, "text string, toxic int"))
    assert (none, toxic) == (291, 9)
    marker = np.unique(features("clown", toxicity.SIZES, toxicity.BITS, True))
    assert (ratio[marker] > 2).all()


def test_toxicity_ranks_held_out_texts_well(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r["score"], truth[r["doc_id"]]) for r in toxicity.score_documents(docs, labels).collect()
            if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([a > b for a, t in held if t for b, u in held if not u]) > 0.9


def test_copies_take_no_place_in_the_samples(spark, monkeypatch):
    """99 of 100 rows of one language and class are copies: all its distinct texts are drawn, or about the number asked for."""
    rows = [(i, f"text number {i} of many", "en", 0) for i in range(400)]
    rows += [(1000 + i, f"texte {i} sur bien d'autres" if i < 40 else "copie", "fr", 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    drawn = [r["lang"] for r in langid.labelled_sample(docs, "text", "lang", 50)]
    assert drawn.count("fr") == 41 and 20 < drawn.count("en") < 100
    truths, fit = [], toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda f, truth, ratio: truths.append(truth) or fit(f, truth, ratio))
    toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"), per_class=50)
    assert truths[0].sum() == 41 and 20 < len(truths[0]) - 41 < 100
