import re

import numpy as np
import xxhash

from lapline.llm import simhash
from lapline.llm.graph import components, forest

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance=4):
    parent = {p: p for p in set(prints)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = np.array(sorted(parent), np.uint64)
    for p in order:
        for q in order[np.bitwise_count(order ^ p) <= distance]:
            parent[find(int(p))] = find(int(q))
    least = {}
    for i, p in zip(ids, prints):
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return [least.get(find(p)) for p in prints]


def check(rows, found):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    expected = sorted(zip([str(r["doc_id"]) for r in rows], [f"{p:016x}" for p in prints],
                          map(str, plain_components([r["doc_id"] for r in rows], prints))))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found) == expected


def test_against_brute_force(spark, documents, odd_documents, no_documents):
    check(documents.collect(), simhash.near_duplicates(documents).collect())
    check(odd_documents.collect(), simhash.near_duplicates(odd_documents).collect())
    assert simhash.near_duplicates(no_documents).count() == 0


def test_pairs_meet_at_an_anchor():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 1 << 63, 500, dtype=np.int64)
    y = x.copy()
    for _ in range(4):
        y ^= np.left_shift(np.int64(1), draw.integers(0, 63, 500))
    cell, owner, home = simhash._anchors(x)
    homes = {(int(c), int(o)) for c, o in zip(cell[home], owner[home])}
    cell, owner, _ = simhash._anchors(y)
    met = {int(o) for c, o in zip(cell, owner) if (int(c), int(o)) in homes}
    assert len(met) == 500
    assert len(cell) / 500 < 46


def test_hot_anchors_are_split(spark):
    """A ball of thousands of fingerprints and random ones, with cells of 50 members."""
    draw = np.random.default_rng(2)
    base = np.uint64(0x0123456789ABCDEF)
    ball = {int(base)}
    while len(ball) < 800:
        ball.add(int(base) ^ sum(1 << int(b) for b in draw.choice(64, 3, replace=False)))
    prints = [*ball, *map(int, draw.integers(0, 1 << 63, 500))]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.fingerprint_links(fps, 4, cell_size=50)
    pairs = links.collect()
    assert all((np.uint64(np.int64(r["a"]).view(np.uint64)) != np.uint64(np.int64(r["b"]).view(np.uint64))) for r in pairs)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    expected = plain_components(range(len(prints)), prints)
    groups = {}
    for p, e in zip(signed, expected):
        groups.setdefault(e, set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components(spark):
    draw = np.random.default_rng(3)
    a, b = draw.integers(0, 400, 300), draw.integers(0, 400, 300)
    a, b = np.r_[a, np.arange(500, 900), np.full(300, 2000)], np.r_[b, np.arange(501, 901), np.arange(2001, 2301)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        if x != y:
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
    expected = {x: find(x) for x in parent}
    edges = spark.createDataFrame([*zip(a.tolist(), b.tolist()), (None, 3), (7, 7)], "a long, b long").repartition(5)
    assert {r["node"]: r["root"] for r in components(edges).collect()} == expected
    assert components(edges.limit(0)).count() == 0
    nodes, roots = forest(a, b)
    assert {n: r for n, r in zip(nodes.tolist(), roots.tolist())} == {n: r for n, r in expected.items() if n != r}


def test_one_document_of_each_group_stays(spark, documents, odd_documents):
    found = simhash.near_duplicates(documents).collect()
    kept = simhash.keep_representatives(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in found})
    ids = [r["doc_id"] for r in simhash.keep_representatives(odd_documents).collect()]
    assert sorted(ids, key=str) == [1, 2, 5, 6, 7, None]  # 3, 4 and a row without id have no words, as 2


def test_rows_that_share_an_id_or_have_none(spark):
    """Only near-duplicates go, whatever the ids; copies of the one that stays go too."""
    a, b, c, d = ("one two three four five", "six seven eight nine ten", "red green blue black white", "up down left right on")
    rows = [(1, a), (1, b), (1, a), (2, b), (2, c), (None, c), (None, d), (None, d), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = simhash.keep_representatives(docs).collect()
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept), key=str) == sorted(
        [(1, a), (1, b), (2, c), (None, d), (None, "")], key=str)
    assert simhash.keep_representatives(docs.limit(0)).count() == 0
