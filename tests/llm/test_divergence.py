import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lapline.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, top=10):
    groups, counts, seen = set(), defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        groups.add((lang, source))
        terms = TERM.findall((r["text"] or "").translate(LOWER))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = sorted(s for x, s in groups if x == lang)

        def shares(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10 ** 9 * (of[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in own}
        q = shares(sum((counts[lang, s] for s in own), Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in own:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pair)]
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(term[:top])]
    return sorted(out)


def run(docs, **more):
    return sorted(map(tuple, divergence.audit(docs, **more).collect()))


def test_against_a_plain_loop(documents, odd_documents, no_documents):
    for docs, least in ((documents, 10), (odd_documents, 10), (odd_documents, 1), (no_documents, 10)):
        assert run(docs, min_documents=least) == plain(docs.collect(), least)


def test_many_tiles_give_the_same(spark, documents):
    assert run(documents, rows=3, columns=16) == plain(documents.collect())


def test_skewed_groups_ties_and_odd_letters(spark):
    rows = [("x\x00y A-b ÉCOLE école \x7fz_w 漢字 a", "l", "hot")] * 400
    rows += [(f"{chr(97 + i)} b b", "l", f"s{i}") for i in range(26)] + [(None, "l", "none"), ("...", "l", None), ("q", None, None)]
    rows += [("", "empty", "one"), ("", "empty", "two"), ("solo", "single", "s")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    assert run(docs) == plain(docs.collect())
    assert [r for r in run(docs) if r[0] == "empty"] == [
        ("empty", "one", "pair", "two", 0, 1), ("empty", "two", "pair", "one", 0, 1)]
    found = {r[3] for r in run(docs) if r[2] == "term" and r[1] == "hot"}
    assert {"École".lower(), "École", "école", "漢字"} & found and "école" in found


@pytest.mark.parametrize("fill", [0.0, 0.02, 0.3, 1.0])
def test_joint_sums_against_all_cells(fill):
    rng = np.random.default_rng(int(fill * 100))
    for rows_a, rows_b, columns in ((1, 1, 1), (5, 3, 70), (33, 4, 9), (2, 2, 0)):
        a, b = ((rng.random((r, columns)) < fill) * rng.integers(1, 50, (r, columns)) for r in (rows_a, rows_b))
        p, q = (divergence.share(x, x.sum(1, keepdims=True), columns) for x in (a, b))
        p0, q0 = (divergence.share(np.zeros(len(x), np.int64), x.sum(1), columns) for x in (a, b))
        expected = divergence.price(p[:, None, :], q[None, :, :]).sum(2)
        assert (divergence.joint_sums(a, b, p, q, p0, q0, False) == expected).all()
        same = divergence.price(p[:, None, :], p[None, :, :]).sum(2)
        assert (divergence.joint_sums(a, a, p, p, p0, p0, True) == np.triu(same, 1)).all()
        beyond = expected + 7 * divergence.price(p0[:, None], q0[None, :])
        assert (divergence.joint_sums(a, b, p, q, p0, q0, False, 7) == beyond).all()


def test_shares_are_exact_for_huge_counts():
    rng = np.random.default_rng(3)
    for total, n_terms in ((0, 1), (10, 3), (10 ** 13, 10 ** 6), (8 * 10 ** 15, 10 ** 7)):
        counts = np.r_[0, total, rng.integers(0, total + 1, 50)]
        exact = [1 + 10 ** 9 * (int(c) + 2) // (total + 2 * n_terms) for c in counts]
        assert divergence.share(counts, total, n_terms).tolist() == exact


def test_empty_quadrants_are_not_entered():
    counts = np.zeros((32, 1024), np.int64)
    counts[3, 7] = 1
    levels = divergence.tree(counts)
    assert [int(x.sum()) for x in levels] == [1] * 11 and levels[-1].shape == (1, 1)
