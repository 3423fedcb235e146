import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lapline.llm import line_rules
from lapline.llm.common import fresh, skewed_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(line):
    return re.sub("[0-9]+", "0", " ".join(WORD.findall(line.translate(LOWER))))


def repeats(words):
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    return len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)})


def plain(rows, limit=line_rules.MAX_DOCUMENTS):
    seen = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if WORD.search(line):
                seen[r["source"], normal(line)].add(r["text"] or "")
    out = []
    for r in rows:
        text = r["text"] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        lost = sum(len(WORD.findall(x)) for x in lines if len(seen[r["source"], normal(x)]) > limit)
        n, again = len(words), repeats(words)
        failed = n < 20 or 100 * again > 30 * n
        out.append((r["doc_id"], n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
                    again, failed, not failed and 2 * (n - lost) >= n, lost))
    return sorted(out, key=str)


def run(docs, **more):
    return sorted((tuple(r) for r in line_rules.assess(docs, **more).collect()), key=str)


def test_against_a_plain_loop(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents, no_documents):
        assert run(docs) == plain(docs.collect())


def test_limits_hosts_and_copies(spark):
    body = " ".join(f"w{i}" for i in range(25))
    rows = [(i, f"{body} {'v' * (i + 1)}\nRead More  at {i}", "a") for i in range(12)]  # one boilerplate line, numbers apart
    rows += [(100 + i, f"read more at 7\n{body}", "b") for i in range(30)]  # copies are one document
    rows += [(200 + i, f"{body} of {'z' * i}\nshort {'y' * (i + 1)}", None) for i in range(12)]  # no host
    rows += [(300 + i, "same line here " * 8 + f"\nown {'q' * (i + 1)}", "c") for i in range(11)]
    rows += [(400, "A B C #|<\nA B C #|<\nd", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in line_rules.assess(docs).collect()}
    assert run(docs) == plain(docs.collect())
    assert all(found[i]["removed_words"] == 4 and found[i]["kept"] for i in range(12))
    assert all(found[i]["removed_words"] == 0 for i in range(100, 130))
    assert all(found[300 + i]["base_failed"] for i in range(11))
    assert (found[400]["n_symbols"], found[400]["n_dup_lines"]) == (6, 1)
    assert run(docs, max_documents=12) == plain(docs.collect(), 12)


def test_depleted_documents_go(spark):
    shared = " ".join(f"s{chr(97 + i)}" for i in range(26))
    rows = [(i, shared + "\n" + " ".join(f"{chr(97 + i)}{chr(97 + j)}x" for j in range(26 - (i % 2))), "h") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r["doc_id"]: r["kept"] for r in line_rules.assess(docs).collect()} == {i: i % 2 == 0 for i in range(12)}


def test_repeated_words_over_random_texts():
    rng = np.random.default_rng(5)
    documents = [[bytes([97 + int(x)]) for x in rng.integers(0, 2, int(n))] for n in rng.integers(0, 40, 60)]
    assert line_rules.repeated_words(documents).tolist() == [repeats(d) for d in documents]
    assert line_rules.repeated_words([]).tolist() == [] and line_rules.repeated_words([[], [b"a"]]).tolist() == [0, 0]


def test_cleaned_texts_and_clashing_names(spark):
    rows = [(i, f"Own {'x' * (i + 1)}\n\nCookie notice 20{i}.\nend {'y' * (i + 1)}", "h", "mine", 7) for i in range(12)]
    rows += [(50, None, "h", "kept", 8), (51, "Cookie notice 1.", None, "kept", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, text_key string, clean int")
    found = {r["doc_id"]: r for r in line_rules.without_frequent_lines(docs).collect()}
    assert found[3]["clean_text"] == "Own xxxx\n\nend yyyy"
    assert (found[50]["clean_text"], found[51]["clean_text"]) == (None, "Cookie notice 1.")
    assert {r["text_key"] for r in found.values()} == {"mine", "kept"} and found[50]["clean"] == 8


def test_skewed_join_equals_a_plain_join(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id") \
        .unionByName(spark.createDataFrame([(None, -1)], "k long, id long"))
    right = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")) \
        .unionByName(spark.createDataFrame([(7, 70)], "k long, v long"))
    for how in ("left", "inner"):
        assert sorted(map(tuple, skewed_join(left, right, "k", how).collect()), key=str) == \
            sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
    assert fresh(["a", "_A"], "a") == "__a" and fresh(["b"], "a") == "a"
