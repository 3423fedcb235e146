import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lapline.llm import repair

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SHAPE = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired) of (role, fault) rows, by Dijkstra over whole role strings' states."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(made)
        if (i, last) in done:
            continue
        done.add((i, last))
        turn = {"": "u", "s": "u", "a": "u", "u": "a"}[last]
        name = {"u": "user", "a": "assistant"}[turn]
        heapq.heappush(heap, (cost + 2, audit + "I", i, turn, (*made, (name, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, made))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if role[:1] == turn or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*made, (role, text))))
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, turn, (*made, (name, text))))
    raise AssertionError


def plain(rows, damage=True):
    out, all_rows = [], defaultdict(list)
    for r in rows:
        conv, turn = r["conv_id"], r["turn"]
        text, role = (" " if r[c] is None else r[c] for c in ("text", "role"))
        own = all_rows[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own.extend([(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    for conv, own in all_rows.items():
        own.sort(key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        seen, faults = set(), []
        for *_, role, text in own:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          None if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit, made = cheapest([(role, text, f) for (*_, role, text), f in zip(own, faults)])
        assert SHAPE.fullmatch("".join(role[0] for role, _ in made))
        turns = [t for known, t, *_ in own if known]
        initials = [role[:1] for *_, role, _ in own]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in repair.FAULTS),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    return sorted(out, key=str)


def run(rows):
    return sorted(map(tuple, repair.repaired_digests(rows).collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, audit string, gaps int, copies string, digest string"


def odd(seed=1, n=400, convs=40):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(convs)]), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", None, "tool", "", "User"]),
             rng.choice(["Hello.", "cut", " \n", "", None, "a? ", "é!", "x" * 500 + ".", "\x1f"]), "a", 5, "c", "d") for _ in range(n)]


def test_against_dijkstra(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    for rows in (conversations, conversations.limit(0), spark.createDataFrame(odd(), SCHEMA)):
        assert run(rows) == plain(rows.collect())


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_conversations_over_partitions(spark, partitions):
    rng = random.Random(3)
    words = ["One.", "two", "Three!", "four?", ""]
    rows = [(7, i // 2 * (1 + i % 5), rng.choice(["user", "assistant", "user", "assistant", "system", "x"]),
             f"{rng.choice(words)} {i if rng.random() < .7 else ''}{rng.choice(words)}") for i in range(1500)]
    rows += [(c, t, "user" if t % 2 else "assistant", "Yes.") for c in (6, 8, None) for t in range(4)]
    rows += [(9, 1, "user", "the same row.")] * 700  # one row a third of all
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        table = spark.createDataFrame(rows, SCHEMA.split(", audit")[0])
        assert run(table) == plain(table.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edits_are_the_repaired_rows(spark):
    rows = spark.createDataFrame(odd(5, 200, 15), SCHEMA)
    found = repair.repair(rows)
    edits = found.edits().orderBy("pid", "place").collect()
    made, audit, cost = defaultdict(list), defaultdict(str), defaultdict(int)
    for e in edits:
        audit[e["conv_id"]] += e["edit"]
        cost[e["conv_id"]] += e["cost"]
        assert (e["role"] is None) == (e["edit"] == "D") and (e["old_role"] is None) == (e["edit"] == "I")
        if e["role"] is not None:
            made[e["conv_id"]].append(f"{e['role']}:{e['text']}")
    digests = {r["conv_id"]: r for r in found.digests().collect()}
    assert {c: (d["audit"], d["cost"], d["repaired_sha256"]) for c, d in digests.items()} == \
        {c: (audit[c], cost[c], hashlib.sha256("\n".join(made[c]).encode()).hexdigest()) for c in audit}
    expected = plain(rows.collect(), damage=False)
    assert sorted(((int(c) if c else None, d["cost"], d["audit"]) for c, d in digests.items()), key=str) == \
        sorted(((r[0], r[6], r[7]) for r in expected), key=str)


def test_blocks_and_prices(monkeypatch):
    rng = random.Random(2)
    for size in (2, 5, 64):
        monkeypatch.setattr(repair, "BLOCK", size)
        for _ in range(400):
            kinds = "".join(rng.choice("suaSUA-=!ua") for _ in range(rng.randint(0, 16)))
            rows = [({"s": "s", "u": "u", "a": "a"}.get(k.lower(), "x"), "t", "blank" if k == "!" else "truncated" if k.isupper() or k == "="
                     else None) for k in kinds]
            assert repair.least_audit(kinds) == cheapest(rows)[:2]
            at = rng.randint(0, len(kinds))
            joined = (repair.transfer(kinds[:at])[:, :, None] + repair.transfer(kinds[at:])[None, :, :]).min(axis=1)
            whole = repair.transfer(kinds)
            assert ((joined == whole) | (whole >= repair.NEVER) & (joined >= repair.NEVER)).all()


def test_prices_stay_feasible_duals():
    rng = random.Random(4)
    for _ in range(100):
        kinds = "".join(rng.choice("suaSUA-=!") for _ in range(rng.randint(1, 20)))
        auction = repair.Auction(kinds, repair.CLOSED)
        auction.distance(repair.START)
        assert all(auction.price[node] <= cost + auction.price[to] for node, own in enumerate(auction.out) for _, cost, to in own)


def test_damage(spark):
    rows = spark.range(400).select(F.lit(3).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("system").alias("role"),
                                   F.lit("a. b! c?").alias("text"))
    found = defaultdict(list)
    for r in repair.damaged(rows).collect():
        found[r["turn"]].append((r["role"], r["text"]))
    for turn in range(400):
        kind = zlib.crc32(f"3:{turn}".encode()) % 20
        assert found[turn] == {0: [], 1: [("system", "")], 2: [("system", "a b c")], 3: [("system", "a. b! c?")] * 2,
                               4: [("user", "a. b! c?")]}.get(kind, [("system", "a. b! c?")])
