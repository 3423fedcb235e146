"""Conversation structure repair by an auction over the lattice of edits.

Nodes of the lattice are (rows consumed, state), where the state says what a
well-formed conversation ``(s?(ua)+)?`` has had last: nothing, system, user or
assistant.  Arcs are the edits of a row (keep, rerole, delete) and insertions, with
whole-number costs.  The auction keeps a price for each node and one path
from the origin: the path's last node is extended along its best arc while its
price allows, or else raises its price to that best offer and is contracted.  Prices stay
feasible duals throughout, so when the path reaches the end, price differences are
distances; arcs that are tight under the prices are exactly those of cheapest
repairs, and the least audit string is traced along them.

A conversation may have any number of rows.  Rows are range-sorted by
(conversation, turn), so it may span partitions, and within a partition it is
cut into blocks of ``BLOCK`` rows.  A block's prices towards its end need only the
prices at its end (one for each state).  For the first and last
conversation of a partition a min-plus matrix (states x states) and the states
that the tracing leads to are chained on the driver: two small rows for each
partition, whatever the number of rows.

Equal rows of a turn are carried as one row with a count.  A row is blank, then
duplicate, then truncated; earlier equal rows are found by a grouped minimum, not
by bringing a conversation together.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm.common import cut, skewed_join

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
NEVER = 1 << 40
#: Rows of a block of the lattice.
BLOCK = 64
#: Where a row of this role leads from each state; a state that isn't listed forbids it.
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_TURN = {START: ("u", USER), SYSTEM: ("u", USER), ASSISTANT: ("u", USER), USER: ("a", ASSISTANT)}
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def arcs(kind: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row of a kind from a state, by the edit's letter."""
    out = [("D", DELETE, state)]
    if kind != "!":
        more = CUT_OFF if kind.isupper() or kind == "=" else 0
        kept = _AFTER.get(kind.lower(), {}).get(state)
        if kept is not None:
            out.append(("K", KEEP + more, kept))
        out.append(("R", REROLE + more, _TURN[state][1]))
    return out


class Auction:
    """Prices of one block's lattice under given end prices, and the tight arcs."""

    def __init__(self, kinds: str, ends: tuple[int, ...]):
        n = len(kinds)
        self.kinds, self.n = kinds, n
        self.sink = (n + 1) * STATES
        base = min(ends)
        self.base = base
        self.out: list[list[tuple[str, int, int]]] = []
        for i in range(n + 1):
            for state in range(STATES):
                own = [("I", INSERT, i * STATES + _TURN[state][1])]
                if i < n:
                    own += [(e, c, (i + 1) * STATES + to) for e, c, to in arcs(kinds[i], state)]
                elif ends[state] < NEVER:
                    own.append(("", ends[state] - base, self.sink))
                self.out.append(sorted(own))
        # only nodes that lead to the end take part: the others' prices would rise without bound
        into: list[list[int]] = [[] for _ in range(self.sink + 1)]
        for node, own in enumerate(self.out):
            for _, _, to in own:
                into[to].append(node)
        reach, todo = {self.sink}, [self.sink]
        while todo:
            for node in into[todo.pop()]:
                if node not in reach:
                    reach.add(node)
                    todo.append(node)
        self.out = [[x for x in own if x[2] in reach] for own in self.out]
        self.price = [0] * (self.sink + 1)

    def distance(self, state: int) -> int:
        """Cost of the cheapest way from a state before the block, end prices included; NEVER if there is none."""
        if not self.out[state]:
            return NEVER
        price, out, path = self.price, self.out, [state]
        while path[-1] != self.sink:
            node = path[-1]
            offer, to = min((cost + price[to], to) for _, cost, to in out[node])
            if price[node] < offer:  # contract
                price[node] = offer
                if len(path) > 1:
                    path.pop()
            else:  # extend
                path.append(to)
        return price[state] - price[self.sink] + self.base

    def trace(self, state: int) -> tuple[str, int]:
        """The least edits along tight arcs from a state, and the state that they end in."""
        self.distance(state)
        price = self.price
        tight = [[x for x in own if price[node] == x[1] + price[x[2]]] for node, own in enumerate(self.out)]
        alive = {self.sink}
        for i in range(self.n, -1, -1):  # tight arcs never form a cycle: two insertions cost
            again = True
            while again:
                again = False
                for node in range(i * STATES, (i + 1) * STATES):
                    if node not in alive and any(to in alive for _, _, to in tight[node]):
                        alive.add(node)
                        again = True
        node, edits = state, []
        while True:
            # an arc to the end adds no letter, so it comes before any insertion
            edit, _, to = next(x for x in tight[node] if x[2] in alive)
            if to == self.sink:
                return "".join(edits), node % STATES
            edits.append(edit)
            node = to


#: Costs after the last row: a conversation is empty or ends with the assistant.
CLOSED = (0, NEVER, NEVER, 0)


@lru_cache(4096)
def _prices(kinds: str, ends: tuple[int, ...]) -> tuple[int, ...]:
    auction = Auction(kinds, ends)
    return tuple(auction.distance(s) for s in range(STATES))


@lru_cache(4096)
def _trace(kinds: str, ends: tuple[int, ...], state: int) -> tuple[str, int]:
    return Auction(kinds, ends).trace(state)


def _relative(ends) -> tuple[int, tuple[int, ...]]:
    base = min(ends)
    return base, tuple(x - base if x < NEVER else NEVER for x in ends)


def blocks(kinds: str) -> list[str]:
    return [kinds[i:i + BLOCK] for i in range(0, len(kinds), BLOCK)]


def after_blocks(kinds: str, ends: tuple[int, ...] = CLOSED) -> list[tuple[int, ...]]:
    """Prices at the end of every block of a run of rows: the cost to the conversation's end from each state."""
    prices = [tuple(ends)]
    for block in reversed(blocks(kinds)[1:]):
        prices.append(_before(block, prices[-1]))
    return prices[::-1]


def _before(block: str, ends: tuple[int, ...]) -> tuple[int, ...]:
    base, relative = _relative(ends)
    return tuple(x + base if x < NEVER else NEVER for x in _prices(block, relative))


def before(kinds: str, ends: tuple[int, ...] = CLOSED) -> tuple[int, ...]:
    """Prices before a run of rows."""
    return _before(kinds[:BLOCK], after_blocks(kinds, ends)[0]) if kinds else tuple(ends)


def follow(kinds: str, state: int = START, ends: tuple[int, ...] = CLOSED) -> tuple[str, int]:
    """The least of the cheapest edits of a run of rows from a state, and the state that they end in."""
    edits = []
    for block, after in zip(blocks(kinds), after_blocks(kinds, ends), strict=False):
        own, state = _trace(block, _relative(after)[1], state)
        edits.append(own)
    return "".join(edits), state


def least_audit(kinds: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return before(kinds)[START], follow(kinds)[0]


def transfer(kinds: str) -> np.ndarray:
    """Cheapest cost from every state before a run of rows to every state after it."""
    out = np.full((STATES, STATES), NEVER, np.int64)
    for state in range(STATES):
        out[:, state] = before(kinds, tuple(0 if s == state else NEVER for s in range(STATES)))
    return out


FAULTS = ("blank", "duplicate", "truncated")
_NAMES = {"u": "user", "a": "assistant"}


def fault_of(text: str, duplicate: bool) -> str | None:
    bare = text.rstrip(_SPACE)
    return "blank" if not bare else "duplicate" if duplicate else None if bare[-1] in ".!?" else "truncated"


def kind_of(role: str, fault: str | None) -> str:
    """A row as the lattice sees it: its role's initial ('-' if that is none of s, u, a), as a capital ('=')
    where the text is cut off, and '!' where it must be deleted."""
    if fault in ("blank", "duplicate"):
        return "!"
    first = role[:1] if role[:1] in ("s", "u", "a") else "-"
    return (first.upper() if first != "-" else "=") if fault else first


def _expanded(rows: list[tuple]) -> list[tuple]:
    """(turn, role, text, fault) for every row of a run of counted rows; later copies are duplicates."""
    out = []
    for turn, role, text, copies, duplicate in rows:
        out.append((turn, role, text, fault_of(text, duplicate)))
        if copies > 1:
            out.extend([(turn, role, text, fault_of(text, True))] * (copies - 1))
    return out


def _kinds(rows: list[tuple]) -> str:
    return "".join(kind_of(role, fault) for _, role, _, fault in rows)


def _edited(rows: list[tuple], edits: str, state: int):
    """(edit, cost, role, text, row or None) for every edit of a run, ``role`` and ``text`` as repaired (None: deleted)."""
    at = 0
    for edit in edits:
        if edit == "I":
            initial, state = _TURN[state]
            yield "I", INSERT, _NAMES[initial], "", None
            continue
        row = rows[at]
        at += 1
        _, role, text, fault = row
        more = CUT_OFF if fault == "truncated" else 0
        if edit == "D":
            yield "D", DELETE, None, None, row
        elif edit == "K":
            state = _AFTER[role[0]][state]
            yield "K", KEEP + more, role, text, row
        else:
            initial, state = _TURN[state]
            yield "R", REROLE + more, _NAMES[initial], text, row


# -- on Spark ----------------------------------------------------------------

_ORDER = ("conv", "has_turn", "turn", "role", "text")


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _runs(batches):
    """(conversation, its rows) for each run of a conversation's rows in a partition."""
    at, held = None, []
    for batch in batches:
        for conv, turn, role, text, copies, duplicate in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and conv != at:
                yield at, _expanded(held)
                held = []
            at = conv
            held.append((turn, role, text, copies, duplicate))
    if held:
        yield at, _expanded(held)


def _ends(batches):
    """(number, conversation, rows) of the first and the last run of a partition."""
    first = last = None
    for k, (conv, rows) in enumerate(_runs(batches)):
        last = k, conv, rows
        first = first or last
    return [x for x in (first, last) if x and (x is first or x[0])]


def _records(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=names)


def ordered_rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, copies, duplicate), range-sorted by conversation and turn (nulls first), then role and text.

    Rows equal in all of these are one with ``copies``; ``duplicate``: its
    role and text occur at an earlier turn.  Only roles with texts that occur
    more than once in a conversation are grouped; the others need no exchange but the sort.
    """
    conv, blank = F.col(id_col).cast("string"), F.lit(" ")
    narrow = rows.select(conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                         F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
                         F.coalesce(F.col(text_col).cast("string"), blank).alias("text"))
    named = F.coalesce(F.concat(F.lit("="), "conv"), F.lit(""))
    base = cut(narrow.withColumn("has_turn", F.col("turn").isNotNull()).withColumn("digest", F.md5(F.concat(
        named, F.lit("\n"), F.length(named), F.lit(" "), F.length("role"), F.lit("\n"), "role", "text").cast("binary"))))
    again = base.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("has_turn", "turn")).alias("earliest")) \
        .where("n > 1").drop("n")
    marked = skewed_join(base, again, "digest")
    one = marked.where("earliest is null").select(*_ORDER, F.lit(1).cast("long").alias("copies"), F.lit(False).alias("duplicate"))
    more = marked.where("earliest is not null").groupBy(*_ORDER).agg(
        F.count("*").alias("copies"), F.min("earliest").alias("earliest")) \
        .select(*_ORDER, "copies", (F.struct("has_turn", "turn") > F.col("earliest")).alias("duplicate"))
    # ranges go by a bounded prefix of the text, which orders as the text does: their bounds stay small
    return cut(one.unionByName(more).repartitionByRange("conv", "has_turn", "turn", "role", F.substring("text", 1, 256))
               .sortWithinPartitions(*_ORDER).drop("has_turn"))


def border_states(ordered: DataFrame) -> dict[tuple[int, int], tuple[tuple[int, ...], int]]:
    """(partition, run) -> (end prices, state before) for runs of conversations that span partitions.

    Two small rows for each partition reach the driver, twice: min-plus
    matrices, then where the tracing leads from each state.
    """
    def sums(batches):
        found = [(_partition(), k, conv, transfer(_kinds(rows)).tobytes()) for k, conv, rows in _ends(batches)]
        yield _records(found, [pa.int32(), pa.int32(), pa.string(), pa.binary()], ["pid", "k", "conv", "m"])

    pieces = sorted(ordered.mapInArrow(sums, "pid int, k int, conv string, m binary").collect(), key=lambda r: (r.pid, r.k))
    spans: list[list] = []
    for r in pieces:
        if spans and spans[-1][-1].conv == r.conv and spans[-1][-1].pid < r.pid:
            spans[-1].append(r)
        else:
            spans.append([r])
    spans = [x for x in spans if len(x) > 1]
    if not spans:
        return {}
    ends: dict[tuple[int, int], tuple[int, ...]] = {}
    for span in spans:
        at = np.array(CLOSED, np.int64)
        for r in reversed(span):
            ends[r.pid, r.k] = tuple(int(x) for x in at)
            at = np.minimum((np.frombuffer(r.m, np.int64).reshape(STATES, STATES) + at).min(axis=1), NEVER)
    sent = ordered.sparkSession.sparkContext.broadcast(ends)

    def leads(batches):
        pid, found = _partition(), []
        for k, _, rows in _ends(batches):
            if (pid, k) in sent.value:
                own, kinds = sent.value[pid, k], _kinds(rows)
                open_ = before(kinds, own)
                found.append((pid, k, [follow(kinds, s, own)[1] if open_[s] < NEVER else s for s in range(STATES)]))
        yield _records(found, [pa.int32(), pa.int32(), pa.list_(pa.int32())], ["pid", "k", "to"])

    to = {(r.pid, r.k): r.to for r in ordered.mapInArrow(leads, "pid int, k int, to array<int>").collect()}
    sent.destroy()
    known = {}
    for span in spans:
        state = START
        for r in span:
            known[r.pid, r.k] = ends[r.pid, r.k], state
            state = to[r.pid, r.k][state]
    return known


class Repair:
    """The repaired conversations of a table of rows (see ``repair``)."""

    def __init__(self, ordered: DataFrame):
        self.ordered = ordered
        # an entry for each conversation that spans partitions: two for each partition at most
        self.known = ordered.sparkSession.sparkContext.broadcast(border_states(ordered))

    def edits(self) -> DataFrame:
        """(conv_id, pid, place, edit, cost, fault, turn, old_role, role, text): every edit, in order of pid and place.

        ``role`` and ``text`` are the repaired row's, null where it is deleted; ``turn`` and ``old_role`` are null for insertions.
        """
        names = ["conv_id", "pid", "place", "edit", "cost", "fault", "turn", "old_role", "role", "text"]
        types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 3]
        known = self.known

        def run(batches):
            pid, place, out = _partition(), 0, []
            for k, (conv, rows) in enumerate(_runs(batches)):
                ends, state = known.value.get((pid, k), (CLOSED, START))
                for edit, cost, role, text, row in _edited(rows, follow(_kinds(rows), state, ends)[0], state):
                    turn, old, _, fault = row or (None,) * 4
                    out.append((conv, pid, place, edit, cost, fault, turn, old, role, text))
                    place += 1
                if len(out) >= 2000:
                    yield _records(out, types, names)
                    out = []
            yield _records(out, types, names)

        return self.ordered.mapInArrow(run, "conv_id string, pid int, place long, edit string, cost long, fault string, "
                                            "turn long, old_role string, role string, text string")

    def digests(self) -> DataFrame:
        """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

        Conversations inside a partition are summed up there.  Those that
        span partitions pass, as bodies of about a megabyte (one row at least), through one task in
        order, since a SHA-256 is a chain; it keeps a hash state and the audit, never the texts.
        """
        known = self.known

        def run(batches):
            pid, out = _partition(), []
            for k, (conv, rows) in enumerate(_runs(batches)):
                span = (pid, k) in known.value
                ends, state = known.value.get((pid, k), (CLOSED, START))
                audit = follow(_kinds(rows), state, ends)[0]
                turns = [r[0] for r in rows if r[0] is not None]
                faults = [sum(r[3] == f for r in rows) for f in FAULTS]
                initials = [r[1][:1] for r in rows]
                illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
                made = list(_edited(rows, audit, state))
                numbers = [conv, pid, span, min(turns, default=None), max(turns, default=None), len(set(turns)), *faults, illegal,
                           initials[0], initials[-1], sum(x[1] for x in made), audit]
                lines = [f"{role}:{text}".encode("utf-8", "surrogatepass") for _, _, role, text, _ in made if role is not None]
                if not span:
                    out.append((*numbers, 0, hashlib.sha256(b"\n".join(lines)).hexdigest(), None))
                else:
                    bodies: list[list[bytes]] = [[]]
                    size = 0
                    for line in lines:
                        if size > 1 << 20:
                            bodies.append([])
                            size = 0
                        bodies[-1].append(line)
                        size += len(line)
                    for part, body in enumerate(bodies):
                        row = [conv, pid, span, None, None, 0, 0, 0, 0, 0, None, None, 0, ""] if part else numbers
                        yield _records([(*row, part, None, b"\n".join(body) if body else None)], types, names)
                if len(out) >= 1000:
                    yield _records(out, types, names)
                    out = []
            yield _records(out, types, names)

        names = [x.split()[0] for x in _PIECE.split(", ")]
        types = [pa.string(), pa.int32(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.string(),
                 pa.int64(), pa.string(), pa.binary()]
        found = self.ordered.mapInArrow(run, _PIECE)
        digest = [x.split()[0] for x in _DIGEST.split(", ")]
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps")
        if not self.known.value:
            return found.withColumn("gaps", gaps).select(*digest)
        found = cut(found)
        across = found.where("span").repartition("conv_id").sortWithinPartitions("conv_id", "pid", "part")
        return found.where("not span").withColumn("gaps", gaps).select(*digest).unionByName(across.mapInArrow(_joined, _DIGEST))


_LEGAL = ("su", "ua", "au")
_PIECE = ("conv_id string, pid int, span boolean, low long, high long, turns long, blank long, duplicate long, truncated long, "
          "illegal long, first_role string, last_role string, cost long, audit string, part long, repaired_sha256 string, body binary")
_DIGEST = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _joined(batches):
    """Sums up the consecutive pieces of each conversation."""
    names = [x.split()[0] for x in _DIGEST.split(", ")]
    types = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    at, out = None, []

    def closed():
        gaps = at["high"] - at["low"] + 1 - at["turns"] if at["turns"] else 0
        return at["conv"], gaps, *at["sums"], "".join(at["audit"]), at["sha"].hexdigest()

    for batch in batches:
        for row in batch.to_pylist():
            if at is None or row["conv_id"] != at["conv"]:
                if at is not None:
                    out.append(closed())
                at = {"conv": row["conv_id"], "low": None, "high": None, "turns": 0, "sums": [0] * 5, "audit": [],
                      "sha": hashlib.sha256(), "begun": False, "role": None}
            if row["first_role"] is not None:
                if row["turns"]:
                    at["turns"] += row["turns"] - (at["high"] == row["low"])  # a turn may span pieces
                    at["low"] = row["low"] if at["low"] is None else at["low"]
                    at["high"] = row["high"]
                for i, name in enumerate((*FAULTS, "illegal", "cost")):
                    at["sums"][i] += row[name]
                if at["role"] is not None and at["role"] + row["first_role"] not in _LEGAL:
                    at["sums"][3] += 1
                at["role"] = row["last_role"]
                at["audit"].append(row["audit"])
            if row["body"] is not None:
                at["sha"].update((b"\n" if at["begun"] else b"") + row["body"])
                at["begun"] = True
    if at is not None:
        out.append(closed())
    yield _records(out, types, names)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> Repair:
    """The cheapest repair of every conversation, as ``edits()`` and ``digests()``.

    Null roles and texts are one space; null ids are one conversation; rows
    of one turn, null turns first, go by role and text; repeated rows are duplicates but
    for the first; a role that begins with none of s, u, a must be changed
    or deleted; other columns are ignored; an empty table gives no rows.
    """
    return Repair(ordered_rows(rows, id_col, turn_col, role_col, text_col))


# -- the damage of the registered query --------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with the query's planted faults, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    kind = F.col("kind")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind")) \
        .where("kind <> 0").select(
            "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def repaired_digests(rows: DataFrame) -> DataFrame:
    """The digests of the damaged conversations; one that lost all its rows has zeros and empty texts."""
    id_type = rows.schema["conv_id"].dataType
    found = repair(damaged(rows)).digests().withColumn("conv_id", F.col("conv_id").cast(id_type))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    zero = F.lit(0).cast("long")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(n, zero).alias(n) for n in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
