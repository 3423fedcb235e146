"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A conversation is a sequence of rows (its turns as stored, or whole transcripts)
whose texts are sequences of lines.  The states are begin and inside of a turn
for each role.  A line is observed by its speaker marker, its length, its end,
and the number of lines of its row; the first line of a row begins a turn.  Emission and
transition counts come from rows whose role is known, over pseudo-counts that
tie markers to roles.  Viterbi finds the best state sequence of a conversation;
the lines from one begin to the next are a turn, which is rendered canonically.

Any conversation may be long.  Rows are range-sorted by conversation and turn,
so it may span partitions.  For the first and the last conversation of a
partition a max-plus matrix (states x states) sums up its lines; chained on
the driver (two small matrices for each partition) they fix the states at the
borders, and every partition is then decoded on its own.  Scores are whole numbers
(millionths of a nat), so the result is the exact best path.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm.common import cut, remainder

ROLES = ("system", "user", "assistant", "tool")
_STATES = 2 * len(ROLES)  # 2 r: begins a turn of role r, 2 r + 1: inside it
_NEVER = -(10 ** 12)
#: Words that mark a speaker, by role.
MARKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "prompt"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model"),
    "tool": ("tool", "function", "observation", "output"),
}
_ROLE_OF = {w: r for r, words in enumerate(MARKERS.values()) for w in words}
_WORDS = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
#: <|user|>, <|im_start|>user; [user], (user):, <user>; ### User:, **User**:, User:.  A word before a bracket or bar that
#: none opens, as in "A) Paris" or a table's row, marks nobody.
_MARKER = re.compile(
    rf"\s*(?:<\|\s*(?:im_start\|>\s*)?(?P<a>{_WORDS})\s*(?:\|>|$)|[\[(<]\s*(?P<b>{_WORDS})\s*[\])>]\s*:?"
    rf"|(?:[#>*\-]+\s*)?(?P<c>{_WORDS})[*\s]*:\**)[ \t]*", re.I)
_NAME = re.compile(r"\s*[A-Z][\w .'-]{0,24}:\s")
_FEATURES = ("marker", "words", "end", "lines")
_SIZES = (len(ROLES) + 2, 14, 4, 8)
_PRIOR = 0.5
_MARKED = 200.0


class Model(NamedTuple):
    start: np.ndarray  # state
    move: np.ndarray  # state, state
    emit: list[np.ndarray]  # for each feature: state, value


def observe(text: str) -> tuple[list[str], np.ndarray, list[tuple[int, int]]]:
    """Lines of a row (one at least) as they are, the feature values of each, and each line's marker as (role or -1, its end)."""
    lines = text.split("\n")
    number = min(_SIZES[3] - 1, len(lines).bit_length() - 1)
    marks, values = [], np.empty((len(lines), len(_FEATURES)), np.int64)
    for i, line in enumerate(lines):
        marked = _MARKER.match(line)
        role = _ROLE_OF[marked[marked.lastgroup].lower()] if marked else -1
        marker = role + 1 if marked else len(ROLES) + 1 if _NAME.match(line) else 0
        stripped = line.rstrip()
        end = 0 if not stripped else 1 if stripped[-1] == "?" else 2 if stripped[-1] in ".!" else 3
        words = min(_SIZES[1] - 1, len(line.split()).bit_length())
        values[i] = marker, words, end, number
        marks.append((role, marked.end() if marked else 0))
    return lines, values, marks


def fit(counts: Counter) -> Model:
    """Model from counts of ("emit", state, feature, value), ("move", state, state) and ("start", state)."""
    start, move = np.full(_STATES, _PRIOR), np.full((_STATES, _STATES), _PRIOR)
    emit = [np.full((_STATES, n), _PRIOR) for n in _SIZES]
    for r in range(len(ROLES)):
        emit[0][2 * r, r + 1] += _MARKED  # a role's marker begins its turn
        emit[0][2 * r, 0] += _MARKED
        emit[0][2 * r + 1, 0] += 5 * _MARKED
    for key, n in counts.items():
        if key[0] == "emit":
            emit[key[2]][key[1], key[3]] += n
        elif key[0] == "move":
            move[key[1], key[2]] += n
        else:
            start[key[1]] += n
    start[1::2] = 0
    inside = np.arange(1, _STATES, 2)
    for a in range(_STATES):
        move[a, inside[inside != a // 2 * 2 + 1]] = 0  # inside goes on with the same role only

    def scores(x):
        x = x / x.sum(axis=-1, keepdims=True)
        return np.where(x > 0, np.round(1e6 * np.log(np.maximum(x, 1e-300))), _NEVER).astype(np.int64)

    return Model(scores(start), scores(move), [scores(e) for e in emit])


def line_scores(model: Model, values: np.ndarray) -> np.ndarray:
    """(lines, states): the emission scores of a row's lines; its first line begins a turn."""
    e = sum(model.emit[f][:, values[:, f]] for f in range(len(_FEATURES))).T.copy()
    e[0, 1::2] = _NEVER
    return e


def summary(model: Model, lines: np.ndarray) -> np.ndarray:
    """Best scores through the lines, from the state before them (last row: no state, the conversation starts) to their last."""
    best = np.vstack([model.move, model.start]) + lines[0]
    for e in lines[1:]:
        best = (best[:, :, None] + model.move[None]).max(axis=1) + e
    return best


def decode(model: Model, lines: np.ndarray, before: int = -1, last: int | None = None) -> np.ndarray:
    """Best states of the lines after the state ``before`` (-1: at the start), ending in ``last`` if given."""
    best = (model.start if before < 0 else model.move[before]) + lines[0]
    back = np.empty((len(lines), _STATES), np.int8)
    for i in range(1, len(lines)):
        step = best[:, None] + model.move
        back[i] = step.argmax(axis=0)
        best = step[back[i], np.arange(_STATES)] + lines[i]
    path = np.empty(len(lines), np.int64)
    path[-1] = int(best.argmax()) if last is None else last
    for i in range(len(lines) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


_CONTROL = re.compile(r"<(\\*)\|")


def escaped(content: str) -> str:
    """``content`` without control tokens: a backslash parts every ``<|`` (one more where some do); ``unescaped`` takes it out again."""
    return _CONTROL.sub(r"<\\\1|", content)


def unescaped(content: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", content)


def render(role: str, content: str) -> str:
    return f"<|im_start|>{role}\n{escaped(content)}<|im_end|>\n"


def _fragments(batches):
    """(conversation, [(turn, role, held_out, text)]) for each run of rows of a conversation in a partition."""
    at, held = None, []
    for batch in batches:
        for conv, turn, role, out, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and conv != at:
                yield at, held
                held = []
            at = conv
            held.append((turn, role, out, text or ""))
    if held:
        yield at, held


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _state_path(role: str, lines: int) -> list[int]:
    r = ROLES.index(role)
    return [2 * r] + [2 * r + 1] * (lines - 1)


def learn(ordered: DataFrame) -> Model:
    """Counts of all rows with a known role outside the held-out conversations, as a model.

    Starts and moves at a partition's first row are added from two small
    rows for each partition, so the model doesn't follow the partitions.
    """

    def known(row):
        _, role, out, text = row
        return None if out or role not in ROLES else _state_path(role, text.count("\n") + 1)

    def count(batches):
        n: Counter = Counter()
        for number, (_, rows) in enumerate(_fragments(batches)):
            previous = None
            for k, row in enumerate(rows):
                states = known(row)
                if states is None:
                    previous = None
                    continue
                values = observe(row[3])[1]
                for s, line in zip(states, values.tolist(), strict=True):
                    for f, v in enumerate(line):
                        n["emit", s, f, v] += 1
                for a, b in zip(states, states[1:], strict=False):
                    n["move", a, b] += 1
                if previous is not None:
                    n["move", previous, states[0]] += 1
                elif k == 0 and number:
                    n["start", states[0], 0] += 1
                previous = states[-1]
        keys = [",".join(map(str, k)) for k in n]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(n.values()), pa.int64())], names=["key", "n"])

    def edges(batches):
        first = last = None
        for conv, rows in _fragments(batches):
            begin, end = known(rows[0]), known(rows[-1])
            last = conv, begin[0] if begin else -1, end[-1] if end else -1
            first = first or last
        found = [(_partition(), *first[:2], *last[::2])] if first else []
        columns = list(zip(*found, strict=True)) or [[]] * 5
        types = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         names=["pid", "conv", "begin", "last_conv", "ending"])

    # as many keys as the model has parameters
    found = ordered.mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    counts = Counter({tuple(int(x) if x.isdigit() else x for x in r["key"].split(",")): r["n"] for r in found})
    before = None
    for r in sorted(ordered.mapInArrow(edges, "pid int, conv string, begin int, last_conv string, ending int").collect(), key=lambda r: r["pid"]):
        if before is None or before["last_conv"] != r["conv"]:
            if r["begin"] >= 0:
                counts["start", r["begin"], 0] += 1
        elif before["ending"] >= 0 and r["begin"] >= 0:
            counts["move", before["ending"], r["begin"]] += 1
        before = r
    return fit(counts)


def border_states(model: Model, ordered: DataFrame) -> dict[int, dict]:
    """For partitions whose first or last conversation goes on in another: the states before and at the end of the run."""

    def sums(batches):
        first = last = None
        for k, (conv, rows) in enumerate(_fragments(batches)):
            item = k, conv, rows
            first = first or item
            last = item
        for k, conv, rows in [x for i, x in enumerate((first, last)) if x and (i == 0 or x[0])]:
            lines = np.concatenate([line_scores(model, observe(text)[1]) for *_, text in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([_partition()], pa.int32()), pa.array([k], pa.int32()), pa.array([conv], pa.string()),
                 pa.array([summary(model, lines).tobytes()], pa.binary())], names=["pid", "k", "conv", "m"])

    rows = sorted(ordered.mapInArrow(sums, "pid int, k int, conv string, m binary").collect(), key=lambda r: (r["pid"], r["k"]))
    fixed: dict[int, dict] = {}
    run: list = []
    for r in [*rows, None]:
        if run and (r is None or r["conv"] != run[-1]["conv"]):
            if len(run) > 1:
                ahead = [None]
                total = None
                for x in run:
                    m = np.frombuffer(x["m"], np.int64).reshape(_STATES + 1, _STATES)
                    total = m[-1] if total is None else (total[:, None] + m[:-1]).max(axis=0)
                    ahead.append(total)
                end = int(total.argmax())
                for i in range(len(run) - 1, -1, -1):
                    m = np.frombuffer(run[i]["m"], np.int64).reshape(_STATES + 1, _STATES)
                    before = -1 if i == 0 else int((ahead[i] + m[:-1, end]).argmax())
                    fixed.setdefault(run[i]["pid"], {})[run[i]["k"]] = (before, end)
                    end = before
            run = []
        if r is not None:
            run.append(r)
    return fixed


def format_chats(rows: DataFrame, held_modulus: int = 5, held_remainder: int = 0, id_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each recovered turn: conv_id, turn, part, held_out, role, role_pred, n_lines, content, rendered.

    ``turn`` is the stored row and ``part`` counts the turns found in it from 0.
    Content is the stored text: only a marker of the turn's own role, at the line that begins the turn, is taken off.
    In ``rendered`` control tokens of the content are escaped.
    The given role is only used for training, outside conversations
    whose id's crc32 modulo ``held_modulus`` is ``held_remainder``.  A null
    or empty text is a turn of one empty line; null ids are one conversation;
    rows of one turn, null turns first, go by text and role; repeated rows are turns of their own; unknown roles teach nothing.  An
    empty table gives no rows.
    """
    narrow = rows.select(
        F.col(id_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        (remainder(id_col, held_modulus) == held_remainder).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    ordered = cut(narrow.repartitionByRange("conv", "turn", F.substring("text", 1, 256)).sortWithinPartitions("conv", "turn", "text", "role"))
    model = learn(ordered)
    sent = rows.sparkSession.sparkContext.broadcast((model, border_states(model, ordered)))
    id_type = rows.schema[id_col].dataType

    def turns(batches):
        model, fixed = sent.value
        known = fixed.get(_partition(), {})
        out = [[] for _ in range(9)]
        for k, (conv, rows) in enumerate(_fragments(batches)):
            seen = [observe(text) for *_, text in rows]
            before, end = known.get(k, (-1, None))
            path = decode(model, np.concatenate([line_scores(model, v) for _, v, _ in seen]), before, end)
            at = 0
            for (turn, role, held, _), (lines, _, marks) in zip(rows, seen, strict=True):
                own = path[at:at + len(lines)]
                at += len(lines)
                begins = np.flatnonzero(own % 2 == 0)
                for part, (a, b) in enumerate(zip(begins, [*begins[1:], len(lines)], strict=True)):
                    of, end_of_mark = marks[a]
                    first = lines[a][end_of_mark if of == int(own[a]) // 2 else 0:]
                    content, found = "\n".join([first, *lines[a + 1:b]]), ROLES[int(own[a]) // 2]
                    values = conv, turn, part, held, role, found, int(b - a), content, render(found, content)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            if len(out[0]) >= 5000:
                yield batch_of(out)
                out = [[] for _ in range(9)]
        yield batch_of(out)

    def batch_of(out):
        types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[
            "conv_id", "turn", "part", "held_out", "role", "role_pred", "n_lines", "content", "rendered"])

    return ordered.mapInArrow(
        turns, "conv_id string, turn long, part int, held_out boolean, role string, role_pred string, n_lines int, content string, "
        "rendered string").withColumn("conv_id", F.col("conv_id").cast(id_type))
