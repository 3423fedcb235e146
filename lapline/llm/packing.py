"""Best-fit packing of token sequences, bulk-synchronous.

Documents are tokenised, cut into pieces and range-sorted by length.  The
packing runs in supersteps, one for each piece length from the longest
down: all pieces of a length are matched at once with the open gaps, each
taking the smallest gap it fits (the successor of its length); pieces that
want the same gap are told apart by their rank within the length; the gaps
are updated and the next superstep follows; what finds no gap opens new
sequences.  This is best-fit decreasing.

Pieces of a length are interchangeable, and lengths are whole numbers up
to the capacity.  So a superstep needs, of documents and of gaps, only runs
(length, first rank, count), at most ``capacity`` of either kind; only these
counts reach the driver, whatever the number of documents.  Ranks come from
the range sort (``running_total``), and every piece finds its place by its
rank in the broadcast runs, whose number is bounded by the capacity alone.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm.common import cut, pieces, running_total

CAPACITY = 2048
END_ID = 0
#: A byte-level BPE with its own splitting parts texts by this pattern; merges never cross its borders.  Fixed value.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The byte-level alphabet: printable bytes stand for themselves, the others, in order, for code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Characters of a run without a break from which the tokenizer itself takes the text: tiktoken's time is quadratic in a run.
_LONG = 1000
_BLANKS = re.compile(r"\s{%d}" % _LONG)
_encoders: dict = {}


def _merges(path: str):
    """text -> ids by tiktoken's merges, if the file must give the same: a plain byte-level BPE whose ids rise in the order of its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model, split = made["model"], made.get("pre_tokenizer") or {}
    vocab = model.get("vocab", {})
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model.get("merges", [])]
    byte_of = {chr(_BYTE_LEVEL.get(b, b)): b for b in range(256)}
    plain = {t: i for t, i in vocab.items() if t and all(c in byte_of for c in t)}
    joined = set(merged)
    ranks = {bytes(byte_of[c] for c in t): i for t, i in plain.items() if len(t) == 1 or i in joined}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) \
            or made.get("normalizer") or made.get("truncation") or model.get("type") != "BPE" \
            or None in merged or merged != sorted(merged) or not {bytes([b]) for b in range(256)} <= ranks.keys() \
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    return tiktoken.Encoding("texts", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class _Encoder:
    """Ids of texts, little-endian in 32 bits.  It holds the vocabulary and nothing that grows with the texts."""

    def __init__(self, path: str):
        self.path, self.merges, self.tokenizer = path, _merges(path), None

    def whole(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = True
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.merges is None or len(text) > _LONG and (
                max(map(len, text.split()), default=0) > _LONG or _BLANKS.search(text)):
            return self.whole(text)
        return np.array(self.merges(text), "<u4").tobytes()


def _encoder(path: str) -> _Encoder:
    """The worker's encoder: one vocabulary, whatever the number of tasks."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, salt[, ids]) for every piece of every document.

    A document is its token ids and an end id.  One longer than
    ``capacity`` is cut into pieces of ``capacity`` ids, of which the first
    is the shorter rest.  Null text counts as empty (one piece, the end id);
    the id may be null.  ``salt`` spreads repeated rows over a range sort.
    """
    tail = np.array([END_ID], "<u4").tobytes()
    width = 4 * capacity

    def run(batches):
        from pyspark import TaskContext

        encode, row = _encoder(tokenizer_path), TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                out = [[] for _ in range(7)]
                encoded = [encode(x or "") for x in batch.column(1).to_pylist()]
                for doc, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                    ids += tail
                    first = len(ids) % width or width
                    for k, start in enumerate([0, *range(first, len(ids), width)]):
                        part = ids[start:first if k == 0 else start + width]
                        row += 1
                        values = (doc, k, start // 4, len(part) // 4, zlib.crc32(part), row, part if with_ids else None)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                arrays = [pa.array(x, t) for x, t in zip(out, [
                    pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt", "ids"]
    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, salt long, ids binary")
    return made if with_ids else made.drop("ids")


def best_fit_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces in each sequence, first sequence, offset) in order of length and rank.

    ``counts``: pieces of each length.  The pieces of a run fill
    consecutive sequences from ``first sequence`` on, each from ``offset``.
    """
    runs = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first sequence, sequences)]
    sizes: list[int] = []  # the gaps that are open, in order
    opened = 0

    def leave(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        at = bisect_left(sizes, length)
        while left and at < len(sizes):
            gap = sizes[at]
            each = gap // length
            first, number = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            whole = min(number, left // each)
            if whole:
                runs.append((length, rank, each, first, capacity - gap))
                rank, left = rank + whole * each, left - whole * each
            rest = left if whole < number and left < each else 0
            if rest:
                runs.append((length, rank, rest, first + whole, capacity - gap))
                rank, left = rank + rest, 0
            leave(gap, first + whole + bool(rest), number - whole - bool(rest))
            leave(gap - each * length, first, whole)
            leave(gap - rest * length, first + whole, int(bool(rest)))
            at = bisect_left(sizes, length)
        each = capacity // length
        whole, rest = divmod(left, each)
        if whole:
            runs.append((length, rank, each, opened, 0))
            leave(capacity - each * length, opened, whole)
            rank, opened = rank + whole * each, opened + whole
        if rest:
            runs.append((length, rank, rest, opened, 0))
            leave(capacity - rest * length, opened, 1)
            opened += 1
    return sorted(runs)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Append ``sequence_id`` and ``offset`` to a table of pieces with ``length`` (1 to capacity) and ``salt``.

    Every row gets its own place; equal rows and ties of length are told
    apart by their rank.  An empty table stays empty.
    """
    ranked = running_total(
        found.withColumn("one", F.lit(1).cast("long")).withColumn("mixed", F.xxhash64("salt")),
        "length", ["mixed", "salt"], "one", "rank")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(best_fit_runs(counts, capacity), np.int64).reshape(-1, 5)
    # runs are in order of (length, rank): one key finds the run of a piece
    step = np.int64(max(counts.values(), default=0) + 1)
    keys = runs[:, 0] * step + runs[:, 1]
    sent = found.sparkSession.sparkContext.broadcast((keys, runs, step))
    columns = [c for c in ranked.columns if c not in ("one", "mixed", "salt", "rank")]

    def place(batches):
        keys, runs, step = sent.value
        for batch in batches:
            length = np.asarray(batch.column(batch.schema.get_field_index("length")))
            rank = np.asarray(batch.column(batch.schema.get_field_index("rank")))
            own = runs[np.searchsorted(keys, length * step + rank, side="right") - 1]
            k = rank - own[:, 1]
            sequence = own[:, 3] + k // own[:, 2]
            offset = own[:, 4] + k % own[:, 2] * length
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             names=[*columns, "sequence_id", "offset"])

    schema = ranked.select(*columns).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    Null texts are packed as empty ones, rows with equal or null ids are
    packed one by one, other columns are ignored; an empty table gives no
    rows.  ``with_ids`` adds each piece's ids (little-endian 32-bit).
    """
    found = cut(tokenized_pieces(docs, tokenizer_path or default_tokenizer(), capacity, id_col, text_col, with_ids))
    return pack(found, capacity)
