"""Quality rules: base figures of a text, then cross-document line frequency.

A line is normalised (ASCII letters lower-cased, runs of digits as one 0, words
joined by single spaces) and hashed together with its document's host.  Lines
found in more than ``max_documents`` distinct documents of their host are
removed.  A document that keeps less than ``least_share`` of its words is
depleted and rejected, as is one that fails the base rules.

Documents of a host with equal texts are one document here: copies are for the
de-duplication, and a group of copies doesn't make its own lines frequent.

One pass over the texts gives the figures and (line, words) of every document.
After that only 64-bit keys move: distinct (line, text) pairs are counted by line with
partial sums, so neither a common line nor a group of copies is ever brought
together, and the joins broadcast the rows of hot keys (``skewed_join``).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.llm.common import cut, fresh, pieces, skewed_join

#: Distinct documents of a host in which a line may occur.
MAX_DOCUMENTS = 10
#: Share of a document's words that must remain.
LEAST_SHARE = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_DIGITS = re.compile(rb"[0-9]+")


def normalised(line: bytes) -> bytes:
    """A line as it is compared: lower case, numbers as 0, single spaces; empty if it has no word."""
    return _DIGITS.sub(b"0", b" ".join(line.translate(_LOWER).split()))


def repeated_words(documents: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """For each list of words: how many lie in windows of ``window`` words that occur twice or more in it.

    Exact: runs of 1, 2, 4, ... words are numbered by the pair of their halves' numbers, documents apart.
    """
    lengths = np.fromiter(map(len, documents), np.int64, len(documents))
    total = int(lengths.sum())
    if not total or lengths.max() < window:
        return np.zeros(len(documents), np.int64)
    flat = np.empty(total, object)
    flat[:] = [w for d in documents for w in d]
    doc = np.repeat(np.arange(len(documents)), lengths)
    ids = pd.factorize(flat)[0].astype(np.int64)
    ids = pd.factorize(doc * (ids.max() + 1) + ids)[0].astype(np.int64)  # a word of another document is another word
    size = 1
    while size < window:  # ids[i]: the run of ``size`` words from i; windows over a border are never equal
        step = min(size, window - size)
        n = len(ids) - step
        ids = pd.factorize(ids[:n] * (ids.max() + 1) + ids[step:])[0].astype(np.int64)
        size += step
    whole = doc[: len(ids)] == doc[window - 1:]
    counts = np.bincount(ids[whole], minlength=int(ids.max()) + 1)
    starts = np.flatnonzero(whole & (counts[ids] > 1))
    change = np.zeros(total + 1, np.int64)
    change[starts] += 1
    np.add.at(change, starts + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(documents)).astype(np.int64)


def _figures(text: str | None, host: str) -> tuple:
    """(words, word_chars, n_symbols, n_dup_lines, text key, line keys, words of each line in all its occurrences)."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    place = host.encode("utf-8", "surrogatepass") + b"\n"
    found: dict[int, int] = {}
    for line in lines:
        key = xxhash.xxh64_intdigest(place + normalised(line)) - (1 << 63)
        found[key] = found.get(key, 0) + len(line.split())
    return (words, len(text) - spaces, len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
            xxhash.xxh64_intdigest(place + raw) - (1 << 63), list(found), list(found.values()))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row for each document: its id, the base figures, ``base_failed``, a key of (host, text), and its lines.

    Null text counts as empty; documents without a host are one host, apart from every named one.
    """
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "text_key",
             "line_keys", "line_words"]

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 4 << 20):
                # a null host has a mark that no name begins with
                hosts = ["\x00" if h is None else "=" + h for h in batch.column(2).to_pylist()]
                made = [_figures(t, h) for t, h in zip(batch.column(1).to_pylist(), hosts, strict=True)]
                if not made:
                    continue
                words, chars, symbols, dups, text_keys, keys, counts = map(list, zip(*made, strict=True))
                repeats = repeated_words(words)
                n = np.fromiter(map(len, words), np.int64, len(words))
                failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
                longs = [pa.array(x, pa.int64()) for x in (n, chars, symbols, dups, repeats)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *longs, pa.array(failed), pa.array(text_keys, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))], names=names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.col(host_col).cast("string").alias("host"))
    return narrow.mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, text_key long, line_keys array<long>, line_words array<long>")


def line_pairs(measured: DataFrame) -> DataFrame:
    """Distinct (line, text) with the words that the text has in the line; copies of a text give one row."""
    return measured.select("text_key", F.explode(F.arrays_zip("line_keys", "line_words")).alias("l")) \
        .groupBy(F.col("l.line_keys").alias("line_key"), "text_key").agg(F.max("l.line_words").alias("words"))


def frequent_lines(pairs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(line_key, n_documents) of the lines in more than ``max_documents`` distinct documents of their host."""
    return pairs.groupBy("line_key").agg(F.count("*").alias("n_documents")).where(F.col("n_documents") > max_documents)


def assess(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, least_share: float = LEAST_SHARE, id_col: str = "doc_id",
           text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The figures of ``measure`` without lines and keys, ``removed_words`` and ``kept``, one row for each row of ``docs``.

    ``kept``: the base rules hold and at least ``least_share`` of the words
    remain once frequent lines are gone.  Null and empty texts have no words and
    fail the base rules; rows with equal or null ids are rows of their own;
    other columns are ignored; an empty table gives no rows.
    """
    measured = cut(measure(docs, id_col, text_col, host_col))
    pairs = cut(line_pairs(measured))
    removed = skewed_join(pairs, frequent_lines(pairs, max_documents), "line_key", "inner") \
        .groupBy("text_key").agg(F.sum("words").alias("removed_words"))
    rows = measured.drop("line_keys", "line_words")
    lost = F.coalesce(F.col("removed_words"), F.lit(0).cast("long"))
    # shares are compared as whole thousandths of the words, so that no rounding decides
    enough = (F.col("n_words") - lost) * 1000 >= F.col("n_words") * round(1000 * least_share)
    return skewed_join(rows, removed, "text_key").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & enough).alias("kept"), lost.alias("removed_words"))


def without_frequent_lines(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, text_col: str = "text",
                           host_col: str = "source", out: str = "clean_text") -> DataFrame:
    """``docs`` with ``out``: each text without the frequent lines of its host, all else as it was.

    Null texts stay null.  A column of ``docs`` named ``out`` is replaced; all others are kept.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("\0"))
    text = F.col(text_col).cast("string")

    def keys(batches):
        for batch in batches:
            made = [_figures(t, h) for t, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[4] for m in made], pa.int64()), pa.array([m[5] for m in made], pa.list_(pa.int64())),
                 pa.array([m[6] for m in made], pa.list_(pa.int64())), *batch.columns],
                names=["text_key", "line_keys", "line_words", "text", "host"])

    def strip(batches):
        for batch in batches:
            texts = []
            for t, h, drop in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                place, gone = h.encode("utf-8", "surrogatepass") + b"\n", set(drop)
                texts.append("\n".join(x for x in t.split("\n") if not x.encode("utf-8", "surrogatepass").strip()
                                       or xxhash.xxh64_intdigest(place + normalised(x.encode("utf-8", "surrogatepass"))) - (1 << 63) not in gone))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["text_key", "clean"])

    distinct = docs.where(text.isNotNull()).select(text.alias("text"), host.alias("host")).distinct()
    keyed = cut(distinct.mapInArrow(keys, "text_key long, line_keys array<long>, line_words array<long>, text string, host string"))
    pairs = cut(line_pairs(keyed))
    gone = skewed_join(pairs, frequent_lines(pairs, max_documents), "line_key", "inner") \
        .groupBy("text_key").agg(F.collect_list("line_key").alias("drop"))  # as many as the text has lines
    clean = keyed.join(gone, "text_key").select("text_key", "text", "host", "drop") \
        .mapInArrow(strip, "text_key long, clean string")
    kept = [c for c in docs.columns if c != out]
    key, new = fresh(docs.columns, "text_key"), fresh(docs.columns, "clean")
    with_key = docs.mapInArrow(_keyed(docs.columns, text_col, host_col, key), T.StructType([*docs.schema.fields, T.StructField(key, T.LongType())]))
    return skewed_join(cut(with_key), clean.toDF(key, new), key).select(*kept, F.coalesce(F.col(new), text).alias(out))


def _keyed(columns: list[str], text_col: str, host_col: str, key: str):
    """Appends the key of (host, text) as ``_figures`` makes it."""
    def run(batches):
        for batch in batches:
            texts = batch.column(columns.index(text_col)).cast(pa.string()).to_pylist()
            hosts = batch.column(columns.index(host_col)).cast(pa.string()).to_pylist()
            made = [xxhash.xxh64_intdigest((("\x00" if h is None else "=" + h) + "\n" + (t or "")).encode("utf-8", "surrogatepass"))
                    - (1 << 63) for t, h in zip(texts, hosts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.int64())], names=[*columns, key])

    return run
