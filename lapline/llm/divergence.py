"""Source divergence audit over K-squared quadtrees of the group-term counts.

For each language, groups (language, source) are the rows and kept terms the
columns of a count matrix.  It is cut into tiles by hashes of source and term:
about ``ROWS`` groups by ``COLUMNS`` terms, whatever the number of
either.  A task holds one pair of row blocks within one strip of columns, builds the
K-squared tree (K = 2) of either block as a pyramid of occupancy bits, and walks
both trees jointly, for all pairs of groups at once, from the root down:

* where the quadrants of both are empty, every pair of their rows gets the price
  of that many columns with no count on either side, in closed form;
* other quadrants are split, down to single cells, where the term of the sum is
  evaluated for the pair.

The trees' rows and columns are ordered by how filled they are, so empty
cells lie together.  All arithmetic is on whole numbers.

Terms are counted in bounded tables within tasks, then by partial sums; only
(language, source, term) counts are shuffled.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapline.llm.common import cut, pieces, skewed_join, text_bytes

#: Documents of a language in which a term must occur to be kept.
MIN_DOCUMENTS = 10
#: Ranks of the ``term`` part.
TOP_TERMS = 10
#: Fixed value: the shares of terms are counted in parts of this.
SCALE = 1_000_000_000
ROWS, COLUMNS = 32, 1024
#: A task's table of counts is passed on beyond this many entries, or this many bytes of texts.
_TABLE_ENTRIES, _TABLE_BYTES = 100_000, 64 << 20
#: Letters are lower-cased, all other ASCII bytes part terms; UTF-8 bytes of other characters stay.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_BYTES).split()


def share(count, total, n_terms):
    """p = 1 + floor(SCALE * (count + 2) / (total + 2 * n_terms)), exact in 64 bits while the divisor is below 2^53.

    SCALE is multiplied in three steps, so nothing overflows for counts of 10^15.
    """
    divisor = np.maximum(np.int64(total) + 2 * np.int64(n_terms), 1)
    whole, rest = np.divmod(np.asarray(count, np.int64) + 2, divisor)
    result = whole * SCALE
    for unit in (1_000_000, 1_000, 1):
        digit, rest = np.divmod(rest * 1000, divisor)
        result = result + digit * unit
    return result + 1


def price(p, q):
    """f = floor((p - q)^2 / (p + q)); both are at most SCALE + 1."""
    return (p - q) ** 2 // (p + q)


def _halved(bits: np.ndarray) -> np.ndarray:
    """Occupancy of the quadrants twice as large."""
    r, c = bits.shape
    wide = np.zeros((r + r % 2, c + c % 2), bool)
    wide[:r, :c] = bits
    return wide[0::2, 0::2] | wide[1::2, 0::2] | wide[0::2, 1::2] | wide[1::2, 1::2]


def tree(counts: np.ndarray) -> list[np.ndarray]:
    """Occupancy of all quadrants, from single cells up to the root that holds the whole matrix."""
    levels = [counts > 0]
    while levels[-1].size > 1:
        levels.append(_halved(levels[-1]))
    return levels


def joint_sums(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, p0: np.ndarray, q0: np.ndarray,
               same: bool, beyond: int = 0) -> np.ndarray:
    """sum over columns of price(p of row g in a, q of row h in b), for all pairs (g, h); for ``same`` those with g < h.

    ``a``, ``b``: counts (rows, columns), ``p``, ``q`` their shares, ``p0``, ``q0`` each row's share of a zero count.
    ``beyond``: further columns, empty in both.
    """
    rows_a, columns = a.shape
    rows_b = b.shape[0]
    sums = np.zeros((rows_a, rows_b), np.int64)
    empty = np.full((rows_a, rows_b), beyond, np.int64)
    if same:
        empty = np.triu(empty, 1)
    if not rows_a or not rows_b:
        return sums
    if not columns:
        return sums + empty * price(p0[:, None], q0[None, :])
    trees = tree(a), tree(b)
    for t in trees:  # roots of one height: a root covers the empty rows beyond its matrix too
        while len(t) < max(len(trees[0]), len(trees[1])):
            t.append(_halved(t[-1]))
    ra, rb, c = (np.zeros(1, np.int64) for _ in range(3))
    for level in range(len(trees[0]) - 1, -1, -1):
        size = 1 << level
        filled = trees[0][level][ra, c] | trees[1][level][rb, c]
        # both quadrants are empty: all their rows' pairs, by the number of real columns
        width = np.minimum((c + 1) * size, columns) - c * size
        zero = np.zeros((trees[0][level].shape[0], trees[1][level].shape[0]), np.int64)
        np.add.at(zero, (ra[~filled], rb[~filled]), width[~filled])
        empty += zero.repeat(size, 0)[:rows_a].repeat(size, 1)[:, :rows_b]
        ra, rb, c = ra[filled], rb[filled], c[filled]
        if level:
            below = [t[level - 1].shape for t in trees]
            ra, rb, c = (np.concatenate([2 * x + d[k] for d in np.ndindex(2, 2, 2)]) for k, x in enumerate((ra, rb, c)))
            inside = (ra < below[0][0]) & (rb < below[1][0]) & (c < below[0][1])
            if same:
                inside &= ra <= rb
            ra, rb, c = ra[inside], rb[inside], c[inside]
    for at in range(0, len(c), 1 << 18):
        g, h, t = (x[at:at + (1 << 18)] for x in (ra, rb, c))
        np.add.at(sums, (g, h), price(p[g, t], q[h, t]))
    sums += empty * price(p0[:, None], q0[None, :])
    return np.triu(sums, 1) if same else sums


def _tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of all pairs of groups of two row blocks over one strip of terms; on the diagonal also each group's best terms."""
    lang, _, first, second = (k.as_py() for k in key)
    heads: dict[str, tuple] = {}
    cells = []
    width = 0
    for row in zip(*(table.column(n).to_pylist() for n in (
            "source", "block", "total", "n_terms", "lang_total", "term", "count", "term_total")), strict=True):
        if row[5] is None:
            heads[row[0]] = row[1:5]
            width = row[6]
        else:
            cells.append((row[0], row[5].encode(), row[6], row[7]))
    filled = Counter(x[0] for x in cells)
    names = [sorted((s for s, h in heads.items() if h[0] == k), key=lambda s: (-filled[s], s.encode())) for k in (first, second)]
    spread = Counter(x[1] for x in cells)
    terms = sorted(spread, key=lambda t: (-spread[t], t))
    column = {t: i for i, t in enumerate(terms)}
    whole = np.zeros(len(terms), np.int64)
    blocks = []
    for own in names:
        row_of = {s: i for i, s in enumerate(own)}
        counts = np.zeros((len(own), len(terms)), np.int64)
        for s, t, n, all_of in cells:
            if s in row_of:
                counts[row_of[s], column[t]] = n
                whole[column[t]] = all_of
        total, n_terms = (np.array([[heads[s][i]] for s in own], np.int64).reshape(-1, 1) for i in (1, 2))
        blocks.append((counts, share(counts, total, n_terms), share(np.zeros_like(total), total, n_terms)[:, 0]))
    (a, p, p0), (b, q, q0) = blocks
    sums = joint_sums(a, b, p, q, p0, q0, first == second, width - len(terms))
    out: list[tuple] = []
    for g, s in enumerate(names[0]):
        for h, other in enumerate(names[1]):
            if first != second or g < h:
                # rows are ordered by the strip's own counts: name the pair the same way in every strip
                out.append(("pair", lang, *sorted((s, other)), int(sums[g, h])))
    if first == second and heads:
        _, _, n_terms, lang_total = next(iter(heads.values()))
        of_lang = share(whole, lang_total, n_terms)
        for g, s in enumerate(names[0]):
            at = np.flatnonzero((a[g] > 0) & (p[g] > of_lang))
            best = sorted(zip((-price(p[g][at], of_lang[at])).tolist(), (terms[i] for i in at), strict=True))[:TOP_TERMS]
            out.extend(("term", lang, s, t.decode(), -v) for v, t in best)
    columns = list(zip(*out, strict=True)) or [[]] * 5
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, [*[pa.string()] * 4, pa.int64()], strict=True)],
                                names=["part", "lang", "source", "item", "value"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, documents): partial counts of (text, lang, source) rows without nulls."""
    names = ["lang", "source", "term", "count", "documents"]

    def table_of(held):
        rows = [(*group, t, n, df[t]) for group, (tf, df) in held.items() for t, n in tf.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.binary()).cast(pa.string()), *(pa.array(x, pa.int64()) for x in columns[3:])], names=names)

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        seen = 0
        for whole in batches:
            for batch in pieces(whole, "text", 4 << 20):
                texts = text_bytes(batch.column(0))
                for raw, lang, source in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    found = terms_of(raw)
                    tf, df = held.setdefault((lang, source), (Counter(), Counter()))
                    tf.update(found)
                    df.update(set(found))
                    seen += len(raw)
                if seen > _TABLE_BYTES or sum(len(tf) for tf, _ in held.values()) > _TABLE_ENTRIES:
                    yield table_of(held)
                    held, seen = {}, 0
        yield table_of(held)

    return docs.mapInArrow(run, "lang string, source string, term string, count long, documents long")


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source", rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language lie apart, and by which terms.

    Part ``pair``: every other source of the language and the divergence from
    it.  Part ``term``: the ``top_terms`` terms that set the source off from
    its whole language.  Null text, lang and source count as empty; a document is
    a row, so repeated rows count each; groups without terms are compared
    all the same; other columns are ignored; an empty table gives no rows.
    ``rows`` and ``columns``: groups and terms of a tile, on average.
    """
    if not 0 < top_terms <= TOP_TERMS:
        raise ValueError(f"top_terms must be 1 to {TOP_TERMS}")
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    one_term = Window.partitionBy("lang", "term")
    # dealt by (lang, term) once: both sums and the term's totals need no other exchange
    cells = cut(term_counts(read).repartition("lang", "term")
                .groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))
                .select("lang", "term", "source", "count", F.sum("documents").over(one_term).alias("in_documents"),
                        F.sum("count").over(one_term).alias("term_total"),
                        (F.min("source").over(one_term) == F.col("source")).cast("long").alias("first"))
                .where(F.col("in_documents") >= min_documents).drop("in_documents"))
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.sum("first").alias("first"))
    groups = cut(read.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0, ["total", "first"]))
    langs = cut(groups.groupBy("lang").agg(
        F.sum("first").alias("n_terms"), F.sum("total").alias("lang_total"),
        F.ceil(F.count("*") / rows).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.sum("first") / columns)).cast("int").alias("strips")))
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    no_long = F.lit(None).cast("long")
    placed = skewed_join(cells, langs, "lang", "inner") \
        .withColumn("strip", F.pmod(F.xxhash64("term"), F.col("strips")).cast("int"))
    widths = placed.groupBy("lang", "strip").agg(F.sum("first").alias("count"))  # a row for each strip
    # a group's head goes to every strip: a strip where it has no term counts too
    heads = skewed_join(groups.drop("first"), langs, "lang", "inner") \
        .withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1))).join(widths, ["lang", "strip"], "left").select(
        "lang", "strip", "blocks", block, "source", "total", "n_terms", "lang_total", F.lit(None).cast("string").alias("term"),
        F.coalesce("count", F.lit(0)).alias("count"), no_long.alias("term_total"))
    filled = placed.select("lang", "strip", "blocks", block, "source", no_long.alias("total"), no_long.alias("n_terms"),
                           no_long.alias("lang_total"), "term", "count", "term_total")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = heads.unionByName(filled).select("*", other).select(
        "lang", "strip", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "source",
        "block", "total", "n_terms", "lang_total", "term", "count", "term_total")
    found = cut(tiles.groupBy("lang", "strip", "first", "second").applyInArrow(
        _tile, "part string, lang string, source string, item string, value long"))
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    by_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    by_term = found.where("part = 'term'").select("lang", "source", "part", "item", "value", F.row_number().over(ranked).alias("rank")) \
        .where(F.col("rank") <= top_terms)
    return by_pair.unionByName(by_term)
