"""SimHash near-duplicates by anchor points of covering codes.

Anchors.  A code on all 64 bits whose balls are small has very many words near
any point: even with the Hamming code on 63 bits (covering radius 1) a
fingerprint has about 130,000 anchors within radius 1 plus threshold 4.  So the
64 bits are cut into three blocks (21, 21 and 22 bits), and two fingerprints
that differ in at most 4 bits differ in at most 1 bit of some block.  The
anchors are the words of a covering code on each block: the Hamming code on 15
of its bits, the others free, covering radius 1.  A fingerprint goes to every
anchor of a block within radius 1 plus threshold 1; the anchor nearest to
it is its home.  If x and y agree up to one bit in a block, x's home is within 2 of
y's block, so every pair meets at a home.  There are 2^19 anchors in all, and each
fingerprint goes to about 44 of them.

Compare.  Only distinct fingerprints are compared, home members against
all members of an anchor.  An anchor with very many members is dealt out over
cells (chunk of homes, chunk of members).  A cell gives the star edges of its links'
components, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.llm.common import cut, fresh, stored, text_bytes, with_columns
from lapline.llm.graph import components, forest

SHINGLE = 4
DISTANCE = 4
#: Members of an anchor that are compared in one cell.
CELL = 4096
_BLOCKS = ((0, 21), (21, 21), (42, 22))
_CODE_BITS = 15


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the shingles of a word sequence; 0 without words."""
    if not words:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:][:n] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], 42) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text", out: str = "fp") -> DataFrame:
    """Append the fingerprint as a signed long.  A null text counts as empty."""

    def make():
        def compute(batch):
            texts = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
            values = [fingerprint(x.lower().split(), shingle) for x in texts]
            return [np.array(values, np.uint64).view(np.int64)]

        return compute

    return with_columns(docs, make, [(out, T.LongType())], text_col)


def _near_masks(free: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome: the changes that lead to code words within distance 2, and which of them is the home's."""
    rows, homes = [], []
    upper = [1 << (_CODE_BITS + i) for i in range(free)]
    for s in range(16):
        home = 1 << (s - 1) if s else 0
        near = [home]
        near += [home | u for u in upper]
        if s:
            near += [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 16) if 0 < (i ^ s) and i < (i ^ s)]
        else:
            near += [a | b for k, a in enumerate(upper) for b in upper[:k]]
        rows.append(near)
        homes.append(home)
    width = max(map(len, rows))
    return np.array([r + [-1] * (width - len(r)) for r in rows], np.int64), np.array(homes, np.int64)


def _anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, index of the fingerprint, home) for every anchor of every fingerprint."""
    cells, owners, homes = [], [], []
    word = np.arange(1 << _CODE_BITS)
    syndrome = np.zeros(1 << _CODE_BITS, np.int64)
    for i in range(_CODE_BITS):
        syndrome ^= np.where(word >> i & 1, i + 1, 0)
    for number, (shift, bits) in enumerate(_BLOCKS):
        masks, home = _near_masks(bits - _CODE_BITS)
        value = (fps.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
        s = syndrome[value & ((1 << _CODE_BITS) - 1)]
        change = masks[s]
        ok = change >= 0
        cells.append(((value[:, None] ^ change) | number << 24)[ok])
        owners.append(np.broadcast_to(np.arange(len(fps))[:, None], change.shape)[ok])
        homes.append((change == home[s][:, None])[ok])
    return np.concatenate(cells), np.concatenate(owners), np.concatenate(homes)


def _cell_links(cell: np.ndarray, fps: np.ndarray, role: np.ndarray, distance: int):
    """Star edges for rows sorted by cell; role: 1 home, 2 member, 3 both."""
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[start, len(cell)])
    home_at = np.flatnonzero(role & 1)
    group = np.repeat(np.arange(len(start)), size)
    home_count = np.bincount(group[home_at], minlength=len(start))
    links_a, links_b = [], []
    u = fps.view(np.uint64)

    small = size * home_count <= 1024
    few = home_at[small[group[home_at]]]
    for at in range(0, len(few), 20_000):  # at most 20,000 x 1,024 comparisons at once
        h = few[at:at + 20_000]
        n = size[group[h]]
        left = np.repeat(h, n)
        right = np.repeat(start[group[h]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ok = (np.bitwise_count(u[left] ^ u[right]) <= distance) & (fps[left] != fps[right]) & (role[right] > 1)
        links_a.append(fps[left[ok]])
        links_b.append(fps[right[ok]])
    for g in np.flatnonzero(~small & (home_count > 0)):
        own = slice(start[g], start[g] + size[g])
        homes, members = fps[own][(role[own] & 1) > 0], fps[own][role[own] > 1]
        for at in range(0, len(homes), 256):
            h = homes[at:at + 256]
            i, j = np.nonzero(np.bitwise_count(h.view(np.uint64)[:, None] ^ members.view(np.uint64)) <= distance)
            if len(i):
                a, b = forest(h[i], members[j])
                links_a.append(a)
                links_b.append(b)
    if not links_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(links_a), np.concatenate(links_b))


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE, cell_size: int = CELL) -> DataFrame:
    """Edges (a, b) that connect whatever distinct fingerprints of a one-column long table lie within ``distance`` bits.

    ``distance`` is at most 4; every pair within it is joined by a path of
    edges, and no edge joins a pair that isn't.
    """
    if not 0 <= distance <= 2 * len(_BLOCKS) - 1:
        raise ValueError("three blocks with threshold 1 reach distance 5 at most")
    name = fps.columns[0]
    spark = fps.sparkSession

    def count(batches):
        for batch in batches:
            cells, n = np.unique(_anchors(np.asarray(batch.column(0)).astype(np.int64))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], names=["cell", "n"])

    # at most one row for each anchor, of which there are 2^19 whatever the input
    full = fps.select(name).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")) \
        .where(F.col("n") > cell_size).collect()
    sent = spark.sparkContext.broadcast((
        np.array(sorted(r["cell"] for r in full), np.int64),
        np.array([-(-r["n"] // cell_size) for r in sorted(full, key=lambda r: r["cell"])], np.int64)))

    def deal(batches):
        hot, chunks = sent.value
        for batch in batches:
            own = np.asarray(batch.column(0)).astype(np.int64)
            for at in range(0, len(own), 20_000):
                fp = own[at:at + 20_000]
                cell, owner, home = _anchors(fp)
                value, role, part = fp[owner], np.where(home, 3, 2).astype(np.int32), np.zeros(len(cell), np.int64)
                if len(hot):
                    found = np.minimum(np.searchsorted(hot, cell), len(hot) - 1)
                    is_hot = hot[found] == cell
                    n = np.where(is_hot, chunks[found], 0)
                    chunk = ((value.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
                    chunk %= np.maximum(n, 1)
                    i = np.flatnonzero(is_hot)
                    k = np.repeat(i, n[i])
                    other = np.arange(len(k)) - np.repeat(np.cumsum(n[i]) - n[i], n[i])
                    as_home = home[k]
                    keep = ~is_hot
                    part = np.r_[part[keep], other * n[k] + chunk[k], (chunk[k] * n[k] + other)[as_home]]
                    cell, value, role = (
                        np.r_[cell[keep], cell[k], cell[k][as_home]], np.r_[value[keep], value[k], value[k][as_home]],
                        np.r_[role[keep], np.full(len(k), 2, np.int32), np.full(int(as_home.sum()), 1, np.int32)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell << 32 | part), pa.array(value), pa.array(role.astype(np.int32))], names=["cell", "fp", "role"])

    def compare(batches):
        held = None
        for batch in batches:
            rows = [np.asarray(batch.column(i)) for i in range(3)]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            end = int(np.searchsorted(rows[0], rows[0][-1]))  # the last cell may go on in the next batch
            held = [x[end:] for x in rows]
            if end:
                yield link([x[:end] for x in rows])
        if held is not None:
            yield link(held)

    def link(rows):
        a, b = _cell_links(*rows, distance)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    members = fps.select(name).mapInArrow(deal, "cell long, fp long, role int")
    return members.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each document.

    Fingerprints within ``distance`` bits are linked; equal ones are one class.
    ``component_id`` is the smallest id reachable.  Null and empty texts have
    fingerprint zero and are linked like others; a null id is never the
    smallest unless all are null; rows with equal ids stay; an empty table gives
    no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = cut(with_fingerprints(narrow, shingle).drop("text"))
    rooted = fingerprint_classes(prints, distance)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprint_classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, least, root) for each distinct fingerprint of a table (doc_id, fp): its smallest id and its group's smallest fingerprint."""
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(classes.select("fp"), distance))
    return classes.join(roots, classes["fp"] == roots["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id, or one without id if all are.

    Groups are told apart by their texts alone: rows that share an id, or have
    none, stay if their texts aren't near-duplicates, and of repeated rows one stays.
    """
    own, best, least = (fresh(docs.columns, x) for x in ("print", "first_print", "least_id"))
    marked = stored(with_fingerprints(docs, shingle, text_col, own), "prints")
    prints = marked.select(F.col(id_col).cast("long").alias("doc_id"), F.col(own).alias("fp"))
    rooted = fingerprint_classes(prints, distance)
    # of each group the fingerprint whose smallest id is the smallest, those without any id last
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("first")
    chosen = rooted.groupBy("root").agg(first) \
        .select(F.col("first.fp").alias(best), F.col("first.least").alias(least))
    same = (marked[own] == chosen[best]) & marked[id_col].cast("long").eqNullSafe(chosen[least])
    return marked.join(chosen, same).dropDuplicates([own]).select(*(F.col(f"`{c}`") for c in docs.columns))
