"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of virtual slots, never to change.
Bytes are added up for each slot, and a small stored table maps slots to
shards: version 0 whole, every later version by the one slot that it moves.
Rebalancing appends such edits, from the fullest shard to the emptiest;
records are placed by reading the table, as of any version.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.llm.common import cut, running_total, shared_dir

SLOTS = 8192
SHARDS = 24
RECORD_BYTES = 8
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def sized_records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, row): UTF-8 bytes plus 8; a null text has no bytes.

    The slot is a hash of the id, of the text's checksum where there is no
    id.  Where such a key repeats, its first record (by checksum and size)
    takes the key's slot and the n-th later one that of (key, n): an id
    that holds a third of all rows spreads over all slots.
    """
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    keyed = cut(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(data) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.when(F.col(id_col).isNull(), F.xxhash64(F.crc32(data))).otherwise(F.xxhash64(id_col)).alias("key"),
        # tells rows apart that are equal in all else, so that they may lie in several partitions
        F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("one")))
    ranked = running_total(keyed, "key", ["text_crc32", "size", "row"], "one", "copy")
    slot = F.pmod(F.when(F.col("copy") == 0, F.col("key")).otherwise(F.xxhash64("key", "copy")), F.lit(slots))
    return ranked.select("doc_id", "size", "text_crc32", slot.cast("int").alias("virtual_slot"), "row")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes in each slot that has records: one row for each slot at most."""
    return {r["virtual_slot"]: r["b"] for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect()}


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> np.ndarray:
    """Version 0 of the map: slots dealt in turn."""
    return np.arange(slots) % shards


def rebalance(slot_map: np.ndarray, bytes_of: Mapping[int, int], shards: int) -> tuple[np.ndarray, list[tuple]]:
    """The map after edits that even out the shards' bytes, and the edits (version, slot, from, to).

    Each edit moves one slot from the fullest shard to the emptiest: the one
    whose bytes come nearest to half their difference.  It ends when no
    move brings the two nearer.  The same call serves a larger number of
    shards: the new ones are empty.
    """
    new = np.array(slot_map, copy=True)
    weight = np.zeros(len(new), np.int64)
    for slot, b in bytes_of.items():
        weight[slot] = b
    load = np.bincount(new, weights=weight, minlength=shards).astype(np.int64)
    edits = []
    for version in range(1, 8 * len(new)):
        full, empty = int(load.argmax()), int(load.argmin())
        difference = int(load[full] - load[empty])
        own = np.flatnonzero((new == full) & (weight > 0) & (weight < difference))
        if not len(own):
            break
        slot = int(own[np.abs(2 * weight[own] - difference).argmin()])
        new[slot] = empty
        load[full] -= weight[slot]
        load[empty] += weight[slot]
        edits.append((version, slot, full, empty))
    return new, edits


def create_map(spark: SparkSession, path: str, slots: int = SLOTS, shards: int = SHARDS) -> None:
    """Store version 0 at ``path``: (version, virtual_slot, shard)."""
    map_table(spark, first_map(slots, shards), [], slots, shards).coalesce(1).write.parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard) of the stored map as of ``version``, the last one if None: a row for each slot."""
    table = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is not None:
        table = table.where(F.col("version") <= version)
    return table.groupBy("virtual_slot").agg(F.max_by("shard", "version").alias("shard"))


def map_version(spark: SparkSession, path: str) -> int:
    return spark.read.schema(MAP_SCHEMA).parquet(path).agg(F.max("version")).first()[0]


def rebalance_stored(spark: SparkSession, path: str, bytes_of: Mapping[int, int], shards: int) -> tuple[np.ndarray, list[tuple]]:
    """Even out the shards of the stored map: the new map and the edits, appended as its next versions."""
    rows = read_map(spark, path).orderBy("virtual_slot").collect()  # as many as slots
    last = map_version(spark, path)
    slot_map, edits = rebalance(np.array([r["shard"] for r in rows]), bytes_of, shards)
    edits = [(last + v, slot, from_, to) for v, slot, from_, to in edits]
    if edits:
        spark.createDataFrame([(v, slot, to) for v, slot, _, to in edits], MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return slot_map, edits


def assign(records: DataFrame, path: str, version: int | None = None) -> DataFrame:
    """Append ``shard`` by the map stored at ``path`` and ``slot``: the record's place in its shard, from 0."""
    table = read_map(records.sparkSession, path, version)
    placed = records.join(F.broadcast(table), "virtual_slot")  # as many rows as slots
    placed = placed.withColumn("one", F.lit(1).cast("long")).withColumn("mixed", F.xxhash64("doc_id", "text_crc32"))
    return running_total(placed, "shard", ["mixed", "doc_id", "row"], "one", "slot").drop("one", "mixed", "row")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id",
                    text_col: str = "text", path: str | None = None) -> tuple[DataFrame, np.ndarray, list[tuple]]:
    """Records with shard and place, the slot map and its edits.  The law kept is near-equal bytes.

    The map is stored at ``path`` (a new folder below the shared one if
    None).  Null texts and ids, empty and very long texts, ids that repeat and
    repeated rows are records like others; an empty table gives no rows and
    the unedited map.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/lapline-slot-map-{uuid.uuid4().hex}"
    records = cut(sized_records(docs, slots, id_col, text_col))
    create_map(spark, path, slots, shards)
    slot_map, edits = rebalance_stored(spark, path, slot_bytes(records), shards)
    return assign(records, path), slot_map, edits


def map_table(spark: SparkSession, slot_map: np.ndarray, edits: list[tuple], slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """The versioned map as a table: (version, virtual_slot, shard), version 0 whole and every later one by its edit."""
    rows = [(0, i, int(x)) for i, x in enumerate(first_map(slots, shards))]
    return spark.createDataFrame([*rows, *((v, s, to) for v, s, _, to in edits)], MAP_SCHEMA)
