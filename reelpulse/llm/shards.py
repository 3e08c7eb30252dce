"""Sharding through fixed virtual slots.

Every record hashes into one of a few thousand slots; a slot belongs to one
shard, and the slot-to-shard map is a small versioned table.  Rebalancing reads
the bytes per slot and edits the map: it walks the slots from the largest to the
smallest and leaves a slot where it is while its shard stays within its even
part of the bytes, or else moves it to the least loaded shard.  Records never
change their slot, so an edit moves only the records of edited slots.

The map has one row per slot, a fixed number; only it is folded in one row.

Defined results: null text counts 0 bytes (plus one per record); records with a
null id hash by their text; every input row gets one row, repeated rows too;
an empty table gives an empty result and an unedited map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelpulse.llm.common import hash32, stored

SLOTS = 4096
#: Slots that one step of the outer fold handles.
RUN = 64


def slot_of(id_col: Column, text: Column, slots: int = SLOTS) -> Column:
    key = F.coalesce(id_col.cast("string"), F.concat(F.lit("text|"), F.md5(text)), F.lit("null"))
    return (hash32(key) % slots).cast("int")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: equal runs of slots, before any size is known."""
    return spark.range(0, slots, 1, 1).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("vslot"),
        F.floor(F.col("id") * shards / slots).cast("int").alias("shard"))


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and rows per slot of (vslot, size) records."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def rebalanced(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of ``slot_map`` for ``shards`` shards.

    ``sizes`` has (vslot, bytes, rows).  One row per slot goes in and out; the
    walk over the slots is a fold of one array of that fixed length.
    """
    filled = slot_map.join(sizes, "vslot", "left").select(
        "version", "vslot", "shard",
        F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("rows", F.lit(0)).alias("rows"))
    listed = filled.groupBy().agg(
        (F.max("version") + 1).alias("version"), F.sum("bytes").alias("total"),
        F.sort_array(F.collect_list(F.struct(
            (-F.col("bytes")).alias("order"), "vslot", "shard", "bytes", "rows"))).alias("todo"))
    nothing = F.array().cast("array<struct<vslot:int,shard:int,bytes:bigint,rows:bigint>>")
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"), nothing.alias("done"))

    def step(acc, slot):
        least = (F.array_position(acc.load, F.array_min(acc.load)) - 1).cast("int")
        stays = (slot.shard < shards) & ((F.get(acc.load, slot.shard) + slot.bytes) * shards <= F.col("total"))
        to = F.when(stays, slot.shard).otherwise(least)
        return F.struct(
            F.transform(acc.load, lambda v, i: F.when(i == to, v + slot.bytes).otherwise(v)).alias("load"),
            F.concat(acc.done, F.array(F.struct(
                slot.vslot.alias("vslot"), to.alias("shard"),
                slot.bytes.alias("bytes"), slot.rows.alias("rows")))).alias("done"))

    def run_of_slots(acc, slots):  # runs keep the growing array from being copied for every slot
        return F.aggregate(slots, F.struct(acc.load.alias("load"), nothing.alias("done")), step,
                           lambda made: F.struct(made.load.alias("load"), F.concat(acc.done, made.done).alias("done")))

    listed = listed.withColumn("todo", F.transform(
        F.sequence(F.lit(0), F.ceil(F.size("todo") / RUN).cast("int") - 1), lambda i: F.slice("todo", i * RUN + 1, RUN)))
    folded = listed.select("version", F.aggregate("todo", start, run_of_slots, lambda acc: acc.done).alias("done"))
    return folded.select("version", F.explode("done").alias("s")).select("version", "s.*")


def balanced_map(records: DataFrame, shards: int) -> DataFrame:
    """Both versions of the map for ``records`` (vslot, size), stored; columns
    version, vslot, shard, bytes, rows."""
    spark = records.sparkSession
    sizes = stored(slot_bytes(records), "slot_bytes")
    zero = first_map(spark, shards)
    old = zero.join(sizes, "vslot", "left").select(
        "version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.coalesce("rows", F.lit(0)).alias("rows"))
    return stored(old.unionByName(rebalanced(zero, sizes, shards)), "slot_map")


def latest(slot_map: DataFrame) -> DataFrame:
    """The rows of the newest version."""
    newest = slot_map.agg(F.max("version").alias("version"))
    return slot_map.join(F.broadcast(newest), "version").drop("version")  # one row


def sharded_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns, virtual_slot and shard (an input column
    of the same name is replaced).  No shuffle: the map has a fixed number of
    rows and is broadcast."""
    own = [c for c in docs.columns if c not in ("virtual_slot", "shard")]
    slot = slot_of(F.col(id_col), F.col(text_col))
    records = docs.select(slot.alias("vslot"), record_bytes(F.col(text_col)).alias("size"))
    newest = latest(balanced_map(records, shards)).select("vslot", "shard")
    return (docs.select(F.struct(*own).alias("row"), slot.alias("vslot"))
            .join(F.broadcast(newest), "vslot")  # SLOTS rows
            .select("row.*", F.col("vslot").alias("virtual_slot"), "shard"))


def op5_virtual_slots(spark, sf_dir: str, shards: int = 8) -> DataFrame:
    """All documents in eight shards of near-equal bytes.

    ``slot`` numbers the rows of a shard from 0 without gaps: the rows before
    the record's virtual slot in its shard, from the map, plus its place inside
    the virtual slot.  ``virtual_slot`` is the hashed one.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    records = docs.select(
        F.col("doc_id"), record_bytes(F.col("text")).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), F.col("text")).alias("vslot"))
    before = Window.partitionBy("shard").orderBy("vslot")
    newest = latest(balanced_map(records, shards)).withColumn(
        "first", F.sum("rows").over(before) - F.col("rows")).select("vslot", "shard", "first")
    place = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (records.withColumn("i", F.row_number().over(place) - 1)
            .join(F.broadcast(newest), "vslot")  # SLOTS rows
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("i")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"),
                    F.col("vslot").alias("virtual_slot")))
