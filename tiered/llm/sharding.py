"""Balanced contiguous shards from global prefix sums of byte sizes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiered.llm import shared


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one; a null text has no bytes."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def shard_by_bytes(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Cuts the rows, in order of `key`, into `shards` runs of nearly equal bytes.

    Rows are dealt by range of the key; each part's bytes give, by a prefix sum over the
    few part totals, the global offset of each row, and a row belongs to the shard in which
    its middle byte lies. No shard is off its target by more than one row's size. Returns
    key, size, text_crc32, shard, slot (place in the shard from 0, in key order).

    Null keys sort first; a null text has size 1. Repeated rows stay separate rows, in any
    order among themselves. More shards than rows leave shards empty. An empty table gives
    no rows. Other columns are not read.
    """
    slim = docs.select(
        F.col(key).alias("key"),
        byte_size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    parts = shared.staged(
        slim.repartitionByRange("key", "tie").withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    # One row a part: ordering them in one task is bounded by the number of partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes")).select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy("key", "tie")
    start = F.col("base") + F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("size")
    # Whole numbers, exact up to 2 ** 62 / shards bytes.
    target = F.expr(f"((2 * start + size) * {int(shards)}) div (2 * total)")
    placed = (
        parts.join(F.broadcast(totals), "part")
        .withColumn("start", start)
        .withColumn("shard", target.cast("int"))
    )
    counts = placed.groupBy("part", "shard").agg(F.count("*").alias("rows"))
    first = Window.partitionBy("shard").orderBy("part")
    bases = counts.select(
        "part", "shard",
        (F.sum("rows").over(first) - F.col("rows")).alias("first_slot"),
    )
    place = F.row_number().over(Window.partitionBy("part", "shard").orderBy("key", "tie"))
    # At most one row for each part and each cut: bounded by parts + shards.
    return placed.join(F.broadcast(bases), ["part", "shard"]).select(
        F.col("key").alias(key), "size", "text_crc32", "shard",
        (F.col("first_slot") + place - 1).cast("long").alias("slot"),
    )
