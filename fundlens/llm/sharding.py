"""Contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fundlens.llm.common import only, text_or_empty
from fundlens.session import cut_lineage

SHARDS = 16


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): shards are runs of documents in the order of doc_id.

    A document counts its UTF-8 bytes and one more. Documents are ranged by doc_id;
    the ranges' totals are summed in order, and a document goes to the shard in
    whose equal share of all bytes its middle byte lies, so a shard is off by at most
    one document at either end. A null text has no bytes; null ids come first;
    repeated rows take neighbouring slots; no rows give no shards.
    """
    text = text_or_empty()
    size = (F.octet_length(text) + 1).cast("long")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    keys = ["doc_id", "size", "text_crc32"]
    ranged = narrow.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    ranged = cut_lineage(ranged, "ranges")

    # One row per range, and one per shard: both stay small.
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(whole).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy(*keys)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("_end", F.sum("size").over(running))
        .withColumn("_row", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_row", F.col("_row") + F.col("_rows_before"))
    )
    middle = (F.col("_bytes_before") + F.col("_end")) * 2 - F.col("size")
    share = F.expr(f"({shards} * cast(_middle as decimal(38,0))) div (2 * cast(_all as decimal(38,0)))")
    placed = placed.withColumn("_middle", middle).withColumn("shard", F.least(share.cast("int"), F.lit(shards - 1)))
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    slot = (F.col("_row") - F.col("_first")).cast("long").alias("slot")
    return only(placed.join(F.broadcast(firsts), "shard").withColumn("slot", slot), *keys, "shard", "slot")
