"""Sharding by bytes (operator 9, native).

Rows in doc_id order get their global byte prefix sum from the totals of the
range partitions; the sum is cut at equal targets, so shards are contiguous and
their sizes differ by less than one row.

Definitions: a null text has no bytes and the checksum 0; a null doc_id sorts
first; repeated rows each take a place; rows that tie in (doc_id, size,
checksum) are alike, so which of them comes first does not show. A row lies in
the shard in which its first byte falls. An empty table gives no rows.

At scale only (doc_id, size, checksum) is moved, never the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.prefix import prefix_sums

OVERHEAD = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = prefix_sums(sized, ["doc_id", "size", "text_crc32"], "size")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first().t
    placed = placed.withColumn("shard", F.expr(f"cast(before * {shards}L div {max(total, 1)}L as int)"))
    first = placed.groupBy("shard").agg(F.min("number").alias("first"))  # as many rows as shards
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("number") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
