"""Contiguous shards of nearly equal bytes, from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspindle.llm.prefix import numbered, totals_before
from adspindle.sources.workspace import Workspace

OVERHEAD = 8


def shard_by_bytes(docs: DataFrame, shards: int, workspace: Workspace) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row; shards are runs of the order by doc_id.

    A row's size is its text's UTF-8 bytes plus 8. Partitions of the ordered table are summed up, the
    sums of all earlier partitions and rows give each row's place in the whole, and a row belongs to
    the shard in whose equal share of all bytes its middle lies. So a shard differs from the others by
    about one row at most, and only a row larger than a share can leave a shard empty.

    Rows with one doc_id follow each other by text, equal rows by where they were read. A null
    doc_id comes first; a null text counts as empty. An empty table gives no rows. Only ``doc_id``
    and ``text`` are read, so further columns may have any name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("__read"),
    )
    narrow, _ = workspace.save(narrow, "sizes")
    ordered = numbered(narrow, ["doc_id", "text_crc32", "size", "__read"], workspace, "ordered")
    placed = totals_before(ordered, [], {"__bytes": F.col("size"), "__rows": F.lit(1)}, workspace)
    total = ordered.agg(F.sum("size")).first()[0] or 1
    # Twice the middle, so that it is a whole number; a decimal, since it is multiplied by the shards.
    middle = (2 * F.col("__bytes") + F.col("size")).cast("decimal(38,0)")
    placed = placed.withColumn("shard", F.floor(middle * shards / F.lit(2 * total)).cast("int"))
    first = placed.groupBy("shard").agg(F.min("__rows").alias("__first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("__rows") - F.col("__first")).alias("slot")
    )
