"""Two-column text dictionaries, one ``key##value`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "##"

# Internal codes of client types, network kinds and carriers.
DEVICE_CODES = [
    ("1", "D00010001"),
    ("2", "D00010002"),
    ("3", "D00010003"),
    ("4", "D00010004"),
    ("WIFI", "D00020001"),
    ("4G", "D00020002"),
    ("3G", "D00020003"),
    ("2G", "D00020004"),
    ("NETWORKOTHER", "D00020005"),
    ("移动", "D00030001"),
    ("联通", "D00030002"),
    ("电信", "D00030003"),
    ("OPERATOROTHER", "D00030004"),
]


def device_dictionary(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{key}', '{value}')" for key, value in DEVICE_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(key, value)")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(key, value)``: first and last piece of each line, the last line of a repeated key wins.

    A line whose pieces are all empty has no key and is left out; one without a second piece
    stands for itself.
    """
    pieces = F.split("line", SEPARATOR)
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("at"),
    )
    entries = lines.select(
        pieces[0].alias("key"),
        F.try_element_at(F.filter(pieces, lambda p: p != ""), F.lit(-1)).alias("value"),
        "at",
    ).where("value is not null")
    return entries.groupBy("key").agg(F.max_by("value", "at").alias("value"))
