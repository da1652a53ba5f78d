"""Row filters and the full projection of the daily log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.functions.text import not_blank
from adspindle.schema import ID_COLUMNS, ODS_COLUMNS


def ods_projection(log: DataFrame) -> DataFrame:
    """The 89 columns of the daily table from a log with ``region`` and ``city`` looked up."""
    named = {"provincename": F.col("region"), "cityname": F.col("city")}
    return log.select(*[named.get(c, F.col(c)).alias(c) for c in ODS_COLUMNS])


def has_identifier(columns: list[str] = ID_COLUMNS) -> Column:
    return reduce(lambda a, b: a | b, [not_blank(F.col(c)) for c in columns])


def with_identifier(df: DataFrame) -> DataFrame:
    return df.where(has_identifier())


def with_location(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["longitude", "latitude"])


def nonempty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != "")


def with_join_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key can match: neither null nor empty."""
    return df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))


def split_by_key(df: DataFrame, key: str, values: list) -> tuple[DataFrame, DataFrame]:
    """Rows with one of the key values, and all the others, null keys included."""
    hot = F.coalesce(F.col(key).isin(values), F.lit(False))
    return df.where(hot), df.where(~hot)
