"""Grouping helpers for skewed data, and small set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspindle.functions.salting import salt_number
from adspindle.sources.workspace import Workspace


def salted_count(df: DataFrame, key: str, *row_key: str, n: int = 10) -> DataFrame:
    """Rows per key in two steps: by (salt, key), then by key.

    A plain count already has a map-side partial; the two steps show the pattern for aggregates
    that have none.
    """
    salt = salt_number(n, *[F.col(c) for c in row_key or [key]], by_partition=True)
    parts = df.groupBy(salt.alias("salt"), key).agg(F.count(F.lit(1)).alias("part"))
    return parts.groupBy(key).agg(F.sum("part").alias("num"))


def distinct_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, values)``: exactly how many different values each key has; nulls are none.

    First the pairs are made distinct, shuffled by both, so a hot key's values are spread over all tasks; then
    what is left is counted per key, a number per task and key. No set of a key is ever in one place.
    """
    pairs = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.lit(1).alias("__one"))
    found = pairs.groupBy(key).agg(F.count("__one").alias("values"))
    # Keys with nothing but nulls.
    every = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    same = every[key].eqNullSafe(found[key])
    return every.join(found, same, "left").select(every[key], F.coalesce(found["values"], F.lit(0)).alias("values"))


def quantiles_per_key(
    df: DataFrame, key: str, value: str, quantiles: Sequence[float], workspace: Workspace
) -> DataFrame:
    """``(key, quantile, value)``: the least value that the given share of the key's rows does not exceed, exactly.

    Nulls are left out, and keys without any other value. Equal values are counted first, then put in one
    order over all tasks by a range partitioning, which cuts a hot key where it has to. The counts of
    each task's share of a key tell in which share a quantile lies, and only that share is looked through.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = counted.repartitionByRange(key, value).withColumn("__part", F.spark_partition_id())
    # Written, so that shares are the same when they are summed up and when they are looked through.
    placed, _ = workspace.save(placed, "quantile-shares")
    shares = placed.groupBy(key, "__part").agg(F.sum("__n").alias("__share"))
    # As many rows per key as tasks have some of it.
    whole = Window.partitionBy(key)
    so_far = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumns(
        {"__before": F.coalesce(F.sum("__share").over(so_far), F.lit(0)), "__all": F.sum("__share").over(whole)}
    )
    each = F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile")
    wanted = shares.select("*", each).withColumn("__rank", F.greatest(F.ceil(F.col("quantile") * F.col("__all")), F.lit(1)))
    within = (F.col("__rank") > F.col("__before")) & (F.col("__rank") <= F.col("__before") + F.col("__share"))
    wanted = wanted.where(within).select(
        F.col(key).alias("__key"), F.col("__part").alias("__in"), "quantile", (F.col("__rank") - F.col("__before")).alias("__rank")
    )
    upto = Window.partitionBy(key, "__part").orderBy(value)
    ranked = placed.withColumn("__upto", F.sum("__n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    here = ranked[key].eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__in"))
    here = here & (F.col("__rank") <= F.col("__upto")) & (F.col("__rank") > F.col("__upto") - F.col("__n"))
    return ranked.join(wanted, here).select(key, "quantile", value)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all(first, *others).distinct()


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition of the frame as it is laid out now."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
