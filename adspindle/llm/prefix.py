"""Running totals over a whole table, from the totals of its partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspindle.sources.workspace import Workspace

PART, POSITION = "__part", "__position"


def numbered(df: DataFrame, order: Sequence[str], workspace: Workspace, name: str) -> DataFrame:
    """The table in one global order, written, with the partition and position of each row.

    ``order`` must tell all rows apart, or a group of equal rows would have to stay in one partition.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = sorted_rows.withColumns(
        {PART: F.spark_partition_id(), POSITION: F.monotonically_increasing_id()}
    )
    return workspace.save(placed, name)[0]


def totals_before(
    df: DataFrame, group: Sequence[str], values: dict[str, Column], workspace: Workspace
) -> DataFrame:
    """Rows of ``numbered`` with the sum of each value over all earlier rows of their group.

    Partitions are summed up first; only those sums, one row for each partition and group, are put
    in a row. Within a partition the rows are summed by a window whose groups end with the partition.
    """
    sums = df.groupBy(PART, *group).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    keys = [PART, *group]
    base = sums.select(
        *[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__base_{n}") for n in values],
    )
    # Written, so that its size is known when the join is planned.
    base, _ = workspace.save(base, "sums")
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    inside = Window.partitionBy(*keys).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    joined = own.join(base, same, "inner")
    joined = joined.withColumns({n: F.col(n) + F.col(f"__base_{n}") for n in values})
    return joined.drop(*[f"__key{i}" for i in range(len(keys))], *[f"__base_{n}" for n in values])
