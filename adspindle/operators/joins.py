"""Equi joins that stay balanced: checked broadcast, salted hot keys, keyless rows kept out.

Which keys are hot is only a matter of speed. Every way of joining here gives the rows that the
plain join gives, duplicates included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspindle.sources.workspace import Workspace

# A table is sent whole to every executor only if its measured content is at most this. All of them pass through
# the driver, several in one job, and rows of short values take a multiple of their content there.
BROADCAST_BYTES = 16 * 1024 * 1024
# Past this multiple of the limit the optimizer's own estimate settles it without a measuring job,
# unless the estimate only says that nothing is known about a source.
ESTIMATE_MARGIN = 64
NO_ESTIMATE = 2**60

SALT, SALTS = "__salt", "__salts"


def content_bytes(df: DataFrame) -> Column:
    """Size of a row's values: texts by their length, nested values as JSON, the others 8 bytes."""

    def of(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 8
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(column)))
        return F.lit(8)

    return sum((of(f) for f in df.schema.fields), F.lit(0))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the table's content, measured in one distributed pass, is within ``limit`` bytes."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if limit * ESTIMATE_MARGIN < estimate < NO_ESTIMATE:
        return False
    return (df.agg(F.sum(content_bytes(df))).first()[0] or 0) <= limit


def key_counts(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys with at least ``min_rows`` rows, counted exactly."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") >= min_rows)
    )


# A key is hot when its rows make up more than this many mean shuffle partitions.
HOT_PARTITIONS = 4
# Below so many rows no key is worth spreading.
HOT_ROWS = 100_000
# The sketch tracks this many counters per key that it may have to name.
SKETCH_COUNTERS = 16


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_key_sketch(spark: SparkSession, key: str) -> Column:
    """An aggregate of fixed size that holds every key that can be hot.

    There are fewer such keys than shuffle partitions. It can ride along with any pass over the data.
    """
    most = max(8, min(shuffle_partitions(spark), 50_000))
    return F.expr(f"approx_top_k({key}, {most}, {most * SKETCH_COUNTERS})")


def hot_keys_of_sketch(
    spark: SparkSession, sketch: list | None, rows: int, min_rows: int = HOT_ROWS
) -> dict[object, int]:
    """Hot keys and how many tasks to spread each over: as many as it fills mean partitions."""
    mean = max(1, rows / shuffle_partitions(spark))
    floor = max(HOT_PARTITIONS * mean, min_rows)
    found = [(e["item"], e["count"]) for e in sketch or [] if e["item"] is not None]
    return {key: max(2, -int(-n // mean)) for key, n in found if n >= floor}


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> dict[object, int]:
    """Keys of more rows than a few shuffle partitions hold, with the number of tasks to spread each over."""
    spark = df.sparkSession
    seen = df.agg(F.count(F.lit(1)).alias("rows"), hot_key_sketch(spark, key).alias("sketch")).first()
    return hot_keys_of_sketch(spark, seen["sketch"], seen["rows"], min_rows)


def _spread_number(left: DataFrame, spread: Sequence[str] | None) -> Column:
    """A number that differs from row to row, from the named columns or from the row's place in its partition."""
    if spread is None:
        return F.xxhash64(F.monotonically_increasing_id())
    return F.xxhash64(*[F.col(c) for c in spread], F.spark_partition_id())


def replicate(df: DataFrame, n: int, column: str = SALT) -> DataFrame:
    """``n`` copies of each row, numbered from 0 in ``column``."""
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    hot: Sequence | Mapping[object, int],
    salts: int | None = None,
    how: str = "left",
    null_keys: bool = True,
    spread: Sequence[str] | None = None,
    merge: bool = False,
) -> DataFrame:
    """Left or inner join in one pass over each side, each hot key spread over several tasks.

    ``hot`` maps keys to their number of salts; for a plain list it is ``salts``, or the number of
    shuffle partitions. Left rows of a hot key get one of its salts, right rows of it one copy per
    salt; all other rows carry salt 0. Left rows with a null key match nothing and are spread over all
    partitions; with ``null_keys=False`` the caller knows that there are none.

    The salt comes from the row's place in its partition, so no further column is read for it. That
    place is the same on every attempt where the left side is read from stored files. Above a shuffle
    it may not be; then the caller names columns in ``spread`` to take it from. With ``merge`` the right side is
    known to be large, and is not broadcast whatever the optimizer makes of its compressed files.
    """
    if how not in ("left", "inner"):
        raise ValueError("salting the left side fits left and inner joins only")
    if how == "inner" and null_keys:
        left, null_keys = left.where(F.col(on).isNotNull()), False
    right = right.where(F.col(on).isNotNull())
    if not hot and not null_keys:
        return left.join(right.hint("merge") if merge else right, on, how)
    spark = left.sparkSession
    everywhere = shuffle_partitions(spark)
    counts = dict(hot) if isinstance(hot, Mapping) else dict.fromkeys(hot, salts or everywhere)
    key_type = left.schema[on].dataType
    if counts:
        # Fewer rows than shuffle partitions.
        fields = [T.StructField(on, key_type), T.StructField(SALTS, T.IntegerType())]
        table = F.broadcast(spark.createDataFrame(list(counts.items()), T.StructType(fields)))
        left, right = left.join(table, on, "left"), right.join(table, on, "left")
    else:
        left, right = (df.withColumn(SALTS, F.lit(None).cast("int")) for df in (left, right))
    of = F.when(F.col(on).isNull(), F.lit(everywhere)).otherwise(F.coalesce(SALTS, F.lit(1)))
    number = F.when(of > 1, F.pmod(_spread_number(left, spread), of.cast("bigint")).cast("int")).otherwise(F.lit(0))
    salted = left.withColumn(SALT, number).drop(SALTS)
    # Also salt 0 alone comes from a generator: as a literal it would be folded out of the join key.
    last = F.coalesce(F.col(SALTS), F.lit(1)) - 1
    copies = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), last))).drop(SALTS)
    return salted.join(copies.hint("merge") if merge else copies, [on, SALT], how).drop(SALT)


def gather(df: DataFrame, key: str, hot: Mapping[object, int]) -> DataFrame:
    """Rows of one key brought together in one task, those of a hot key dealt to as many tasks as ``hot`` says.

    Without hot keys what is grouped by the key, alone or with others, is not shuffled again. The salt is taken
    from the row's values, since rows may come from a shuffle.
    """
    if not hot:
        return df.repartition(key)
    fields = [T.StructField(key, df.schema[key].dataType), T.StructField(SALTS, T.IntegerType())]
    # Fewer rows than shuffle partitions.
    table = F.broadcast(df.sparkSession.createDataFrame(list(hot.items()), T.StructType(fields)))
    of = F.coalesce(SALTS, F.lit(1))
    number = F.when(of > 1, F.pmod(_spread_number(df, df.columns), of.cast("bigint"))).otherwise(F.lit(0))
    return df.join(table, key, "left").withColumn(SALT, number).repartition(key, SALT).drop(SALT, SALTS)


def used_keys(df: DataFrame, key: Column, table: DataFrame, on: str) -> DataFrame:
    """The rows of a table that a column of another one asks for; a join with them is the join with the table."""
    return table.join(df.select(key.alias(on)).distinct(), on, "left_semi")


def skew_join_full_salt(
    left: DataFrame,
    right: DataFrame,
    on: str,
    salts: int = 10,
    how: str = "left",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """For many hot keys against an even table: salt all of the left, copy all of the right.

    The copies are shuffled: the optimizer's estimate is of one copy of compressed files, and a right side that is
    small enough to be broadcast needs no salts.
    """
    number = F.pmod(_spread_number(left, spread), F.lit(salts).cast("bigint")).cast("int")
    return left.withColumn(SALT, number).join(replicate(right, salts).hint("merge"), [on, SALT], how).drop(SALT)


def measured(df: DataFrame, workspace: Workspace, name: str) -> tuple[DataFrame, int]:
    """The table written once, and the size of its content, taken during the write.

    A table that is going to be joined is computed once so, not once to be measured and once again.
    """
    table, seen = workspace.save(df, name, content=F.sum(content_bytes(df)))
    return table, seen.get("content") or 0


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: Sequence | Mapping[object, int] | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """Big table against a table that is usually small.

    Within the size limit the right side is broadcast and the left is not shuffled at all. Beyond
    it the left's hot keys are looked up and the join is shuffled with those keys spread. A caller
    that has already measured the right side, or knows the hot keys, passes what it found; one whose
    left side has no null keys says so.
    """
    if small is None:
        small = fits_broadcast(right, limit)
    if small:
        return left.join(F.broadcast(right), on, how)
    if hot is None:
        hot = hot_keys(left, on, min_rows)
    return skew_join(left, right, on, hot, how=how, null_keys=null_keys, merge=True)


# A grid sends at most this many times the rows of a key; more cells need a higher value.
GRID_COPIES = 2.0


def grid_shape(left_rows: int, right_rows: int, cells: int, copies: float = GRID_COPIES) -> tuple[int, int]:
    """Into how many rows and columns of a grid a key's left and right rows are dealt.

    Each left row is sent to every column, each right row to every row: left * columns + right * rows in all,
    which stays within ``copies`` times the rows there are. Of these shapes one with about the most cells, up
    to ``cells``; both sides get parts of about the same size.
    """
    budget = copies * (left_rows + right_rows)
    columns = max(1, int(budget / (2 * max(left_rows, 1))))
    columns = min(columns, max(right_rows, 1), cells)
    rows = max(1, int((budget - left_rows * columns) / max(right_rows, 1)))
    rows = min(rows, max(left_rows, 1), max(1, cells // columns))
    # What the left side has left over goes to the columns.
    columns = max(columns, min(int((budget - right_rows * rows) / max(left_rows, 1)), max(right_rows, 1), cells // rows))
    return rows, columns


def grid_shapes(
    left: DataFrame, right: DataFrame, on: str, min_rows: int = HOT_ROWS, copies: float = GRID_COPIES
) -> dict[object, tuple[int, int]]:
    """The grid of every key that is hot on either side, from its exact numbers of rows on both."""
    spark = left.sparkSession
    hot = hot_keys(left, on, min_rows)
    for key, tasks in hot_keys(right, on, min_rows).items():
        hot[key] = hot.get(key, 1) * tasks
    if not hot:
        return {}
    # Fewer keys than both sides have shuffle partitions.
    named = spark.createDataFrame([(k,) for k in hot], T.StructType([T.StructField(on, left.schema[on].dataType)]))
    counts = []
    for side in (left, right):
        counted = side.select(on).join(F.broadcast(named), on).groupBy(on).count().collect()
        counts.append({r[0]: r[1] for r in counted})
    return {k: grid_shape(counts[0].get(k, 0), counts[1].get(k, 0), tasks, copies) for k, tasks in hot.items()}


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    grids: Mapping[object, tuple[int, int]] | None = None,
    how: str = "left",
    min_rows: int = HOT_ROWS,
    spread: tuple[Sequence[str] | None, Sequence[str] | None] | None = None,
) -> DataFrame:
    """Left or inner join for keys that are hot on both sides: each such key is a grid of tasks.

    A left row goes to one row of its key's grid and there to every column, a right row to one column and
    there to every row, so each pair meets once and no task has all of either side. Other keys are joined
    as usual, left rows without a key are spread. ``spread`` names columns of both sides to deal rows by where
    these come from a shuffle (see ``skew_join``).
    """
    if how not in ("left", "inner"):
        raise ValueError("a grid fits left and inner joins only")
    spark = left.sparkSession
    right = right.where(F.col(on).isNotNull())
    if grids is None:
        grids = grid_shapes(left, right, on, min_rows)
    if how == "inner":
        left = left.where(F.col(on).isNotNull())
    fields = [T.StructField(on, left.schema[on].dataType)]
    fields += [T.StructField(c, T.IntegerType()) for c in ("__rows", "__columns")]
    # As few rows as there are hot keys.
    table = F.broadcast(spark.createDataFrame([(k, *shape) for k, shape in grids.items()], T.StructType(fields)))
    numbers = [_spread_number(side, names) for side, names in zip((left, right), spread or (None, None))]

    def dealt(n: Column, number: Column) -> Column:
        return F.when(n > 1, F.pmod(number, n.cast("bigint")).cast("int")).otherwise(F.lit(0))

    everywhere = F.when(F.col(on).isNull(), F.lit(shuffle_partitions(spark)))
    rows, columns = F.coalesce("__rows", everywhere, F.lit(1)), F.coalesce("__columns", F.lit(1))
    placed = left.join(table, on, "left").withColumn("__row", dealt(rows, numbers[0])).withColumn("__many", columns > 1)
    placed = placed.withColumn("__column", F.explode(F.sequence(F.lit(0), columns - 1))).drop("__rows", "__columns")
    copied = right.join(table, on, "left").withColumn("__column", dealt(F.coalesce("__columns", F.lit(1)), numbers[1]))
    copied = copied.withColumn("__row", F.explode(F.sequence(F.lit(0), F.coalesce("__rows", F.lit(1)) - 1)))
    copied = copied.drop("__rows", "__columns").withColumn("__met", F.lit(True))
    joined = placed.join(copied, [on, "__row", "__column"], how)
    if how == "left":
        # Of a key with several columns the right side has rows; a column without any adds nothing.
        joined = joined.where(F.col("__met") | ~F.col("__many"))
    return joined.drop("__row", "__column", "__many", "__met")


# The number of the slice that a total is of, a column that outlives the totals' shuffle.
SLICE = "__slice"


def totals_in_slices(df: DataFrame, on: str, slices: int, *totals: Column) -> DataFrame:
    """Totals per key, those of a key with many rows in up to ``slices`` rows, each of other rows of the key.

    For a join whose pairs are only going to be counted or summed up: a row that met every row of a hot key
    meets its few totals instead, so the work grows with the rows and not with the pairs. The totals must be such that
    those of slices add up to those of the key: counts, sums, least, greatest.
    """
    number = F.pmod(_spread_number(df, None), F.lit(slices).cast("bigint")).cast("int")
    return df.withColumn(SLICE, number).groupBy(on, SLICE).agg(*totals)


# Bits of the filter of a table's keys: 16 MiB, whatever the table's size. More keys make it let more rows through.
KEY_BITS = 2**27
# Where the number of keys is known, so many bits per key, up to 128 MiB in all.
BITS_PER_KEY, MOST_BITS = 16, 2**30
_BITMAP_BITS = 8 * 4096


def key_bits(keys: int) -> int:
    """Bits for a filter of so many keys, a power of two."""
    return min(MOST_BITS, max(_BITMAP_BITS, 1 << (BITS_PER_KEY * max(keys, 1) - 1).bit_length()))


def key_filter(df: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """``(__part, __bits)``: a bitmap of the hashes of all keys, in at most ``bits`` / 32768 rows of 4 KiB.

    One aggregate whose tasks send no more than the bitmap itself.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    known = df.where(F.col(key).isNotNull()).select(place.alias("__place"))
    part = F.expr(f"__place div {_BITMAP_BITS}").alias("__part")
    position = F.col("__place") % _BITMAP_BITS
    return known.groupBy(part).agg(F.bitmap_construct_agg(position).alias("__bits"))


def with_possible_match(df: DataFrame, key: str, known: DataFrame, name: str, bits: int = KEY_BITS) -> DataFrame:
    """``df`` with whether the row's key may be among those of a ``key_filter``; a key that is there always may."""
    asked = df.withColumn("__place", F.pmod(F.xxhash64(key), F.lit(bits)))
    # Bounded by ``bits``, not by the table.
    joined = asked.join(F.broadcast(known), F.expr(f"__place div {_BITMAP_BITS}") == F.col("__part"), "left")
    byte = F.expr(f"substring(__bits, cast(__place % {_BITMAP_BITS} div 8 as int) + 1, 1)")
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("__place") % 8).cast("int")) == 1
    may = F.coalesce(hit & F.col(key).isNotNull(), F.lit(False))
    return joined.withColumn(name, may).drop("__place", "__part", "__bits")


def filtered_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    bits: int = KEY_BITS,
    min_rows: int = HOT_ROWS,
    hot: Sequence | Mapping[object, int] | None = None,
) -> DataFrame:
    """Left join of two large tables in which many left rows match nothing: these go round the shuffle.

    A bitmap of the right keys tells which left rows can match; only they are shuffled, with hot keys spread.
    The others, rows without a key among them, get nulls where they are. The left side is scanned twice.
    """
    known = key_filter(right, on, bits)
    asked = with_possible_match(left, on, known, "__may", bits)
    may, none = asked.where("__may").drop("__may"), asked.where("NOT __may").drop("__may")
    if hot is None:
        hot = hot_keys(may, on, min_rows)
    met = skew_join(may, right, on, hot, null_keys=False)
    added = {f.name: F.lit(None).cast(f.dataType) for f in right.schema.fields if f.name != on}
    return met.unionByName(none.withColumns(added) if added else none)


def null_safe_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    blank_is_null: bool = False,
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join whose rows without a partner are not shuffled: keyless ones, and keys the right side doesn't have.

    Empty-text keys are keyless too only with ``blank_is_null``, since the right side may hold one.
    The key column comes out as it went in. A right side within the limit is broadcast and nothing is
    shuffled; beyond it see ``filtered_left_join``.
    """

    def joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        if fits_broadcast(right, limit):
            return left.join(F.broadcast(right), key, "left")
        return filtered_left_join(left, right, key, min_rows=min_rows)

    if not blank_is_null:
        return joined(left, right, on)
    key = "__" + on
    keyed = left.withColumn(key, F.when(F.col(on) != "", F.col(on)))
    return joined(keyed, right.withColumnRenamed(on, key), key).drop(key)
