"""One person, many identifiers: connected components of the identifier graph."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adspindle.functions.text import not_blank
from adspindle.operators.joins import (
    BROADCAST_BYTES,
    HOT_PARTITIONS,
    HOT_ROWS,
    fits_broadcast,
    hot_key_sketch,
    hot_keys_of_sketch,
    lookup_join,
    measured,
    shuffle_partitions,
    skew_join,
)
from adspindle.schema import ID_COLUMNS
from adspindle.sources.workspace import Workspace, observed


def identity_ids(columns: Sequence[str] = ID_COLUMNS) -> Column:
    """The row's identifiers that are not blank, in fixed order."""
    return F.array_compact(F.array(*[F.when(not_blank(F.col(c)), F.col(c)) for c in columns]))


def first_id(columns: Sequence[str] = ID_COLUMNS) -> Column:
    """The first of them, which stands for the row's user until users are resolved."""
    return F.coalesce(*[F.when(not_blank(F.col(c)), F.col(c)) for c in columns])


def identity_pairs(records: DataFrame) -> DataFrame:
    """Distinct ``(userid, id)`` of records ``(userid, ids)``."""
    # The outer form is not preceded by a test for empty lists that would build them twice.
    listed = records.select("userid", F.explode_outer("ids").alias("id"))
    return listed.where("id IS NOT NULL").distinct()


def counted_pairs(records: DataFrame) -> DataFrame:
    """The same pairs with ``rows``, the number of records that hold them."""
    listed = records.select("userid", F.explode_outer("ids").alias("id"))
    return listed.where("id IS NOT NULL").groupBy("userid", "id").agg(F.count(F.lit(1)).alias("rows"))


def identity_edges(pairs: DataFrame) -> DataFrame:
    """The pairs that link two different identifiers, as ``(u, v)``."""
    return pairs.where("userid <> id").select(F.col("userid").alias("u"), F.col("id").alias("v"))


def _large_star(links: DataFrame, hot_low: Mapping) -> DataFrame:
    """Hang every vertex on the lowest neighbour of the vertex below it."""
    lowest = links.groupBy(F.col("high").alias("low")).agg(F.min("low").alias("lowest"))
    joined = skew_join(links, lowest, "low", hot_low, how="left", null_keys=False, spread=["high"])
    return joined.select("high", F.coalesce("lowest", "low").alias("low"))


def _small_star(links: DataFrame, hot_high: Mapping) -> DataFrame:
    """Hang every vertex's lower neighbours, and the vertex itself, on the lowest of them."""
    # Without hot vertices one shuffle by vertex serves duplicates, minimum and join alike.
    links = (links if hot_high else links.repartition("high")).distinct()
    lowest = links.groupBy("high").agg(F.min("low").alias("lowest"))
    joined = skew_join(links, lowest, "high", hot_high, how="inner", null_keys=False, spread=["low"])
    moved = F.when(F.col("low") == F.col("lowest"), F.col("high")).otherwise(F.col("low"))
    return joined.select(moved.alias("high"), F.col("lowest").alias("low")).distinct()


def number_ids(ids: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """Distinct identifiers with 64-bit numbers in the identifiers' order, as a written table.

    Numbers make every later shuffle a fraction of the size, and their minimum is a hash
    aggregate where that of a text is a sort. The order comes from a range partitioning.
    """
    ordered = ids.select("id").distinct().sort("id")
    numbered, _ = workspace.save(
        ordered.withColumn("number", F.monotonically_increasing_id()), name
    )
    return numbered


def _swap(df: DataFrame, column: str, numbers: DataFrame, of: str, to: str, hot: Mapping) -> DataFrame:
    """Replace ``column``, an ``of``, by the matching ``to`` of the number table."""
    table = numbers.select(F.col(of).alias(column), F.col(to).alias("__to"))
    joined = skew_join(df, table, column, hot, how="inner", null_keys=False, spread=df.columns)
    return joined.drop(column).withColumnRenamed("__to", column)


def _save_round(links: DataFrame, workspace: Workspace, name: str) -> tuple[DataFrame, dict]:
    return workspace.save(
        links,
        name,
        print=F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")),
        high_sketch=hot_key_sketch(workspace.spark, "high"),
        low_sketch=hot_key_sketch(workspace.spark, "low"),
    )


def connected_components(
    edges: DataFrame, workspace: Workspace, hub_rows: int = HOT_ROWS, name: str = "components"
) -> DataFrame:
    """``(id, component)`` of every vertex that is not the lowest of its component.

    ``edges`` (u, v) are read a few times, so they should come from a stored table.

    Star contraction (alternating large and small stars): each round every vertex moves closer to
    the lowest identifier it can reach, the number of links never grows, and the number of rounds
    is logarithmic. Links are ``high > low`` between the identifiers' numbers. A round is one
    written table; the write also takes its fingerprint, which tells when nothing changes any more,
    and a bounded sketch of its busiest vertices, whose rows the next round's joins spread.
    """
    edges = edges.where("u <> v")
    seen = edges.agg(
        F.count(F.lit(1)).alias("rows"),
        hot_key_sketch(workspace.spark, "u").alias("u_sketch"),
        hot_key_sketch(workspace.spark, "v").alias("v_sketch"),
    ).first()

    def hot(sketch: str) -> Mapping:
        return hot_keys_of_sketch(workspace.spark, seen[sketch], seen["rows"], hub_rows)

    ids = edges.select(F.explode(F.array("u", "v")).alias("id"))
    numbers = number_ids(ids, workspace, f"{name}-ids")
    links = _swap(edges, "u", numbers, "id", "number", hot("u_sketch"))
    links = _swap(links, "v", numbers, "id", "number", hot("v_sketch"))
    links = links.select(F.greatest("u", "v").alias("high"), F.least("u", "v").alias("low"))
    current, seen = _save_round(links, workspace, f"{name}-0")
    number = 0
    while seen["rows"]:
        number += 1
        before = (seen["rows"], seen["print"])
        moved = _small_star(_large_star(current, hot("low_sketch")), hot("high_sketch"))
        current, seen = _save_round(moved, workspace, f"{name}-{number}")
        workspace.drop(f"{name}-{number - 1}")
        if (seen["rows"], seen["print"]) == before:
            break
    found = _swap(current, "high", numbers, "number", "id", {})
    found = _swap(found, "low", numbers, "number", "id", hot("low_sketch"))
    found = found.select(F.col("high").alias("id"), F.col("low").alias("component"))
    return workspace.save(found, name)[0]


def all_components(ids: DataFrame, components: DataFrame) -> DataFrame:
    """``(id, component)`` of every identifier; both sides have each identifier once."""
    found = ids.select("id").join(components, "id", "left")
    return found.withColumn("component", F.coalesce("component", "id"))


def attach_component(
    records: DataFrame,
    components: DataFrame,
    key: str = "userid",
    small: bool | None = None,
    hot: Mapping | None = None,
    **options,
) -> DataFrame:
    """Records with the component of their user; repeated records stay, lone users stand for themselves.

    The records have no null keys.
    """
    known = components.select(F.col("id").alias(key), "component")
    joined = lookup_join(records, known, key, "left", small=small, hot=hot, null_keys=False, **options)
    return joined.withColumn("component", F.coalesce("component", key))


def component_attach_join(
    records: DataFrame, components: DataFrame, key: str = "userid", hot: Mapping | None = None, **options
) -> DataFrame:
    """Inner join of records to a table with the component of every identifier."""
    known = components.select(F.col("id").alias(key), "component")
    return lookup_join(records, known, key, "inner", hot=hot, **options)


@dataclass(frozen=True)
class Users:
    """Resolved users: ``members`` (userid, id), and what it takes to relabel records.

    ``hot`` are the busiest identifiers that stand for users in the records, ``hot_users`` the resolved users with
    too many records for one task, each with the number of tasks that these fill.
    """

    components: DataFrame
    members: DataFrame
    small: bool
    hot: Mapping
    hot_users: Mapping = field(default_factory=dict)

    def relabel(self, df: DataFrame) -> DataFrame:
        """Rows with ``userid`` replaced by the user that it belongs to."""
        attached = attach_component(df, self.components, small=self.small, hot=self.hot)
        return attached.withColumn("userid", F.col("component")).drop("component")


def hot_users(
    pairs: DataFrame, components: DataFrame, rows: int, small: bool, min_rows: int = HOT_ROWS
) -> dict[object, int]:
    """Resolved users with more of all ``rows`` records than a few shuffle partitions hold, from ``counted_pairs``.

    A record's user is among its identifiers, so the pairs of an identifier with itself count the records.
    """
    mean = max(1, rows / shuffle_partitions(pairs.sparkSession))
    floor = max(HOT_PARTITIONS * mean, min_rows)
    if rows < floor:
        return {}
    own = pairs.where("userid = id").select("userid", "rows")
    # Each identifier has one row here, so none of them is hot.
    counted = attach_component(own, components, small=small, hot={})
    counted = counted.groupBy("component").agg(F.sum("rows").alias("rows"))
    # Fewer users than shuffle partitions.
    return {r[0]: max(2, -int(-r[1] // mean)) for r in counted.where(F.col("rows") >= floor).collect()}


def resolve_users(
    records: DataFrame, workspace: Workspace, limit: int = BROADCAST_BYTES, min_rows: int = HOT_ROWS
) -> Users:
    """Users of all records ``(userid, ids)``.

    The pass that collects the identifiers also sketches the busiest of them, whose records
    ``relabel`` will have to spread. A task that runs twice may be sketched twice; that can only
    make a key look hotter than it is. Without any record there is nothing to spread.
    """
    spark = workspace.spark
    seen = Observation()
    watched = records.observe(seen, F.count(F.lit(1)).alias("rows"), hot_key_sketch(spark, "userid").alias("sketch"))
    pairs, _ = workspace.save(counted_pairs(watched), "pairs")
    found = observed(seen)
    components = connected_components(identity_edges(pairs), workspace, min_rows)
    members = all_components(pairs.select("id").distinct(), components)
    small = fits_broadcast(components, limit)
    return Users(
        components,
        members.select(F.col("component").alias("userid"), "id"),
        small,
        hot_keys_of_sketch(spark, found.get("sketch"), found["rows"], min_rows),
        hot_users(pairs, components, found["rows"], small, min_rows),
    )


@dataclass(frozen=True)
class Increment:
    """What a day's records change in a stored table of members.

    ``users`` resolves the day's records. ``touched`` (userid, to) has every stored user that the records meet
    with its user from now on; ``small`` tells whether it may be broadcast. ``members`` are the stored ones under
    their users' names of now, ``fresh`` those that the records add.
    """

    users: Users
    touched: DataFrame
    small: bool
    members: DataFrame
    fresh: DataFrame

    def all_members(self) -> DataFrame:
        return self.members.unionByName(self.fresh)


def resolve_increment(
    records: DataFrame,
    stored: DataFrame,
    workspace: Workspace,
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> Increment:
    """Users of records ``(userid, ids)`` and of stored members ``(userid, id)``, at the cost of the records.

    The stored members are a star forest: each identifier hangs on its user, the lowest of them. Only the
    day's identifiers are looked up in it; each stands for its user, so the day's pairs become links between
    stored users and new identifiers, and only these are contracted. A user's lowest identifier is among
    what is contracted, so names come out as if everything had been resolved at once. Of the stored members
    those of users that now have another name are renamed, in a pass that moves nothing while the names are few.
    """
    spark = workspace.spark
    seen = Observation()
    watched = records.observe(seen, F.count(F.lit(1)).alias("rows"), hot_key_sketch(spark, "userid").alias("sketch"))
    pairs, _ = workspace.save(identity_pairs(watched), "day-pairs")
    found = observed(seen)
    ids, ids_bytes = measured(pairs.select("id").distinct(), workspace, "day-ids")

    # The day's identifiers are sent to the stored ones, which are not moved, while that is possible.
    known = stored.select(F.col("userid").alias("star"), "id")
    known = known.join(F.broadcast(ids) if ids_bytes <= limit else ids.hint("shuffle_hash"), "id")
    known, known_bytes = measured(known.select("id", "star"), workspace, "day-known")
    small_known = known_bytes <= limit

    def starred(df: DataFrame, column: str) -> DataFrame:
        table = known.select(F.col("id").alias(column), "star")
        joined = lookup_join(df, table, column, "left", limit, min_rows, small=small_known, null_keys=False)
        return joined.withColumn(column, F.coalesce("star", column)).drop("star")

    edges = identity_edges(starred(starred(pairs, "userid"), "id")).distinct()
    edges, _ = workspace.save(edges, "day-edges")
    linked, linked_bytes = measured(connected_components(edges, workspace, min_rows, "day-components"), workspace, "day-linked")

    today = lookup_join(ids, known, "id", "left", limit, min_rows, small=small_known, null_keys=False)
    today = today.withColumn("old", F.coalesce("star", "id"))
    names = linked.select(F.col("id").alias("old"), "component")
    today = lookup_join(today, names, "old", "left", limit, min_rows, small=linked_bytes <= limit, null_keys=False)
    today = today.select("id", "star", F.coalesce("component", "old").alias("component"))
    today, today_bytes = measured(today, workspace, "day-users")

    touched = today.where("star IS NOT NULL").select(F.col("star").alias("userid"), F.col("component").alias("to")).distinct()
    touched, touched_bytes = measured(touched, workspace, "day-touched")
    renamed = touched.where("userid <> to")
    members = lookup_join(stored.select("userid", "id"), renamed, "userid", "left", limit, min_rows, touched_bytes <= limit, null_keys=False)
    members = members.select(F.coalesce("to", "userid").alias("userid"), "id")
    fresh = today.where("star IS NULL").select(F.col("component").alias("userid"), "id")
    users = Users(
        today.select("id", "component"),
        today.select(F.col("component").alias("userid"), "id"),
        today_bytes <= limit,
        hot_keys_of_sketch(spark, found.get("sketch"), found["rows"], min_rows),
    )
    return Increment(users, touched, touched_bytes <= limit, members, fresh)


def canonical_user_id(members: DataFrame) -> DataFrame:
    """One identifier per component, the lowest, whatever the order of arrival."""
    return members.groupBy("component").agg(F.min("id").alias("userid"))
