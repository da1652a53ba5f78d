"""The user profile job: tags, identity, history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.functions.place import geohash8
from adspindle.functions.text import not_blank
from adspindle.operators.history import AS_OF, DECAY, decay_tags, import_profiles, text_rows, weights_on
from adspindle.operators.identity import Increment, first_id, identity_ids, resolve_increment, resolve_users
from adspindle.operators.joins import BROADCAST_BYTES, HOT_ROWS, gather, measured, used_keys
from adspindle.operators.places import geohash_district_join
from adspindle.operators.profile import merge_user_tags
from adspindle.operators.tags import ALL_RULES, Rule, set_rows, tag_rows, tag_set, with_dictionary_values
from adspindle.schema import TAG_COLUMNS
from adspindle.sources.adlog import compile_wide_rows
from adspindle.sources.daily import in_buckets
from adspindle.sources.workspace import Workspace


@dataclass(frozen=True)
class Lookups:
    """The tables the tag rules look things up in; of those measured already, whether they are small."""

    apps: DataFrame
    devices: DataFrame
    districts: DataFrame
    small_apps: bool | None = None
    small_districts: bool | None = None

    def stored(self, workspace: Workspace, limit: int = BROADCAST_BYTES) -> Lookups:
        """The same tables, computed and measured once, in one write each."""
        apps, app_bytes = measured(self.apps, workspace, "apps")
        districts, district_bytes = measured(self.districts, workspace, "districts")
        return Lookups(apps, self.devices, districts, app_bytes <= limit, district_bytes <= limit)

    def used_by(self, ods: DataFrame, workspace: Workspace, limit: int = BROADCAST_BYTES) -> Lookups:
        """The same tables; of those measured and found large only the rows that the log asks for.

        A log has few apps and cells for its size. What they need of a large table is usually small, and then the
        log is not shuffled by keys that a few tasks would get all of.
        """
        used = self
        if self.small_apps is False:
            apps, size = measured(used_keys(ods, F.col("appid"), self.apps, "key"), workspace, "apps-used")
            used = replace(used, apps=apps, small_apps=size <= limit)
        if self.small_districts is False:
            cell = geohash8(F.col("longitude"), F.col("latitude"))
            districts, size = measured(used_keys(ods, cell, self.districts, "geohash"), workspace, "districts-used")
            used = replace(used, districts=districts, small_districts=size <= limit)
        return used


@dataclass(frozen=True)
class History:
    """Stored profiles in long form: ``(userid, tag, weight)`` and ``(userid, id)``.

    Where the tags were read from texts, ``texts`` has these, ``(userid, tags)``: a row is one profile, so it is
    moved to its user's others before its tags become rows.
    """

    tags: DataFrame
    ids: DataFrame
    texts: DataFrame | None = None

    @staticmethod
    def of_texts(profiles: DataFrame) -> History:
        """The history in a table of profiles in text form, see ``import_profiles``."""
        tags, ids = import_profiles(profiles)
        return History(tags, ids, profiles.where(not_blank(F.col("userid"))).select("userid", "tags"))


def tagged_log(
    ods: DataFrame, lookups: Lookups, limit: int = BROADCAST_BYTES, min_rows: int = HOT_ROWS
) -> DataFrame:
    """The log with everything the tag rules read: areas, dictionary values."""
    compile_wide_rows(ods.sparkSession)
    placed = geohash_district_join(ods, lookups.districts, limit, small=lookups.small_districts, min_rows=min_rows)
    return with_dictionary_values(
        placed, lookups.apps, lookups.devices, limit, small_apps=lookups.small_apps, min_rows=min_rows
    )


def today_records(ods: DataFrame) -> DataFrame:
    """``(userid, ids)`` per usable row; of the log only the identifier columns are read."""
    records = ods.select(first_id().alias("userid"), identity_ids().alias("ids"))
    return records.where("userid is not null")


def known_users(ods: DataFrame, columns: Sequence[str] = TAG_COLUMNS) -> DataFrame:
    """The log's usable rows, with ``userid`` and the columns that the tag rules read."""
    return ods.withColumn("userid", first_id()).where("userid is not null").select("userid", *columns)


def user_profile_long(
    ods: DataFrame,
    lookups: Lookups,
    workspace: Workspace,
    history: History | None = None,
    factor: float = DECAY,
    rules: Sequence[Rule] = ALL_RULES,
    columns: Sequence[str] = TAG_COLUMNS,
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(userid, tag, weight)`` and ``(userid, id)`` over today and, if given, the decayed history.

    Identity is resolved once over both days: merged identifier lists keep a history's links, so
    resolving today first and then again with the history gives the same users and sums. Users are
    put on the narrow log rows, the ``columns`` that the rules read, and rows with their tag sets are
    brought together by user before they become many tag rows each, which are summed where they arise. The
    same goes for a history in texts; stored tag rows are relabelled as they are, one row per tag, and
    shuffled once, already summed.
    """
    lookups = lookups.used_by(ods, workspace, limit)
    records = today_records(ods)
    if history is not None:
        known = history.ids.select("userid", F.array_distinct(F.array("userid", "id")).alias("ids"))
        records = records.unionByName(known)
    users = resolve_users(records, workspace, limit, min_rows)
    placed = users.relabel(known_users(ods, columns))
    sets = tagged_log(placed, lookups, limit, min_rows).select("userid", tag_set(rules).alias("tags"))
    tags = set_rows(gather(sets, "userid", users.hot_users), ["userid"])
    if history is not None and history.texts is not None:
        past = text_rows(gather(users.relabel(history.texts), "userid", users.hot_users))
        tags = tags.unionByName(decay_tags(past, factor))
    elif history is not None:
        tags = tags.unionByName(decay_tags(users.relabel(history.tags), factor))
    return merge_user_tags(tags), users.members


def carried_tags(
    tags: DataFrame, today: DataFrame, increment: Increment, day: Column, factor: float = DECAY
) -> tuple[DataFrame, DataFrame]:
    """Stored tag rows ``(userid, tag, weight, as_of)`` after a day with tag rows ``today`` of resolved users.

    Two parts: the rows of users that the day does not meet, as they are stored, and of those that it meets,
    under their users' names of now, decayed to ``day`` and added to the day's. A weight says which
    day it is of, so only what is added to has to be changed. Stored rows stay where they are: users met are
    sent to them, or beyond the limit dealt into their buckets. The second part is in buckets too.
    """
    touched = increment.touched
    met = F.broadcast(touched) if increment.small else touched.hint("shuffle_hash")
    untouched = tags.join(met.select("userid"), "userid", "left_anti").select("userid", "tag", "weight", AS_OF)
    carried = weights_on(tags.join(met, "userid"), day, factor).select(F.col("to").alias("userid"), "tag", "weight")
    # Both are summed up already as far as they can be; one exchange serves the sum and the buckets.
    merged = merge_user_tags(in_buckets(today.unionByName(carried), "userid")).withColumn(AS_OF, day)
    return untouched, merged


def user_profile_increment(
    ods: DataFrame,
    lookups: Lookups,
    workspace: Workspace,
    history: History,
    day: Column,
    factor: float = DECAY,
    rules: Sequence[Rule] = ALL_RULES,
    columns: Sequence[str] = TAG_COLUMNS,
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """What ``user_profile_long`` gives for a log and a history, at the cost of the log, to be filed into buckets.

    ``history.tags`` has weights with their days, ``(userid, tag, weight, as_of)``, and ``history.ids`` the
    members; the results have the same columns. Rows that the day does not change come from where they are
    stored, all others are dealt into buckets of ``userid`` (tags) and ``id`` (members).
    """
    lookups = lookups.used_by(ods, workspace, limit)
    increment = resolve_increment(today_records(ods), history.ids, workspace, limit, min_rows)
    placed = increment.users.relabel(known_users(ods, columns))
    tags = merge_user_tags(tag_rows(tagged_log(placed, lookups, limit, min_rows), ["userid"], rules))
    untouched, merged = carried_tags(history.tags, tags, increment, day, factor)
    # Where too many users have new names to be sent to the stored members, these have been shuffled by user.
    members = increment.members if increment.small else in_buckets(increment.members, "id")
    return untouched.unionByName(merged), members.unionByName(in_buckets(increment.fresh, "id"))
