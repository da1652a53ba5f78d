"""Merging the tags of all records of one person, and the profile as one row of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.operators.history import format_ids, format_tag_string, parse_tag_string, read_ids


def merge_user_tags(tag_rows: DataFrame) -> DataFrame:
    """Sum per user and tag of rows ``(userid, tag, weight)`` whose users are resolved.

    Rows are summed where they are before they are shuffled, so a user with a third of the log
    comes down to its distinct tags. This long form is what is stored: it has no limit of size.
    """
    return tag_rows.groupBy("userid", "tag").agg(F.sum("weight").alias("weight"))


def fold_profiles(tags: DataFrame, members: DataFrame) -> DataFrame:
    """One row per user, ``(userid, ids, entries)``, from the two long tables.

    For exports: a row holds all of its user's entries, so this is not what the daily job stores. Tags that
    are together by user already stay where they are, and the members are sent there.
    """
    nothing = {"id": "string", "tag": "string", "weight": "double"}
    listed = members.select("userid", "id").repartition("userid").unionByName(tags, allowMissingColumns=True)
    listed = listed.select("userid", *[F.col(c).cast(t) for c, t in nothing.items()])
    entry = F.when(F.col("tag").isNotNull(), F.struct("tag", "weight"))
    return listed.groupBy("userid").agg(
        # Lists without nulls; the other function for sorting calls a comparator that isn't compiled.
        F.array_union(F.array("userid"), F.sort_array(F.collect_list("id"))).alias("ids"),
        F.sort_array(F.collect_list(entry)).alias("entries"),
    )


def with_tag_map(profiles: DataFrame) -> DataFrame:
    """The profile's tags as ``map<string,double>``."""
    return profiles.withColumn("tags", F.map_from_entries("entries")).drop("entries")


def profile_table(profiles: DataFrame, digits: int | None = None) -> DataFrame:
    """The text form, ``(userid, allUserId, tags)``, of folded profiles."""
    return profiles.select(
        "userid",
        format_ids(F.col("ids")).alias("allUserId"),
        format_tag_string(F.col("entries"), digits).alias("tags"),
    )


def reads_back() -> Column:
    """Whether a folded profile's text form holds all of it.

    It does not if an identifier or a tag holds a comma, or a tag an arrow: the text has no escapes.
    """
    ids = F.array_sort(read_ids(format_ids(F.col("ids")))) == F.array_sort("ids")
    return ids & (parse_tag_string(format_tag_string(F.col("entries"))) == F.array_sort("entries"))
