"""One day from raw log to stored profiles, table by table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspindle.operators.history import AS_OF, weights_on
from adspindle.operators.places import Districts, extend_district_dictionary
from adspindle.plans.ingest import enrich_log
from adspindle.plans.profile import History, Lookups, user_profile_increment, user_profile_long
from adspindle.plans.reports import COUNT_KEY, COUNT_REPORT, FUNNEL_REPORTS, report_bundle, report_of_bundle
from adspindle.sources.adlog import CORRUPT_COLUMN, readable_rows, unreadable_lines
from adspindle.sources.daily import StagedDay, in_buckets, published, read_daily
from adspindle.sources.workspace import Workspace

# Names of the other daily tables.
ODS, DISTRICTS, TAGS = "ods", "business_area", "tags"
# The identifiers of each profile; its tags are in TAGS, one row per user and tag.
PROFILE_IDS = "profile_ids"
# Locations whose replies are in the district dictionary, and log lines that could not be read.
LOCATIONS, UNREADABLE = "business_area_locations", "unreadable_log"

TABLE_KEYS = {
    COUNT_REPORT: COUNT_KEY,
    **FUNNEL_REPORTS,
    DISTRICTS: ["geohash"],
    TAGS: ["userid", "tag"],
    PROFILE_IDS: ["userid", "id"],
}


@dataclass(frozen=True)
class DayInputs:
    log: DataFrame
    ranges: DataFrame
    replies: DataFrame
    apps: DataFrame
    devices: DataFrame


def run_day(
    spark: SparkSession, root: str, dt: str, inputs: DayInputs, previous_dt: str | None = None
) -> None:
    """Write every daily table of ``dt`` under ``root``; running it again replaces them.

    ``previous_dt`` names the day whose profiles and districts are carried over, if there is one. Of the profiles
    only what the day's records meet is resolved and added to; the rest is copied where it is, with weights that
    say which day they are of. Of the replies only those of new locations are read out. Where the log was read with
    its unreadable lines, these go into a table of their own and nowhere else. All tables are published together at the end: if anything fails before, a key that does
    not hold for instance, the day stays as it was. The log's own key, the address, repeats in any log and is
    not checked.
    """
    workspace = Workspace(spark, f"day-{dt}")
    day = F.to_date(F.lit(dt), "yyyyMMdd")
    try:
        with StagedDay(spark, root, dt) as tables:
            log = inputs.log
            if CORRUPT_COLUMN in log.columns:
                tables.write(unreadable_lines(log), UNREADABLE)
                log = readable_rows(log)
            ods = tables.write(enrich_log(log, inputs.ranges, workspace), ODS)

            bundle, _ = workspace.save(report_bundle(ods), "reports")
            for report in (COUNT_REPORT, *FUNNEL_REPORTS):
                tables.write(report_of_bundle(bundle, report), report, TABLE_KEYS[report])

            known = _stored_districts(spark, root, previous_dt) if previous_dt else None
            found = extend_district_dictionary(known, ods, inputs.replies, workspace)
            districts = tables.write(found.dictionary, DISTRICTS, TABLE_KEYS[DISTRICTS])
            tables.write(found.locations, LOCATIONS, ["longitude", "latitude"])
            lookups = Lookups(inputs.apps, inputs.devices, districts).stored(workspace)

            if previous_dt:
                history = _stored_as_written(spark, root, previous_dt)
                tags, members = user_profile_increment(ods, lookups, workspace, history, day)
            else:
                tags, members = user_profile_long(ods, lookups, workspace)
                tags, members = in_buckets(tags.withColumn(AS_OF, day), "userid"), in_buckets(members, "id")
            tables.write(tags, TAGS, TABLE_KEYS[TAGS], bucket_by="userid")
            tables.write(members, PROFILE_IDS, TABLE_KEYS[PROFILE_IDS], bucket_by="id")
    finally:
        workspace.remove()


def _stored_districts(spark: SparkSession, root: str, dt: str) -> Districts | None:
    """A day's dictionary and the locations in it; none if the day has no such tables."""
    if not {DISTRICTS, LOCATIONS} <= set(published(spark, root, dt)):
        return None
    return Districts(*[read_daily(spark, root, name, dt).drop("dt") for name in (DISTRICTS, LOCATIONS)])


def _stored_as_written(spark: SparkSession, root: str, dt: str) -> History:
    """The stored profiles of a day, each weight with its day; weights stored without are of ``dt``."""
    tags, ids = (read_daily(spark, root, name, dt).drop("dt") for name in (TAGS, PROFILE_IDS))
    if AS_OF not in tags.columns:
        tags = tags.withColumn(AS_OF, F.to_date(F.lit(dt), "yyyyMMdd"))
    return History(tags, ids)


def stored_profiles(spark: SparkSession, root: str, dt: str) -> History:
    """The profiles that ``run_day`` stored for a day, with their weights on that day."""
    history = _stored_as_written(spark, root, dt)
    return History(weights_on(history.tags, F.to_date(F.lit(dt), "yyyyMMdd")), history.ids)
