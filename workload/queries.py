"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adspindle.functions import place, salting, text
from adspindle.functions.registry import register_functions
from adspindle.operators import aggregates, filters, history, identity, joins, places, profile, tags
from adspindle.plans import daily
from adspindle.plans import profile as profile_plan
from adspindle.plans import reports
from adspindle.plans.ingest import enrich_log
from adspindle.sources.adlog import read_ad_log
from adspindle.sources.daily import date_key, previous_date_key, read_daily, repeated_keys, write_daily
from adspindle.sources.workspace import Workspace
from workload import adlog
from workload.adlog import TODAY, table

Query = Callable[[SparkSession, str], DataFrame]
ROW_COLUMN = adlog.ROW_COLUMN
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# Sources and sinks


@query
def scan_json_log(spark, sf):
    path = Workspace(spark, "log").fresh_path("day")
    adlog.raw_log(spark, sf).drop("rid", "dt").write.json(path)
    log = read_ad_log(spark, path)
    return log.groupBy("channelid", "client").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ip").alias("ips"),
        F.min("imei").alias("first_imei"),
        F.sum("adorderid").alias("orders"),
        F.round(F.sum("winprice"), 6).alias("price"),
    )


def _stored_counts(spark, sf, n: int | None) -> str:
    root = Workspace(spark, "daily").path
    log = adlog.ods(spark, sf)
    for dt, day in (("20240115", F.col("dt") < TODAY), (TODAY, F.col("dt") >= TODAY)):
        counted = reports.report_province_city(log.where(day))
        write_daily(counted, root, reports.COUNT_REPORT, dt, reports.COUNT_KEY, n)
    return root


@query
def scan_daily_table(spark, sf):
    root = _stored_counts(spark, sf, None)
    return read_daily(spark, root, reports.COUNT_REPORT, "20240115")


@query
def write_daily_keyed(spark, sf):
    root = _stored_counts(spark, sf, 3)
    # Run again with nothing, and then as it should be: both replace what was there.
    again = reports.report_province_city(adlog.ods(spark, sf).where(F.col("dt") >= TODAY))
    write_daily(again.where("number < 0"), root, reports.COUNT_REPORT, TODAY, reports.COUNT_KEY, 3)
    write_daily(again.where("number < 0"), root, reports.COUNT_REPORT, "20240117", reports.COUNT_KEY)
    empty = read_daily(spark, root, reports.COUNT_REPORT, TODAY).unionByName(
        read_daily(spark, root, reports.COUNT_REPORT, "20240117")
    )
    if not empty.isEmpty():
        raise ValueError("an empty rerun left rows of the day behind")
    write_daily(again, root, reports.COUNT_REPORT, TODAY, reports.COUNT_KEY, 3)
    return read_daily(spark, root, reports.COUNT_REPORT, "20240115").unionByName(
        read_daily(spark, root, reports.COUNT_REPORT, TODAY)
    )


@query
def scan_dictionary(spark, sf):
    return adlog.app_dictionary(spark, sf)


@query
def check_unique_key(spark, sf):
    return repeated_keys(adlog.ods(spark, sf), ["ip"])


@query
def date_keys(spark, sf):
    day = F.to_date("ts")
    return (
        table(spark, sf, "events")
        .groupBy(date_key(day).alias("today"), previous_date_key(day).alias("yesterday"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# Projections and filters


@query
def ods_projection(spark, sf):
    log = adlog.ods(spark, sf)
    looked_up = log.withColumnsRenamed({"provincename": "region", "cityname": "city"})
    projected = filters.ods_projection(looked_up)
    return projected.withColumns({c: F.col(c).cast("double") for c in ("longitude", "latitude")})


@query
def derive_client_label(spark, sf):
    return adlog.ods(spark, sf).select(
        "rid", "client", text.client_label(F.col("client")).alias("label")
    )


@query
def filter_has_identifier(spark, sf):
    return filters.with_identifier(adlog.ods(spark, sf)).select("rid", "imei", "mac", "idfa")


@query
def filter_has_location(spark, sf):
    kept = filters.with_location(adlog.ods(spark, sf))
    return kept.select("rid", F.col("longitude").cast("double"), F.col("latitude").cast("double"))


@query
def filter_nonempty(spark, sf):
    return filters.nonempty(adlog.ods(spark, sf), "keywords").select("rid", "keywords")


@query
def filter_null_join_key(spark, sf):
    return filters.with_join_key(adlog.ods(spark, sf), "imei").select("rid", "imei")


@query
def split_by_key_value(spark, sf):
    log = adlog.ods(spark, sf).select("rid", "cityname")
    hot, cold = filters.split_by_key(log, "cityname", ["C3", "C5"])
    return hot.withColumn("side", F.lit("hot")).unionByName(cold.withColumn("side", F.lit("cold")))


# Joins


@query
def ip_range_join(spark, sf):
    log = adlog.raw_log(spark, sf).select("rid", "ip")
    return places.ip_range_join(log, adlog.ip_ranges(spark, sf))


@query
def ip_range_join_shuffled(spark, sf):
    """The same beyond the size limit, with addresses spread that are hot even here."""
    log = adlog.raw_log(spark, sf).select("rid", "ip")
    return places.ip_range_join(log, adlog.ip_ranges(spark, sf), limit=0, min_rows=10)


@query
def ip_range_join_nested(spark, sf):
    """Wide ranges around narrow ones: the nearest start decides, across all blocks."""
    log, ranges = adlog.raw_log(spark, sf).select("rid", "ip"), adlog.nested_ranges(spark, sf)
    near = places.ip_range_join(log, ranges).withColumn("way", F.lit("broadcast"))
    return near.unionByName(places.ip_range_join(log, ranges, limit=0).withColumn("way", F.lit("shuffled")))


@query
def ip_geo_enrich(spark, sf):
    # The row number travels in a column of the log that nothing else reads.
    log = adlog.raw_log(spark, sf, spread=True).withColumn(ROW_COLUMN, F.col("rid").cast("string"))
    enriched = enrich_log(log, adlog.ip_ranges(spark, sf))
    return enriched.withColumns({c: F.col(c).cast("double") for c in ("longitude", "latitude")})


def _districts(spark, sf) -> DataFrame:
    return places.build_district_dictionary(adlog.ods(spark, sf), adlog.replies(spark, sf))


def _district_query(**options) -> Query:
    def run(spark, sf):
        districts, size = joins.measured(_districts(spark, sf), Workspace(spark, "districts"), "districts")
        limit = options.get("limit", joins.BROADCAST_BYTES)
        log = adlog.ods(spark, sf)
        return places.geohash_district_join(log, districts, small=size <= limit, **options).select("rid", "areas")

    return run


def _dictionary_query(**options) -> Query:
    def run(spark, sf):
        apps, size = joins.measured(adlog.app_dictionary(spark, sf), Workspace(spark, "apps"), "apps")
        small = size <= options.get("limit", joins.BROADCAST_BYTES)
        found = tags.with_dictionary_values(adlog.ods(spark, sf), apps, adlog.devices(spark), small_apps=small, **options)
        return found.select("rid", tags.APP_NAME, tags.CLIENT_CODE, tags.ISP_CODE, tags.NETWORK_CODE)

    return run


# Beyond the size limit the same joins shuffle, with keys spread that are hot even in a small table.
SHUFFLED = {"limit": 0, "min_rows": 10}
QUERIES["geohash_district_join"] = _district_query()
QUERIES["geohash_district_join_shuffled"] = _district_query(**SHUFFLED)
QUERIES["dictionary_lookup_join"] = _dictionary_query()
QUERIES["dictionary_lookup_join_shuffled"] = _dictionary_query(**SHUFFLED)


def _orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), "o_orderstatus", "o_totalprice"
    )


def _lines(spark, sf, key: str = "l_orderkey") -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        f"{key} as key", "l_partkey", "l_linenumber", "l_quantity"
    )


# A third of the lines on one order, and all of them on a handful of orders.
HOT_LINES = "case when l_linenumber in (1, 4) then 7 else l_orderkey end"
FEW_ORDERS = "case when l_linenumber = 5 then l_orderkey else 1 + l_partkey % 7 end"


@query
def left_join_plain(spark, sf):
    return _lines(spark, sf).join(_orders(spark, sf), "key", "left")


@query
def null_safe_left_join(spark, sf):
    log = adlog.ods(spark, sf).select("rid", "imei")
    known = log.groupBy("imei").agg(F.max("rid").alias("last_rid"))
    return joins.null_safe_left_join(log, known, "imei", blank_is_null=True)


@query
def null_safe_left_join_shuffled(spark, sf):
    """Beyond the size limit: most lines are of orders that the other side doesn't have, or have no key."""
    lines = _lines(spark, sf, "case when l_linenumber = 2 then null else l_orderkey end")
    some = _orders(spark, sf).where("key % 10 = 0 and o_orderstatus <> 'P'")
    return joins.null_safe_left_join(lines, some, "key", limit=0, min_rows=10)


@query
def grid_join(spark, sf):
    """A third of the rows of both sides on one key."""
    left = table(spark, sf, "customer").selectExpr("case when c_custkey % 3 = 0 then 7 else c_custkey end as key", "c_custkey")
    right = table(spark, sf, "part").selectExpr("case when p_partkey % 3 = 1 then 7 else p_partkey end as key", "p_partkey", "p_size")
    counts = [{r["key"]: r["rows"] for r in joins.key_counts(side, "key", 30).collect()} for side in (left, right)]
    grids = {k: joins.grid_shape(n, counts[1].get(k, 0), cells=16) for k, n in counts[0].items()}
    # A hot key's pairs grow with the square of the tables; what is asked of them are totals of the right rows.
    totals = joins.totals_in_slices(
        right, "key", 16, F.count("p_partkey").alias("parts"), F.sum("p_size").alias("size"), F.max("p_partkey").alias("last")
    )
    joined = joins.grid_join(left, totals, "key", grids, spread=(None, [joins.SLICE]))
    return joined.groupBy("key", "c_custkey").agg(
        F.coalesce(F.sum("parts"), F.lit(0)).alias("parts"), F.sum("size").cast("bigint").alias("size"), F.max("last").alias("last")
    )


@query
def broadcast_join(spark, sf):
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.lookup_join(lines, supplier, "l_suppkey")


@query
def skew_join_hot_keys(spark, sf):
    lines = _lines(spark, sf, HOT_LINES)
    hot = joins.hot_keys(lines, "key", min_rows=1000)
    return joins.skew_join(lines, _orders(spark, sf), "key", hot, salts=8)


@query
def skew_join_full_salt(spark, sf):
    return joins.skew_join_full_salt(_lines(spark, sf, FEW_ORDERS), _orders(spark, sf), "key")


def _user_ids(spark, sf) -> DataFrame:
    log = adlog.ods(spark, sf)
    picked = log.select(
        "rid", identity.first_id().alias("userid"), identity.identity_ids().alias("ids")
    )
    return picked.where("userid is not null")


def _all_components(spark, sf) -> tuple[DataFrame, DataFrame]:
    records = _user_ids(spark, sf)
    work = Workspace(spark, "identity")
    pairs, _ = work.save(identity.identity_pairs(records), "pairs")
    linked = identity.connected_components(identity.identity_edges(pairs), work)
    return records, identity.all_components(pairs.select("id").distinct(), linked)


@query
def component_attach_join(spark, sf):
    records, members = _all_components(spark, sf)
    return identity.component_attach_join(records.drop("ids"), members)


@query
def component_attach_join_shuffled(spark, sf):
    records, members = _all_components(spark, sf)
    return identity.component_attach_join(records.drop("ids"), members, **SHUFFLED)


# Aggregations


def _report(function: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark, sf):
        report = function(adlog.ods(spark, sf))
        return rounded(report, "bid_success_rat", "media_click_rat", "dsp_consumtion", "dsp_cost")

    return run


@query
def report_province_city(spark, sf):
    return reports.report_province_city(adlog.ods(spark, sf))


for _name in ("region", "app", "device", "network", "operator", "channel"):
    QUERIES[f"report_ad_{_name}"] = _report(getattr(reports, f"report_ad_{_name}"))
QUERIES["report_ad_device_by_label"] = _report(lambda log: reports.report_ad_device(log, group_label=True))
QUERIES["report_bundle"] = _report(reports.report_bundle)
QUERIES["report_bundle_by_tuples"] = _report(lambda log: reports.report_bundle(log, by_tuples=True))


@query
def salted_two_phase_agg(spark, sf):
    return aggregates.salted_count(_lines(spark, sf, HOT_LINES), "key", "l_partkey", "l_linenumber")


@query
def distinct_per_key(spark, sf):
    lines = _lines(spark, sf, HOT_LINES).withColumn("l_partkey", F.when(F.col("l_quantity") > 3, F.col("l_partkey")))
    return aggregates.distinct_per_key(lines, "key", "l_partkey")


@query
def quantiles_per_key(spark, sf):
    lines, work = _lines(spark, sf, HOT_LINES), Workspace(spark, "quantiles")
    return aggregates.quantiles_per_key(lines, "key", "l_partkey", [0.0, 0.25, 0.5, 0.9, 1.0], work)


@query
def distinct_locations(spark, sf):
    found = places.distinct_locations(adlog.ods(spark, sf))
    return found.select(F.col("longitude").cast("double"), F.col("latitude").cast("double"))


@query
def distinct_districts(spark, sf):
    return places.distinct_districts(adlog.replies(spark, sf))


@query
def hot_key_detect(spark, sf):
    return joins.key_counts(_lines(spark, sf, HOT_LINES), "key", min_rows=100)


# Set operations


@query
def union_all(spark, sf):
    log = adlog.ods(spark, sf).select("appid", "channelid")
    return aggregates.union_all(log, log.withColumn("channelid", F.upper("channelid")))


@query
def union_distinct(spark, sf):
    log = adlog.ods(spark, sf).select("cityname", "channelid")
    return aggregates.union_distinct(*filters.split_by_key(log, "cityname", ["C3"]))


# Identity


@query
def identity_ids(spark, sf):
    return _user_ids(spark, sf).select(
        "rid", "userid", history.format_ids(F.col("ids")).alias("ids"), F.size("ids").alias("n")
    )


@query
def identity_edges(spark, sf):
    return identity.identity_edges(identity.identity_pairs(_user_ids(spark, sf)))


@query
def connected_components(spark, sf):
    _, members = _all_components(spark, sf)
    return members


@query
def identity_resolve(spark, sf):
    records = _user_ids(spark, sf)
    work = Workspace(spark, "resolve")
    pairs, _ = work.save(identity.identity_pairs(records), "pairs")
    linked = identity.connected_components(identity.identity_edges(pairs), work)
    return identity.attach_component(records.drop("ids"), linked)


@query
def canonical_user_id(spark, sf):
    _, members = _all_components(spark, sf)
    return identity.canonical_user_id(members)


# Tags


def _lookups(spark, sf) -> profile_plan.Lookups:
    lookups = profile_plan.Lookups(adlog.app_dictionary(spark, sf), adlog.devices(spark), _districts(spark, sf))
    return lookups.stored(Workspace(spark, "lookups"))


def _tag_query(rules: list[tags.Rule], prepare: Callable[[SparkSession, str, DataFrame], DataFrame]) -> Query:
    def run(spark, sf):
        return tags.tag_rows(prepare(spark, sf, adlog.ods(spark, sf)), ["rid"], rules)

    return run


def _with_app(spark, sf, log):
    return tags.dictionary_lookup(log, adlog.app_dictionary(spark, sf), F.col("appid"), tags.APP_NAME)


def _with_codes(spark, sf, log):
    return tags.with_device_codes(log, adlog.devices(spark))


def _with_areas(spark, sf, log):
    return places.geohash_district_join(log, _districts(spark, sf))


def _as_is(spark, sf, log):
    return log


QUERIES["tag_app"] = _tag_query([tags.app_rule], _with_app)
QUERIES["tag_device"] = _tag_query([tags.device_rule], _with_codes)
QUERIES["tag_region"] = _tag_query([tags.region_rule], _as_is)
QUERIES["tag_keyword"] = _tag_query([tags.keyword_rule], _as_is)
QUERIES["tag_channel"] = _tag_query([tags.channel_rule], _as_is)
QUERIES["tag_age"] = _tag_query([tags.age_rule], _as_is)
QUERIES["tag_sex"] = _tag_query([tags.sex_rule], _as_is)
QUERIES["tag_business_area"] = _tag_query([tags.business_area_rule], _with_areas)


@query
def tag_all(spark, sf):
    return tags.tag_rows(profile_plan.tagged_log(adlog.ods(spark, sf), _lookups(spark, sf)), ["rid"])


@query
def merge_user_tags(spark, sf):
    log, work = adlog.ods(spark, sf), Workspace(spark, "merge")
    rules = [tags.channel_rule, tags.keyword_rule, tags.age_rule, tags.sex_rule]
    users = identity.resolve_users(profile_plan.today_records(log), work)
    rows = tags.tag_rows(users.relabel(profile_plan.known_users(log)), ["userid"], rules)
    folded = profile.fold_profiles(profile.merge_user_tags(rows), users.members)
    return profile.with_tag_map(folded).select(
        "userid",
        history.format_ids(F.col("ids")).alias("ids"),
        history.format_tag_map(F.col("tags"), 6).alias("tags"),
    )


@query
def user_profile_today(spark, sf):
    log = adlog.ods(spark, sf)
    merged, _ = profile_plan.user_profile_long(log, _lookups(spark, sf), Workspace(spark, "today"))
    return rounded(merged, "weight")


# History


def _two_days(spark, sf) -> tuple[DataFrame, profile_plan.History, profile_plan.Lookups]:
    """Today's log, and a history of one stored profile per row of the days before."""
    log, work = adlog.ods(spark, sf, spread=True), Workspace(spark, "history")
    lookups = _lookups(spark, sf).used_by(log, work)
    texts, _ = work.save(adlog.history(profile_plan.tagged_log(log.where(F.col("dt") < TODAY), lookups)), "texts")
    return log.where(F.col("dt") >= TODAY), profile_plan.History.of_texts(texts), lookups


def _tag_text() -> Column:
    """A stored tag string with repeated, broken and arrow-bearing pieces."""
    return F.concat_ws(
        ",",
        F.concat(F.lit("CN_"), "channelid", F.lit(" -> 1.5")),
        F.concat(F.lit("A -> B"), F.lit(" -> "), (F.col("rid") % 5).cast("string")),
        F.when(F.col("rid") % 3 == 0, F.concat(F.lit("CN_"), "channelid", F.lit(" -> 2.25"))),
        F.when(F.col("rid") % 4 == 0, F.lit("broken -> x")),
        F.when(F.col("rid") % 6 == 0, F.lit(",")),
    )


@query
def parse_tag_string(spark, sf):
    log = adlog.ods(spark, sf).select("rid", _tag_text().alias("text"))
    return log.select(
        "rid",
        history.bad_pieces(F.col("text")).alias("bad"),
        F.explode(history.parse_tag_map(F.col("text"))).alias("tag", "weight"),
    )


@query
def format_tag_string(spark, sf):
    log = adlog.ods(spark, sf).select(
        "rid", _tag_text().alias("text"), identity.identity_ids().alias("ids")
    )
    return log.select(
        "rid",
        history.format_ids(F.col("ids")).alias("allUserId"),
        history.format_tag_string(history.parse_tag_string(F.col("text"))).alias("tags"),
    )


@query
def decay_tags(spark, sf):
    log = adlog.ods(spark, sf).select("rid", _tag_text().alias("text"))
    rows = log.select("rid", F.inline(history.parse_tag_string(F.col("text"))))
    return rounded(history.decay_tags(rows), "weight")


def _profile_texts(spark, sf, **options) -> DataFrame:
    today, past, lookups = _two_days(spark, sf)
    tags_long, members = profile_plan.user_profile_long(
        today, lookups, Workspace(spark, "profile"), past, **options
    )
    return profile.profile_table(profile.fold_profiles(tags_long, members), digits=6)


@query
def user_profile_with_history(spark, sf):
    return _profile_texts(spark, sf)


@query
def user_profile_with_history_shuffled(spark, sf):
    return _profile_texts(spark, sf, **SHUFFLED)


@query
def profile_round_trip(spark, sf):
    """Three days of storing and reading back profiles whose tags and identifiers hold commas and arrows.

    One user has a tag for each row of the log.
    """
    root = Workspace(spark, "round-trip").path
    log = adlog.ods(spark, sf).select("rid", "keywords", "channelid")
    tagged = log.select(
        F.when(F.col("rid") % 2 == 0, "a,1").otherwise(F.concat(F.lit("u -> "), F.col("rid") % 10)).alias("userid"),
        F.when(F.col("rid") % 2 == 0, F.concat(F.lit("KW_x, y -> "), "rid"))
        .otherwise(F.concat_ws(" -> ", F.lit("KW_a"), "channelid", "keywords"))
        .alias("tag"),
        F.lit(1.0).alias("weight"),
    )
    members = tagged.select("userid", F.col("userid").alias("id")).distinct()
    write_daily(profile.merge_user_tags(tagged), root, daily.TAGS, "20240114", daily.TABLE_KEYS[daily.TAGS])
    write_daily(members, root, daily.PROFILE_IDS, "20240114", daily.TABLE_KEYS[daily.PROFILE_IDS])
    nothing, lookups = adlog.ods(spark, sf).where("rid < 0"), _lookups(spark, sf)
    for before, dt in (("20240114", "20240115"), ("20240115", "20240116")):
        past = daily.stored_profiles(spark, root, before)
        found, ids = profile_plan.user_profile_long(nothing, lookups, Workspace(spark, "day"), past)
        write_daily(found, root, daily.TAGS, dt, daily.TABLE_KEYS[daily.TAGS])
        write_daily(ids, root, daily.PROFILE_IDS, dt, daily.TABLE_KEYS[daily.PROFILE_IDS])
    last = daily.stored_profiles(spark, root, "20240116")
    listed = last.ids.groupBy("userid").agg(F.count(F.lit(1)).alias("ids"))
    return rounded(last.tags.join(listed, "userid").select("userid", "tag", "weight", "ids"), "weight")


@query
def run_day_twice(spark, sf):
    """The daily job over two days, the second carrying the first one's profiles over."""
    root, log = Workspace(spark, "days").path, adlog.raw_log(spark, sf, spread=True)
    shared = (
        adlog.ip_ranges(spark, sf), adlog.replies(spark, sf), adlog.app_dictionary(spark, sf), adlog.devices(spark)
    )
    daily.run_day(spark, root, "20240115", daily.DayInputs(log.where(F.col("dt") < TODAY), *shared))
    daily.run_day(spark, root, TODAY, daily.DayInputs(log.where(F.col("dt") >= TODAY), *shared), "20240115")
    return rounded(daily.stored_profiles(spark, root, TODAY).tags, "weight")


def _day_inputs(spark, sf) -> tuple[DataFrame, ...]:
    return adlog.ip_ranges(spark, sf), adlog.replies(spark, sf), adlog.app_dictionary(spark, sf), adlog.devices(spark)


@query
def run_three_days(spark, sf):
    """The daily job over three days, each resolved and decayed against what the one before has stored."""
    root, log = Workspace(spark, "three-days").path, adlog.raw_log(spark, sf, spread=True)
    shared, before = _day_inputs(spark, sf), None
    for number, dt in enumerate(adlog.THREE_DAYS):
        own = log.where(f"{adlog.DAY_OF_THREE} = {number}")
        daily.run_day(spark, root, dt, daily.DayInputs(own, *shared), before)
        before = dt
    last = daily.stored_profiles(spark, root, before)
    listed = last.ids.groupBy("userid").agg(F.count(F.lit(1)).alias("ids"))
    return rounded(last.tags.join(listed, "userid").select("userid", "tag", "weight", "ids"), "weight")


@query
def identity_resolve_increment(spark, sf):
    """Users of three days, each day's records contracted against the members of the days before."""
    work, log = Workspace(spark, "increments"), adlog.ods(spark, sf)
    members = spark.createDataFrame([], "userid string, id string")
    for number in range(len(adlog.THREE_DAYS)):
        records = profile_plan.today_records(log.where(f"{adlog.DAY_OF_THREE} = {number}"))
        found = identity.resolve_increment(records, members, work)
        members, _ = work.save(found.all_members(), f"members-{number}")
    return members.select("id", F.col("userid").alias("component"))


# Scalar functions


@query
def fn_ip_to_long(spark, sf):
    log = adlog.ods(spark, sf)
    odd = F.when(F.col("rid") % 50 == 1, F.concat(F.col("ip"), F.lit(".1"))).when(
        F.col("rid") % 50 == 2, F.lit("300.1.1.1")
    ).otherwise(F.col("ip"))
    return log.select("rid", place.ip_to_long(odd).alias("number"))


@query
def fn_long_to_ip(spark, sf):
    number = (F.col("rid") * 429496) % 4294967296
    return adlog.ods(spark, sf).select("rid", place.long_to_ip(number).alias("ip"))


def _country_query(function: Callable[[Column], Column], name: str) -> Query:
    def run(spark, sf):
        return adlog.countries(spark, sf).select("rid", function(F.col("country")).alias(name))

    return run


QUERIES["fn_province"] = _country_query(place.province, "province")
QUERIES["fn_city"] = _country_query(place.city, "city")


@query
def fn_area_clean(spark, sf):
    area = F.when(F.col("rid") % 4 == 0, F.lit(" CZ88.NET ")).otherwise(F.col("cityname"))
    return adlog.ods(spark, sf).select("rid", place.clean_area(area).alias("area"))


@query
def fn_private_ip(spark, sf):
    home = F.concat(F.lit("192.168.1."), F.col("rid") % 250)
    ip = F.when(F.col("rid") % 4 == 0, home).otherwise(F.col("ip"))
    return adlog.ods(spark, sf).select("rid", place.public_ip(ip).alias("ip"))


@query
def fn_geohash(spark, sf):
    lon, lat = "(rid * 7919) % 36001 / 100e0 - 180", "(rid * 104729) % 18301 / 100e0 - 90"
    points = adlog.ods(spark, sf).selectExpr("rid", f"{lon} as lon", f"{lat} as lat")
    return points.select("rid", place.geohash8(F.col("lon"), F.col("lat")).alias("geohash"))


@query
def fn_parse_districts(spark, sf):
    areas = place.districts_of_reply(F.col("response"))
    return adlog.replies(spark, sf).select("rid", areas.alias("areas"))


@query
def fn_salt(spark, sf):
    salted = salting.add_salt(F.col("channelid"), F.col("rid"))
    number = F.split(salted, salting.MARK)[0].cast("int")
    return adlog.ods(spark, sf).select(
        "rid",
        "channelid",
        number.between(0, 9).alias("in_range"),
        salting.remove_salt(salted).alias("unsalted"),
    )


@query
def fn_unsalt(spark, sf):
    salted = F.concat((F.col("rid") % 10).cast("string"), F.lit("#"), "keywords")
    return adlog.ods(spark, sf).select("rid", salting.remove_salt(salted).alias("key"))


@query
def fn_prefix(spark, sf):
    key = salting.add_prefix(F.col("rid") % 10, F.col("channelid"))
    return adlog.ods(spark, sf).select("rid", key.alias("key"))


@query
def fn_blank(spark, sf):
    return adlog.ods(spark, sf).select(
        "rid", *[text.not_blank(F.col(c)).alias(c) for c in ("imei", "mac", "idfa", "appname")]
    )


@query
def fn_safe_ratio(spark, sf):
    ratio = text.safe_ratio(F.col("adcreativeid"), F.col("requestmode") - 2)
    return adlog.ods(spark, sf).select("rid", F.round(ratio, 6).alias("ratio"))


# Districts, skew tools, SQL names


@query
def build_district_dictionary(spark, sf):
    return _districts(spark, sf)


@query
def build_district_dictionary_increment(spark, sf):
    """The dictionary of two days, the second of which reads out replies of its new locations only."""
    log, replies, work = adlog.ods(spark, sf), adlog.replies(spark, sf), Workspace(spark, "districts")
    first = places.extend_district_dictionary(None, log.where(F.col("dt") < TODAY), replies, work)
    stored = [work.save(df, name)[0] for df, name in ((first.dictionary, "dictionary"), (first.locations, "locations"))]
    return places.extend_district_dictionary(places.Districts(*stored), log.where(F.col("dt") >= TODAY), replies, work).dictionary


@query
def partition_profile(spark, sf):
    """One row per partition of the scan; told by what must hold, since the layout is the engine's."""
    profiled = aggregates.partition_profile(_lines(spark, sf))
    total = F.sum("rows").over(Window.partitionBy())
    # A scan has few partitions; each is named once and has rows.
    named = F.row_number().over(Window.partitionBy("partition").orderBy("rows")) == 1
    checked = profiled.select(total.alias("all_rows"), (named & (F.col("rows") > 0)).alias("sound"))
    return checked.distinct()


@query
def replicate_rows(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    copies = joins.replicate(customers, 10, "number")
    key = salting.add_prefix(F.col("number"), F.col("c_mktsegment"))
    return copies.select("c_custkey", key.alias("key"))


@query
def sql_functions(spark, sf):
    register_functions(spark)
    adlog.ods(spark, sf).createOrReplaceTempView("adlog_ods")
    return spark.sql("""
        select rid, geoHashCode(longitude, latitude) as geohash, prfiex(3, channelid) as prefixed,
          unPrifix(addPrifix(channelid, cast(rid as string))) as unsalted
        from adlog_ods""")
