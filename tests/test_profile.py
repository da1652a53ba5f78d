import pytest
from pyspark.sql import functions as F

from adspindle.operators import history, profile, tags
from adspindle.operators.identity import resolve_increment, resolve_users
from adspindle.operators.joins import gather
from adspindle.plans import profile as plan
from adspindle.schema import ODS_SCHEMA
from adspindle.sources.daily import StagedDay, in_buckets
from adspindle.sources.dictionary import device_dictionary
from tests.conftest import rows


def log_rows(spark, *given):
    return spark.createDataFrame([tuple(g.get(f.name) for f in ODS_SCHEMA.fields) for g in given], ODS_SCHEMA)


@pytest.fixture()
def lookups(spark):
    apps = spark.createDataFrame([("x1", "App One")], "key string, value string")
    districts = spark.createDataFrame([("wx4g09q0", "one,two,")], "geohash string, areas string")
    return plan.Lookups(apps, device_dictionary(spark), districts)


def tag_list(df, rules=tags.ALL_RULES):
    return [sorted(r.t) for r in df.select(tags.tag_set(rules).alias("t")).collect()]


def test_a_full_row(spark, lookups):
    row = dict(
        appid="x1", appname=" ", device="phone", client=2, ispname="移动", networkmannername="WIFI", devicetype=4,
        provincename="p", cityname="c", keywords="k,,k,m,", channelid="ch", age="30", sex="1",
        longitude=116.3974, latitude=39.9093, imei="i",
    )
    assert tag_list(plan.tagged_log(log_rows(spark, row), lookups)) == [sorted([
        "APP_App One", "DC_phone", "DT_D00010002", "ISP_D00030001", "NT_D00020001", "DET_4", "RN_p", "CT_c",
        "KW_k", "KW_", "KW_m", "CN_ch", "AGE_30", "SEX_1", "BA_one", "BA_two",
    ])]


def test_an_empty_row(spark, lookups):
    """Missing texts show as null, missing numbers as 0, unknown codes as nothing."""
    assert tag_list(plan.tagged_log(log_rows(spark, {}), lookups)) == [sorted([
        "APP_", "DC_null", "DT_", "ISP_", "NT_", "DET_0", "RN_null", "CT_null", "CN_null", "AGE_null", "SEX_null",
    ])]


@pytest.mark.parametrize("keywords, expected", [("a,b,,", ["KW_a", "KW_b"]), ("", ["KW_"]), (",a", ["KW_", "KW_a"]), (",,", []), (None, [])])
def test_keywords(spark, keywords, expected):
    assert tag_list(log_rows(spark, {"keywords": keywords}), [tags.keyword_rule]) == [expected]


def test_own_rules_can_be_added(spark):
    df = log_rows(spark, {"email": "a@b", "age": "3"}, {"age": "4", "email": None})
    rule = lambda: F.when(F.col("email").isNotNull(), F.array(F.concat(F.lit("MAIL_"), "email")))
    got = tags.tag_rows(df, ["age"], [tags.age_rule, rule])
    assert rows(got) == [("3", "AGE_3", 1.0), ("3", "MAIL_a@b", 1.0), ("4", "AGE_4", 1.0)]


def test_rows_are_tagged_once(spark, lookups):
    """The tag set is one expression of one explode; nothing evaluates the rules a second time."""
    tagged = tags.tag_rows(plan.tagged_log(log_rows(spark, {"imei": "a"}), lookups), ["imei"])
    text = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("array_distinct") == 1


def stored(spark, *given):
    texts = spark.createDataFrame(list(given), "userid string, allUserId string, tags string")
    return plan.History(*history.import_profiles(texts))


def profiles(df):
    return {r.userid: (r.allUserId, r.tags) for r in df.collect()}


def test_history_decays_and_joins_today(spark, lookups, workspace):
    today = log_rows(spark, {"imei": "b", "mac": "c", "age": "1"}, {"imei": "b", "age": "1"}, {"idfa": "z", "age": "2"}, {"imei": " "})
    past = stored(spark, ("a", "a,c", "AGE_1 -> 2.0,OLD -> 1.0"), ("q", "q", "OLD -> 3.0"))
    long, members = plan.user_profile_long(today, lookups, workspace, past, rules=[tags.age_rule])
    table = profile.profile_table(profile.fold_profiles(long, members), digits=6)
    assert profiles(table) == {
        "a": ("a,b,c", "AGE_1 -> 3.8,OLD -> 0.9"),
        "z": ("z", "AGE_2 -> 1.0"),
        "q": ("q", "OLD -> 2.7"),
    }


def as_of(df, day):
    return df.withColumn("as_of", F.to_date(F.lit(day), "yyyyMMdd"))


def on(day):
    return F.to_date(F.lit(day), "yyyyMMdd")


@pytest.mark.parametrize("limit", [2**27, 0])
def test_days_by_increment_are_the_full_job(spark, lookups, workspace, limit):
    """Each day added to what is stored gives what a resolution and decay of everything gives."""
    rules = [tags.age_rule, tags.channel_rule]
    days = [
        log_rows(spark, *[
            {"imei": f"i{(n * k) % 31}", "mac": f"m{n % 17}" if n % 3 == k % 3 else None, "age": str(n % 5), "channelid": f"c{k}"}
            for n in range(40)
        ])
        for k in (1, 2, 5, 7)
    ]
    full = history_now = None
    for number, log in enumerate(days):
        day = f"2024011{number}"
        full = plan.History(*plan.user_profile_long(log, lookups, workspace, full, rules=rules))
        full = plan.History(*(workspace.save(x, "full")[0] for x in (full.tags, full.ids)))
        if history_now is None:
            stored_tags, stored_ids = as_of(full.tags, day), full.ids
        else:
            stored_tags, stored_ids = plan.user_profile_increment(
                log, lookups, workspace, history_now, on(day), rules=rules, limit=limit, min_rows=20
            )
        history_now = plan.History(*(workspace.save(x, "stored")[0] for x in (stored_tags, stored_ids)))
        rounded = lambda df: rows(df.select("userid", "tag", F.round("weight", 6)))
        assert rounded(history.weights_on(history_now.tags, on(day))) == rounded(full.tags)
        assert rows(history_now.ids) == rows(full.ids)


def test_users_that_are_not_met_are_copied_as_they_are(spark, lookups, workspace):
    past = spark.createDataFrame([("a", "T", 2.0), ("b", "T", 3.0), ("c", "T", 4.0)], "userid string, tag string, weight double")
    ids = spark.createDataFrame([("a", "a"), ("b", "b"), ("c", "c"), ("c", "z")], "userid string, id string")
    log = log_rows(spark, {"imei": "z", "mac": "b", "age": "1"})
    found, members = plan.user_profile_increment(
        log, lookups, workspace, plan.History(as_of(past, "20240110"), ids), on("20240112"), rules=[tags.age_rule]
    )
    got = {(r.userid, r.tag): (round(r.weight, 6), str(r.as_of)) for r in found.collect()}
    assert got == {
        ("a", "T"): (2.0, "2024-01-10"),
        ("b", "T"): (round(7 * 0.81, 6), "2024-01-12"),
        ("b", "AGE_1"): (1.0, "2024-01-12"),
    }
    assert rows(members) == [("a", "a"), ("b", "b"), ("b", "c"), ("b", "z")]


def scans_under_exchange(df, column):
    """Whether a scan with a column is somewhere below an exchange, in the plan as it starts."""
    text = df._jdf.queryExecution().executedPlan().toString()
    found, open_ = [], []
    for line in text.split("== Initial Plan ==")[-1].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*("))
        open_ = [x for x in open_ if x[0] < depth]
        open_.append((depth, line))
        if "FileScan parquet" in line and f"{column}#" in line:
            found.append(any("Exchange" in above and "BroadcastExchange" not in above for _, above in open_))
    return found


@pytest.mark.parametrize("limit", [2**27, 0])
def test_stored_tags_are_not_shuffled(spark, workspace, tmp_path, limit):
    tag_table = spark.range(2000).selectExpr("cast(id % 500 as string) as userid", "cast(id as string) as tag", "1e0 as weight")
    id_table = spark.range(500).selectExpr("cast(id as string) as userid", "cast(id as string) as id")
    with StagedDay(spark, str(tmp_path), "20240101") as day:
        stored = day.write(in_buckets(as_of(tag_table, "20240101"), "userid"), "tags", bucket_by="userid")
        ids = day.write(in_buckets(id_table, "id"), "ids", bucket_by="id")
    records = spark.createDataFrame([("3", ["3", "4"]), ("new", ["new"])], "userid string, ids array<string>")
    increment = resolve_increment(records, ids, workspace, limit)
    assert increment.small == (limit > 0)
    today = spark.createDataFrame([("3", "T", 1.0)], "userid string, tag string, weight double")
    untouched, merged = plan.carried_tags(stored, today, increment, on("20240102"))
    assert scans_under_exchange(untouched, "weight") == [False]
    carried = history.weights_on(stored.join(increment.touched.hint("shuffle_hash"), "userid"), on("20240102"))
    assert scans_under_exchange(carried, "weight") == [False]
    assert untouched.count() == 1992 and merged.count() == 9
    # What was met is dealt into the buckets it is filed in.
    assert merged.rdd.getNumPartitions() == 4


def test_tag_rows_are_not_shuffled(spark, lookups, workspace):
    """Rows meet their user's others before they become tag rows; these are summed and folded where they arise."""
    today = log_rows(spark, *[{"imei": f"i{n % 7}", "mac": f"m{n % 5}" if n % 3 else None, "age": str(n % 4)} for n in range(40)])
    texts = [("i3", "i3,x", "AGE_0 -> 1.0,AGE_0 -> 2.0"), ("x", "x,m9", "AGE_1 -> 1.0"), (" ", "y", "AGE_2 -> 1.0"), ("q", "q", None)]
    past = plan.History.of_texts(spark.createDataFrame(texts, "userid string, allUserId string, tags string"))
    found, members = plan.user_profile_long(today, lookups, workspace, past)
    text = profile.fold_profiles(found, members)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1].split(")")[0] for line in text.splitlines() if "hashpartitioning(" in line]
    assert keys and not any("tag#" in k for k in keys)
    long_form, _ = plan.user_profile_long(today, lookups, workspace, plan.History(past.tags, past.ids))
    rounded = lambda df: rows(df.select("userid", "tag", F.round("weight", 6)))
    assert rounded(found) == rounded(long_form)
    assert ("q",) in rows(members.select("userid"))


def test_users_with_too_many_rows_are_dealt_to_several_tasks(spark, lookups, workspace):
    """Also one whose rows are spread over many identifiers, none of which is busy itself."""
    given = [{"imei": f"i{n}", "mac": "m" if n % 3 == 0 else f"m{n}", "age": str(n % 40)} for n in range(90)]
    users = resolve_users(plan.today_records(log_rows(spark, *given)), workspace, min_rows=10)
    assert not users.hot and users.hot_users == {}
    given = [{"imei": f"i{n}", "mac": "m" if n % 30 else f"m{n}", "age": str(n % 40)} for n in range(90)]
    log = log_rows(spark, *given)
    assert resolve_users(plan.today_records(log), workspace).hot_users == {}
    with_tasks = _with_partitions(spark, 24, lambda: resolve_users(plan.today_records(log), workspace, min_rows=10))
    assert not with_tasks.hot and with_tasks.hot_users == {"i1": 24}
    sets = with_tasks.relabel(plan.known_users(log, ["age"])).select("userid", F.array("age").alias("tags"))
    dealt = _with_partitions(spark, 24, lambda: rows(
        gather(sets, "userid", with_tasks.hot_users).select("userid", "tags", F.spark_partition_id().alias("task"))
    ))
    assert len(dealt) == 90 and len({t for u, _, t in dealt if u == "i1"}) > 4
    usual, _ = plan.user_profile_long(log, lookups, workspace, rules=[tags.age_rule])
    spread, _ = _with_partitions(spark, 24, lambda: [
        workspace.save(x, "x")[0] for x in plan.user_profile_long(log, lookups, workspace, rules=[tags.age_rule], min_rows=10)
    ])
    assert rows(spread) == rows(usual)


def _with_partitions(spark, n, run):
    names = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_of_large_lookup_tables_only_what_the_log_asks_for_is_joined(spark, workspace):
    apps = spark.range(5000).selectExpr("'x' || id as key", "'app' || id as value")
    districts = spark.createDataFrame([("wx4g09q0", "one"), ("00000000", "two")], "geohash string, areas string")
    log = log_rows(spark, {"appid": "x7", "longitude": 116.3974, "latitude": 39.9093}, {"appid": "x7"}, {"appid": "none"}, {})
    large = plan.Lookups(apps, device_dictionary(spark), districts).stored(workspace, limit=0)
    assert (large.small_apps, large.small_districts) == (False, False)
    used = large.used_by(log, workspace)
    assert rows(used.apps) == [("x7", "app7")] and rows(used.districts) == [("wx4g09q0", "one")]
    assert (used.small_apps, used.small_districts) == (True, True)
    assert sorted(tag_list(plan.tagged_log(log, used))) == sorted(tag_list(plan.tagged_log(log, large)))
    small = plan.Lookups(apps, device_dictionary(spark), districts).stored(workspace)
    assert small.used_by(log, workspace) is small


def test_resolving_in_two_steps_gives_the_same(spark, lookups, workspace):
    today = log_rows(spark, *[{"imei": f"i{n % 7}", "mac": f"m{n % 5}" if n % 3 else None, "age": str(n % 4)} for n in range(40)])
    past = stored(spark, ("i3", "i3,x", "AGE_0 -> 1.0"), ("x", "x,m9", "AGE_1 -> 1.0"))
    at_once = plan.user_profile_long(today, lookups, workspace, past, rules=[tags.age_rule])[0]

    first = plan.History(*plan.user_profile_long(today, lookups, workspace, rules=[tags.age_rule]))
    nothing = log_rows(spark, {})
    older = plan.History(history.decay_tags(past.tags), past.ids)
    both = plan.History(first.tags.unionByName(older.tags), first.ids.unionByName(older.ids))
    in_steps = plan.user_profile_long(nothing, lookups, workspace, both, factor=1.0)[0]
    rounded = lambda df: rows(df.select("userid", "tag", F.round("weight", 6)))
    assert rounded(at_once) == rounded(in_steps)


def test_texts_that_cannot_hold_a_profile_are_told(spark):
    given = [("plain", ["plain", "b"], "APP_x"), ("comma", ["comma"], "APP_Word, Excel"), ("arrow", ["arrow"], "KW_a -> b"), ("id", ["a,1"], "SEX_1")]
    tags_long = spark.createDataFrame([(u, t, 2.0) for u, _, t in given], "userid string, tag string, weight double")
    members = spark.createDataFrame([(u, i) for u, ids, _ in given for i in ids], "userid string, id string")
    folded = profile.fold_profiles(tags_long, members)
    assert rows(folded.where(profile.reads_back()).select("userid")) == [("plain",)]


def test_unreadable_texts_are_not_imported_silently(spark):
    texts = spark.createDataFrame([("u", "u,v", "A -> 1.0,broken -> x"), (" ", "w", "B -> 1.0")], "userid string, allUserId string, tags string")
    with pytest.raises(ValueError):
        history.import_profiles(texts)
    tags_long, ids = history.import_profiles(texts, allow_bad=True)
    assert rows(tags_long) == [("u", "A", 1.0)] and rows(ids) == [("u", "u"), ("u", "v")]


@pytest.mark.parametrize("limit, min_rows", [(0, 1), (0, 10**6), (2**27, 10**6)])
def test_profiles_are_the_same_on_every_path(spark, lookups, workspace, limit, min_rows):
    today = log_rows(spark, *[{"imei": "hot" if n % 3 == 0 else f"i{n}", "mac": f"m{n % 11}", "age": str(n % 4)} for n in range(90)])
    past = stored(spark, *[("hot", f"hot,x{n}", f"OLD_{n} -> 1.0") for n in range(20)])
    found, members = plan.user_profile_long(today, lookups, workspace, past, limit=limit, min_rows=min_rows)
    usual, usual_members = plan.user_profile_long(today, lookups, workspace, past)
    rounded = lambda df: rows(df.select("userid", "tag", F.round("weight", 6)))
    assert rounded(found) == rounded(usual) and rows(members) == rows(usual_members)


def test_tagging_reads_the_same_columns_on_both_paths(spark, lookups, workspace, tmp_path):
    log_rows(spark, *[{"imei": f"i{n % 3}", "mac": f"m{n}"} for n in range(60)]).write.parquet(str(tmp_path / "log"))
    ods = spark.read.parquet(str(tmp_path / "log"))

    def read_columns(limit):
        users = resolve_users(plan.today_records(ods), workspace, limit, min_rows=1)
        assert users.small == (limit > 0)
        found = tags.tag_rows(users.relabel(plan.known_users(ods, ["age", "sex"])), ["userid"], [tags.age_rule, tags.sex_rule])
        plan_text = found._jdf.queryExecution().executedPlan().toString()
        (schema,) = [line for line in plan_text.splitlines() if "FileScan parquet" in line and "age#" in line]
        return schema.split("FileScan parquet [")[1].split("]")[0].count("#")

    assert read_columns(2**27) == read_columns(0) == 7


def test_a_day_without_identifiers(spark, lookups, workspace):
    found, members = plan.user_profile_long(log_rows(spark, {"age": "1"}, {"imei": " "}), lookups, workspace)
    assert found.count() == 0 and members.count() == 0


def test_tag_map(spark):
    weights = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "userid string, tag string, weight double")
    members = spark.createDataFrame([("a", "a"), ("a", "b")], "userid string, id string")
    row = profile.with_tag_map(profile.fold_profiles(weights, members)).first()
    assert (row.ids, row.tags) == (["a", "b"], {"x": 1.0, "y": 2.0})
