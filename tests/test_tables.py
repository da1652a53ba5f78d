import pytest
from pyspark.sql import functions as F

from adspindle.operators.funnel import REPORT_COLUMNS, ad_funnel
from adspindle.plans import reports
from adspindle.plans.daily import (
    DISTRICTS, ODS, PROFILE_IDS, TABLE_KEYS, TAGS, UNREADABLE, DayInputs, run_day, stored_profiles,
)
from adspindle.schema import ODS_COLUMNS, ODS_SCHEMA, RAW_COLUMNS
from adspindle.sources.adlog import read_ad_log
from adspindle.sources.daily import (
    StagedDay, published, read_daily, repeated_keys, require_unique, today_keys, write_daily,
)
from adspindle.sources.dictionary import read_dictionary
from adspindle.sources.workspace import work_root
from tests.conftest import rows
from workload import adlog

SF = "/root/testdata/sf0.001"


def test_schema_sizes():
    assert len(ODS_COLUMNS) == len(set(ODS_COLUMNS)) == 89 and len(RAW_COLUMNS) == 85


def test_work_root_is_the_sessions(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_dictionary_lines(spark, tmp_path):
    (tmp_path / "d").write_text("a##1\nb##x##2\nself\ntail##\n##nokey\n##\na##3\na###\n", encoding="utf8")
    assert dict(rows(read_dictionary(spark, str(tmp_path / "d")))) == {
        "a": "#", "b": "2", "self": "self", "tail": "tail", "": "nokey",
    }


def test_json_log(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"ip":"1.1.1.1","client":2,"winprice":1.5}\nnot json\n{"ip":null}\n')
    log = read_ad_log(spark, str(tmp_path / "log.json"), keep_corrupt=True)
    assert rows(log.select("ip", "client", "winprice", "_corrupt_record")) == rows(
        spark.createDataFrame(
            [("1.1.1.1", 2, 1.5, None), (None, None, None, "not json"), (None, None, None, None)],
            "a string, b long, c double, d string",
        )
    )


def test_daily_tables_replace_only_their_day(spark, tmp_path):
    root = str(tmp_path)
    day = lambda n: spark.createDataFrame([(k, n) for k in "abc"], "k string, n int")
    write_daily(day(1), root, "t", "20240101", ["k"], 3)
    write_daily(day(2), root, "t", "20240102", ["k"])
    write_daily(day(3), root, "t", "20240102")
    assert rows(read_daily(spark, root, "t", "20240101")) == [(k, 1, "20240101") for k in "abc"]
    assert rows(read_daily(spark, root, "t", "20240102")) == [(k, 3, "20240102") for k in "abc"]


def test_a_table_that_breaks_its_key_is_not_published(spark, tmp_path):
    root, day = str(tmp_path), spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    write_daily(day, root, "t", "20240101", ["k"])
    with pytest.raises(ValueError, match="repeat the key"):
        write_daily(day.unionByName(day), root, "t", "20240101", ["k"])
    assert rows(read_daily(spark, root, "t", "20240101").drop("dt")) == [("a", 1), ("b", 2)]
    # Nothing is left of the version that was refused.
    assert len(list((tmp_path / "t" / "dt=20240101").iterdir())) == 1
    with pytest.raises(ValueError, match="no table"):
        read_daily(spark, root, "t", "20240102")


def test_versions_of_a_day(spark, tmp_path):
    root = str(tmp_path)
    number = lambda n: spark.createDataFrame([("a", n)], "k string, n int")
    with StagedDay(spark, root, "20240101") as day:
        day.write(number(1), "t")
        day.write(number(10), "other")
        day.write(number(2), "t")  # written again before anyone sees it
        assert published(spark, root, "20240101") == {}
    reading = read_daily(spark, root, "t", "20240101")
    write_daily(number(3), root, "t", "20240101")
    # Who began to read the version before can go on; the one before that is gone.
    assert rows(reading) == [("a", 2, "20240101")]
    assert rows(read_daily(spark, root, "t", "20240101")) == [("a", 3, "20240101")]
    write_daily(number(4), root, "t", "20240101")
    assert len(list((tmp_path / "t" / "dt=20240101").iterdir())) == 2
    assert rows(read_daily(spark, root, "other", "20240101")) == [("a", 10, "20240101")]


def test_bucketed_tables_are_read_in_buckets(spark, tmp_path):
    with StagedDay(spark, str(tmp_path), "20240101") as day:
        many = spark.range(1000).selectExpr("cast(id % 300 as string) as k", "id as n")
        written = day.write(many.repartition(4, "k"), "t", ["n"], bucket_by="k")
        day.write(many.where("n < 0"), "none", ["n"], bucket_by="k")
        assert rows(written) == rows(many)
    found = read_daily(spark, str(tmp_path), "t", "20240101")
    counted = found.groupBy("k").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.count() == 300
    assert read_daily(spark, str(tmp_path), "none", "20240101").count() == 0
    assert read_daily(spark, str(tmp_path), "none", "20240101").columns == ["k", "n", "dt"]


def test_versions_that_are_gone_are_not_in_the_catalog(spark, tmp_path):
    before = len(spark.catalog.listTables())
    for n in range(5):
        with StagedDay(spark, str(tmp_path), "20240101") as day:
            day.write(spark.range(n), "t", bucket_by="id")
    # The published version and the one it has replaced.
    assert len(spark.catalog.listTables()) == before + 2
    with pytest.raises(ValueError):
        with StagedDay(spark, str(tmp_path), "20240101") as day:
            day.write(spark.range(3).selectExpr("1 as id"), "t", ["id"], bucket_by="id")
    assert len(spark.catalog.listTables()) == before + 2
    assert read_daily(spark, str(tmp_path), "t", "20240101").count() == 4


@pytest.mark.parametrize("broken", ["ad_region_analysis", TAGS, PROFILE_IDS])
def test_a_day_that_fails_leaves_the_old_one(spark, tmp_path, monkeypatch, broken):
    root, log = str(tmp_path), adlog.raw_log(spark, SF).where("rid < 400")
    run_day(spark, root, "20240115", day_inputs(spark, log))
    before = {name: rows(read_daily(spark, root, name, "20240115")) for name in (ODS, *TABLE_KEYS)}
    write = StagedDay.write

    def failing(self, df, name, *args, **options):
        if name == broken:
            # A table whose key does not hold.
            df = df.unionByName(df)
        return write(self, df, name, *args, **options)

    monkeypatch.setattr(StagedDay, "write", failing)
    with pytest.raises(ValueError, match="repeat the key"):
        run_day(spark, root, "20240115", day_inputs(spark, log.where("rid < 200")))
    assert {name: rows(read_daily(spark, root, name, "20240115")) for name in (ODS, *TABLE_KEYS)} == before
    assert all(len(list((tmp_path / name / "dt=20240115").iterdir())) == 1 for name in (ODS, *TABLE_KEYS))


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, n int")
    assert rows(repeated_keys(df, ["k"])) == [("a", 2)]
    with pytest.raises(ValueError):
        require_unique(df, ["k"])
    assert require_unique(df.distinct(), ["k"]).count() == 3


def test_today_keys(spark):
    today, yesterday = today_keys(spark)
    assert len(today) == len(yesterday) == 8 and yesterday < today


def test_funnel_counts_add_up(spark):
    log = adlog.ods(spark, SF)
    counts = [c for c in REPORT_COLUMNS if c.endswith("_num")]
    whole = log.groupBy().agg(F.count(F.lit(1)))
    for dims in reports.FUNNEL_REPORTS.values():
        report = ad_funnel(log, dims)
        total = report.agg(*[F.sum(c).alias(c) for c in counts]).first()
        assert total == ad_funnel(log.withColumn("all", F.lit(1)), ["all"]).select(*counts).first()
    assert reports.report_province_city(log).agg(F.sum("number")).first()[0] == whole.first()[0]


def test_funnel_of_rows_without_values(spark):
    report = ad_funnel(spark.createDataFrame([tuple([None] * 89)], ODS_SCHEMA), ["channelid"]).first()
    assert report["org_request_num"] == 0 and report["bid_success_rat"] is None and report["dsp_cost"] == 0.0


def test_bundle_holds_every_report(spark):
    log = adlog.ods(spark, SF)
    bundle = reports.report_bundle(log).cache()
    singles = {
        "ad_region_analysis": reports.report_ad_region(log),
        "app_analysis": reports.report_ad_app(log),
        "ad_device_type_analysis": reports.report_ad_device(log, group_label=True),
        "ad_network_analysis": reports.report_ad_network(log),
        "ad_operator_analysis": reports.report_ad_operator(log),
        "ad_channel_analysis": reports.report_ad_channel(log),
        reports.COUNT_REPORT: reports.report_province_city(log),
    }

    def exact(df):
        return rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]))

    for name, single in singles.items():
        assert exact(reports.report_of_bundle(bundle, name)) == exact(single), name
    bundle.unpersist()


def test_bundle_reads_the_log_once(spark):
    plan = reports.report_bundle(adlog.ods(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "partial_sum" in plan or "partial_count" in plan


@pytest.mark.parametrize("by_tuples", [True, False, None])
def test_bundle_by_tuples(spark, by_tuples):
    log = adlog.ods(spark, SF)
    usual, other = reports.report_bundle(log, by_tuples=False), reports.report_bundle(log, by_tuples)
    exact = lambda df: rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]))
    assert exact(other) == exact(usual)
    empty = log.where("rid < 0")
    assert reports.report_bundle(empty, by_tuples).count() == 0


def test_tuples_are_expanded_instead_of_rows(spark):
    """Rows of few tuples are brought down before they are copied for each grouping."""
    dims = [d for key in reports.FUNNEL_REPORTS.values() for d in key]
    log = adlog.ods(spark, SF).withColumns({d: F.lit("x") for d in dims if d not in ("client", "networkmannerid")})
    assert reports.fewer_tuples(log, dims) and not reports.fewer_tuples(adlog.ods(spark, SF), ["rid"])
    plan_text = reports.report_bundle(log)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = [line for line in plan_text.splitlines() if "Expand" in line or "Exchange" in line or "FileScan" in line]
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    # Read from below: scan, shuffle of tuples, expand, shuffle of groups.
    assert any("Exchange" in line for line in lines[expand + 1 :]) and "FileScan" in lines[-1]
    direct = reports.report_bundle(log, by_tuples=False)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = [line for line in direct.splitlines() if "Expand" in line or "Exchange" in line]
    assert "Expand" in lines[-1]


def test_an_empty_rerun_empties_the_day(spark, tmp_path):
    root, day = str(tmp_path), spark.createDataFrame([("a", 1)], "k string, n int")
    for keys in ([], ["k"]):
        write_daily(day, root, "t", "20240101", keys)
        write_daily(day.where("n > 1"), root, "t", "20240101", keys)
        assert read_daily(spark, root, "t", "20240101").count() == 0
        write_daily(day.where("n > 1"), root, "first" + "".join(keys), "20240101", keys)
        assert read_daily(spark, root, "first" + "".join(keys), "20240101").columns == ["k", "n", "dt"]


def day_inputs(spark, log, replies=None):
    return DayInputs(
        log, adlog.ip_ranges(spark, SF), replies if replies is not None else adlog.replies(spark, SF),
        adlog.app_dictionary(spark, SF), adlog.devices(spark),
    )


def test_two_days(spark, tmp_path):
    root, log = str(tmp_path), adlog.raw_log(spark, SF)
    run_day(spark, root, "20240115", day_inputs(spark, log.where("dt < '20240116'")))
    run_day(spark, root, "20240116", day_inputs(spark, log.where("dt >= '20240116'")), previous_dt="20240115")
    first, second = (stored_profiles(spark, root, dt).tags for dt in ("20240115", "20240116"))
    ods = read_daily(spark, root, ODS, "20240116")
    assert ods.count() == log.where("dt >= '20240116'").count()
    assert not set(ODS_COLUMNS) - set(ods.columns)
    assert set(TABLE_KEYS) == {*reports.FUNNEL_REPORTS, reports.COUNT_REPORT, DISTRICTS, TAGS, PROFILE_IDS}
    assert second.count() > 0 and first.count() > 0
    # No user's weights are lost: the first day's come back decayed, the second's are added.
    weights = lambda df: df.agg(F.sum("weight")).first()[0]
    run_day(spark, root + "/alone", "20240116", day_inputs(spark, log.where("dt >= '20240116'")))
    alone = read_daily(spark, root + "/alone", TAGS, "20240116")
    assert weights(second) == pytest.approx(0.9 * weights(first) + weights(alone))


def test_unreadable_lines_are_kept_apart(spark, tmp_path):
    log = adlog.raw_log(spark, SF).where("rid < 60").drop("rid", "dt")
    log.coalesce(1).write.json(str(tmp_path / "log"))
    (tmp_path / "log" / "more.json").write_text('not json\n{"ip": "1.2.3.4", "client": tru\n')
    read = read_ad_log(spark, str(tmp_path / "log"), keep_corrupt=True)
    run_day(spark, str(tmp_path / "days"), "20240115", day_inputs(spark, read))
    lines = read_daily(spark, str(tmp_path / "days"), UNREADABLE, "20240115")
    assert sorted(r["line"] for r in lines.collect()) == ["not json", '{"ip": "1.2.3.4", "client": tru']
    assert read_daily(spark, str(tmp_path / "days"), ODS, "20240115").count() == 60
    run_day(spark, str(tmp_path / "plain"), "20240115", day_inputs(spark, log))
    assert UNREADABLE not in published(spark, str(tmp_path / "plain"), "20240115")


def test_days_without_replies_or_identifiers(spark, tmp_path):
    root, log = str(tmp_path), adlog.raw_log(spark, SF)
    garbage = adlog.replies(spark, SF).withColumn("response", F.lit("garbage"))
    run_day(spark, root, "20240115", day_inputs(spark, log, garbage))
    assert read_daily(spark, root, DISTRICTS, "20240115").count() == 0
    before = read_daily(spark, root, TAGS, "20240115")
    assert before.count() > 0
    nobody = log.withColumns({c: F.lit(None).cast("string") for c in ("imei", "mac", "idfa", "openudid", "androidid")})
    run_day(spark, root, "20240116", day_inputs(spark, nobody), previous_dt="20240115")
    after = read_daily(spark, root, TAGS, "20240116")
    assert after.count() == before.count()
    run_day(spark, root, "20240117", day_inputs(spark, nobody.where("rid < 0")))
    assert read_daily(spark, root, TAGS, "20240117").count() == 0
    assert read_daily(spark, root, ODS, "20240117").count() == 0
