import bisect
import random

import pytest
from pyspark.sql import functions as F

from adspindle.operators import places
from adspindle.operators.joins import BROADCAST_BYTES
from adspindle.plans.ingest import enrich_log
from adspindle.sources.workspace import Workspace
from tests.conftest import rows
from workload import adlog

RANGE = "ip_start long, ip_end long, country string, area string, longitude double, latitude double"


def ranges(spark, spans):
    data = [(a, b, f"c{a}", f"a{b}", a % 360 - 180.0, b % 180 - 90.0) for a, b in spans]
    return spark.createDataFrame(data, RANGE)


def dotted(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def disjoint(seed, count, widest):
    pick, spans, at = random.Random(seed), [], 0
    for _ in range(count):
        at += pick.choice([0, 1, pick.randrange(1, widest)])
        end = at + pick.choice([0, pick.randrange(widest)])
        spans.append((at, end))
        at = end + 1
    return spans


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
@pytest.mark.parametrize("widest", [300, 70_000, 3_000_000])
def test_range_join_equals_a_scan_of_the_ranges(spark, limit, widest):
    spans = disjoint(widest, 200, widest)
    pick, top = random.Random(1), max(end for _, end in spans) + widest
    asked = [pick.randrange(top) for _ in range(600)] + [n for span in spans for n in span]
    asked += [spans[0][0]] * 500  # a hot address
    log = spark.createDataFrame([(i, dotted(n)) for i, n in enumerate(asked)], "rid int, ip string")
    found = places.ip_range_join(log, ranges(spark, spans), limit=limit).collect()
    assert len(found) == len(asked)
    for row in found:
        n = asked[row.rid]
        hit = next(((a, b) for a, b in spans if a <= n <= b), None)
        assert (row.country, row.area) == ((f"c{hit[0]}", f"a{hit[1]}") if hit else ("未知国家", "未知地区"))
        assert (row.longitude is None) == (hit is None)


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_missing_and_malformed_addresses_have_no_place(spark, limit):
    log = spark.createDataFrame([("1.2.3",), (None,), ("0.0.0.5",), ("9.9.9.9",)], "ip string")
    found = places.ip_range_join(log, ranges(spark, [(0, 10)]), limit=limit)
    assert rows(found.select("ip", "country")) == rows(
        spark.createDataFrame([("1.2.3", None), (None, None), ("0.0.0.5", "c0"), ("9.9.9.9", "未知国家")], "ip string, c string")
    )


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_overlapping_ranges_never_multiply_rows(spark, limit):
    log = spark.range(0, 400).select(F.concat(F.lit("0.0.0."), F.col("id") % 200).alias("ip"))
    found = places.ip_range_join(log, ranges(spark, [(0, 150), (10, 20), (10, 20), (15, 180)]), limit=limit)
    assert found.count() == 400
    named = {r.ip: r.country for r in found.collect()}
    assert (named["0.0.0.9"], named["0.0.0.12"], named["0.0.0.17"]) == ("c0", "c10", "c15")


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_nested_ranges_across_blocks(spark, limit):
    """The greatest start at or below an address decides, also where a wide range goes on in later blocks."""
    pick = random.Random(4)
    spans = [(0, 200_000), (10, 20)]
    spans += [(a, a + pick.choice([0, 50, 3000, 90_000, 400_000])) for a in pick.sample(range(300_000), 400)]
    spans += [(70_000 + 3 * i, 70_000 + 3 * i + i % 5) for i in range(900)]  # a dense block
    asked = [50, 15, 20, 21, 65_536, 70_000] + [pick.randrange(500_000) for _ in range(1500)]
    log = spark.createDataFrame([(i, dotted(n)) for i, n in enumerate(asked)], "rid int, ip string")
    widest = {}
    for a, b in spans:
        widest[a] = max(b, widest.get(a, b))
    starts = sorted(widest)
    for row in places.ip_range_join(log, ranges(spark, spans), limit=limit).collect():
        at = bisect.bisect_right(starts, asked[row.rid]) - 1
        hit = at >= 0 and asked[row.rid] <= widest[starts[at]]
        assert row.country == (f"c{starts[at]}" if hit else "未知国家")


def test_no_address_meets_many_ranges(spark):
    dense = [(a, a) for a in range(0, 65_536, 2)] + [(70_000, 400_000), (500_000, 500_100)]
    cut = places.block_ranges(ranges(spark, dense))
    most = cut.groupBy("block", "cell").count().agg(F.max("count")).first()[0]
    assert most <= places.DENSE_RANGES
    assert rows(cut.where("low > 65536").select("cell").distinct()) == [(places.WHOLE_BLOCK,)]


def test_copies_of_a_range_are_one_range(spark):
    copies = ranges(spark, [(0, 10), (20, 200_000)]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500))))
    assert places.block_ranges(copies).count() == 5
    assert places.block_ranges(ranges(spark, [(0, 10), (0, 30), (0, 20)])).select("high").first()[0] == 30


def test_wide_ranges_add_one_row_per_block(spark):
    whole = places.block_ranges(ranges(spark, [(0, 2**32 - 1)]))
    assert whole.count() == 65536


def test_broadcast_plan_does_not_shuffle_the_log(spark):
    log = spark.createDataFrame([("0.0.0.1",)], "ip string")
    plan = places.ip_range_join(log, ranges(spark, [(0, 10)]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # The only shuffles are those of the range table, below its broadcast.
    assert "Exchange" not in plan.split("BroadcastExchange")[0]


def test_enrichment_keeps_every_row_once(spark):
    log = spark.createDataFrame([(i, "0.0.0.7" if i % 3 else None) for i in range(30)], "rid int, ip string")
    enriched = places.ip_geo_enrich(log, ranges(spark, [(0, 10)]))
    assert enriched.count() == 30
    assert rows(enriched.select("region", "city").distinct()) == [("c0", "c0"), (None, None)]


def test_one_row_per_cell(spark):
    found = places.one_row_per_geohash(
        spark.createDataFrame([("g1", "b,a"), ("g1", "c,a"), ("g1", "b,a"), ("g2", "z")], "geohash string, areas string")
    )
    assert rows(found) == [("g1", "a,b,c"), ("g2", "z")]


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_district_join_keeps_rows_without_coordinates(spark, limit):
    log = spark.createDataFrame([(1, 116.3974, 39.9093), (2, None, 1.0), (3, 0.0, 0.0)], "rid int, longitude float, latitude float")
    districts = spark.createDataFrame([("wx4g09q0", "a,b")], "geohash string, areas string")
    joined = places.geohash_district_join(log, districts, limit)
    assert rows(joined.select("rid", "areas")) == [(1, "a,b"), (2, None), (3, None)]


def test_dictionary_only_covers_places_of_the_log(spark):
    reply = '{"regeocode":{"addressComponent":{"businessAreas":[{"name":"%s"}]}}}'
    replies = spark.createDataFrame(
        [(116.3974, 39.9093, reply % "x"), (116.3974, 39.9093, reply % "w"), (1.0, 1.0, reply % "y"), (2.0, 2.0, "broken")],
        "longitude double, latitude double, response string",
    )
    log = spark.createDataFrame([(116.3974, 39.9093), (116.3974, 39.9093), (2.0, 2.0), (None, 1.0)], "longitude float, latitude float")
    assert rows(places.build_district_dictionary(log, replies)) == [("wx4g09q0", "w,x")]


class Counted(Workspace):
    """A workspace that remembers how many rows it has written under which names."""

    def __init__(self, spark):
        super().__init__(spark, "counted")
        self.rows = {}

    def save(self, df, name, **metrics):
        table, seen = super().save(df, name, **metrics)
        self.rows[name] = seen["rows"]
        return table, seen


@pytest.mark.parametrize("limit", [2**27, 0])
def test_a_dictionary_extended_day_by_day_is_the_dictionary_of_all(spark, limit):
    def reply(*names):
        return '{"regeocode":{"addressComponent":{"businessAreas":[' + ",".join(f'{{"name":"{n}"}}' for n in names) + "]}}}"

    # Three places share a cell, one has no name at first, and one never.
    spots = [(10.0, 20.0), (10.00001, 20.0), (10.00002, 20.00001), (30.5, 40.5), (50.0, 60.0), (70.0, 80.0)]
    answers = [reply("a", "c"), reply("b"), reply("a", "d"), reply("x"), reply(), "garbage"]
    replies = spark.createDataFrame([(*s, r) for s, r in zip(spots, answers)] * 2, "longitude float, latitude float, response string")
    late = replies.unionByName(spark.createDataFrame([(50.0, 60.0, reply("late"))], replies.schema))
    log = lambda *at: spark.createDataFrame([spots[i] for i in at] + [(None, 1.0)], "longitude float, latitude float")
    days = [((0, 4, 5), replies), ((0, 1, 3), replies), ((2, 4, 3), late), ((), late)]
    stored, asked = None, set()
    for at, known in days:
        work = Counted(spark)
        found = places.extend_district_dictionary(stored, log(*at), known, work, limit)
        new = {i for i in at if i not in asked}
        assert work.rows["new-locations"] == len(new) and work.rows["new-districts"] <= len(new)
        stored = places.Districts(*[work.save(df, "stored")[0] for df in (found.dictionary, found.locations)])
        asked |= {i for i in at if known is late or i not in (4, 5)} - {5}
    want = places.build_district_dictionary(log(*range(6)), late)
    assert rows(stored.dictionary) == rows(want)
    assert stored.locations.count() == len(asked) == stored.locations.distinct().count()


def test_a_wide_log_runs_in_methods_that_are_compiled(spark, tmp_path):
    """A compact file of events is dealt to all tasks, and no generated method is too large for the JVM."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    day = F.expr("timestamp'2024-01-15 00:00:00' + make_interval(0, 0, 0, id % 3)")
    events = spark.range(400).select(
        F.expr("id - id % 200 % 2").alias("event_id"), day.alias("ts"), (F.col("id") % 9).alias("user_id"),
        F.lit("view").alias("event_type"), (F.col("id") / 7).alias("value"),
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    try:
        spark.conf.unset(limit)
        log = adlog.raw_log(spark, str(tmp_path), spread=True)
        assert rows(log) == rows(adlog.raw_log(spark, str(tmp_path)))
        used = log.groupBy(F.spark_partition_id()).count()
        assert used.count() > spark.sparkContext.defaultParallelism
        found = enrich_log(log, ranges(spark, [(0, 10)]))
        assert int(spark.conf.get(limit)) <= 8000 and found.count() == 400
        spark.conf.set(limit, 100)
        enrich_log(log, ranges(spark, [(0, 10)]))
        assert spark.conf.get(limit) == "100"
    finally:
        spark.conf.set(limit, before)


def test_replies_are_read_out_once_and_not_next_to_the_scan(spark, tmp_path):
    replies = spark.createDataFrame([(1.0, 2.0, "garbage")] * 3, "longitude double, latitude double, response string")
    replies.write.parquet(str(tmp_path / "replies"))
    found = places.distinct_districts(spark.read.parquet(str(tmp_path / "replies")).distinct())
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in text and "from_json" not in text.split("Aggregate")[-1]
    assert text.count("from_json") <= 2 and rows(found) == []
