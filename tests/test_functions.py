import random

import pytest
from pyspark.sql import functions as F

from adspindle.functions import place, salting, text
from adspindle.functions.registry import register_functions
from adspindle.operators import history
from tests.conftest import column


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").orderBy("i")


def apply(spark, function, values):
    return column(texts(spark, values).select(function(F.col("s"))))


def test_pieces_drop_only_trailing_empties(spark):
    given = ["a,b", "a,,b,,", "", ",a", ",,", None]
    assert apply(spark, text.pieces, given) == [["a", "b"], ["a", "", "b"], [""], ["", "a"], [], None]


def test_blank_covers_every_space_but_the_no_break_ones(spark):
    given = ["x", " \t", "", None, "　", " ", " ", " "]
    assert apply(spark, text.not_blank, given) == [True, False, False, False, False, False, True, True]


def test_ip_numbers(spark):
    given = ["1.2.3.4", "255.255.255.255", "0.0.0.0", "256.1.1.1", "1.2.3", "a.b.c.d", "", None]
    assert apply(spark, place.ip_to_long, given) == [16909060, 4294967295, 0, None, None, None, None, None]
    back = apply(spark, lambda s: place.long_to_ip(place.ip_to_long(s)), given)
    assert back == [*given[:3], None, None, None, None, None]


def test_province_and_city(spark):
    given = ["广东省广州市", "广东省", "北京市", "广西梧州市", "a省b省c", "省", "内蒙古", "", None]
    assert apply(spark, place.province, given) == ["广东省", "广东省", "北京市", "广西梧州市", "a省", "省", "内蒙古", "", None]
    assert apply(spark, place.city, given) == ["广州市", "广东省", "北京市", "广西梧州市", "b", "省", "内蒙古", "", None]


def test_area_and_private_address(spark):
    assert apply(spark, place.clean_area, [" CZ88.NET", "x", None]) == ["本机或本网络", "x", None]
    assert apply(spark, place.public_ip, ["192.168.1.1", "192.16.1.1", None]) == [None, "192.16.1.1", None]


def bisected(lon, lat):
    """The textbook geohash."""
    spans, bits = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}, []
    for i in range(40):
        span, value = spans[i % 2], (lon, lat)[i % 2]
        middle = (span[0] + span[1]) / 2
        bits.append(int(value >= middle))
        span[0 if value >= middle else 1] = middle
    letters = [int("".join(map(str, bits[i : i + 5])), 2) for i in range(0, 40, 5)]
    return "".join(place.GEOHASH_ALPHABET[n] for n in letters)


def test_geohash_equals_bisection(spark):
    pick = random.Random(7)
    points = [(pick.uniform(-180, 180), pick.uniform(-90, 90)) for _ in range(3000)]
    points += [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0), (-5.60302734375, 42.60498046875)]
    df = spark.createDataFrame(points, "lon double, lat double")
    for row in df.select("lon", "lat", place.geohash8(F.col("lon"), F.col("lat")).alias("g")).collect():
        assert row.g == bisected(row.lon, row.lat)
    odd = spark.createDataFrame([(None, 1.0), (1.0, None), (181.0, 0.0), (0.0, -90.5)], "lon double, lat double")
    assert column(odd.select(place.geohash8(F.col("lon"), F.col("lat")))) == [None] * 4


def test_geohash_stays_in_generated_code(spark):
    df = spark.range(10).select(place.geohash8(F.col("id"), F.col("id")).alias("g"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan


def test_geocoder_replies(spark):
    reply = '{"regeocode":{"addressComponent":{"businessAreas":%s}}}'
    given = {
        reply % "[[]]": "",
        reply % "[]": "",
        reply % '[{"location":"1,2","name":"a","id":"1"}]': "a",
        reply % '[{"name":"a"},{"name":"b"}]': "a,b",
        reply % '[{"id":"1"},{"name":"b"}]': "null,b",
        reply % '[null,{"name":"b"}]': "",
        "garbage": "",
        "{}": "",
        "": "",
        None: "",
    }
    assert apply(spark, place.districts_of_reply, given) == list(given.values())


def test_ratio_of_zero_denominator_is_null(spark):
    df = spark.sql("select * from values (1L, 2L), (3L, 0L), (0L, 0L), (null, 1L) t(a, b)")
    assert column(df.select(text.safe_ratio(F.col("a"), F.col("b")))) == [0.5, None, None, None]


def test_client_label(spark):
    df = spark.sql("select * from values (1L), (2L), (3L), (4L), (null) t(c)")
    assert column(df.select(text.client_label(F.col("c")))) == ["IOS", "android", "wp", "other", "other"]


def test_salts_cover_their_range_and_do_not_change(spark):
    df = spark.range(1000).select("id", salting.add_salt(F.lit("k#x"), F.col("id")).alias("s"))
    first, again = column(df.select("s")), column(df.repartition(3).orderBy("id").select("s"))
    assert first == again
    assert {s.split("#")[0] for s in first} == {str(i) for i in range(10)}
    assert column(df.select(salting.remove_salt(F.lit("3#key"))).limit(1)) == ["key"]


def test_sql_names(spark):
    assert register_functions(spark) == ["geoHashCode", "addPrifix", "unPrifix", "prfiex"]
    row = spark.sql(
        "select geoHashCode(116.3974, 39.9093) g, geoHashCode(null, 1) n, prfiex(3, 'k') p,"
        " unPrifix(addPrifix('k')) u, unPrifix(addPrifix('k', 'row 7')) v"
    ).first()
    assert tuple(row) == ("wx4g09q0", None, "3#k", "k", "k")


def parsed(spark, values):
    entries = apply(spark, history.parse_tag_string, values)
    return [None if e is None else [tuple(x) for x in e] for e in entries]


def test_parse_tag_string(spark):
    given = ["a -> 1.0,b -> 2.5", "a -> 1,b -> 3,a -> 2", "x -> y -> 4.0", "a -> q,b -> 1,,", "", "a", None]
    assert parsed(spark, given) == [
        [("a", 1.0), ("b", 2.5)],
        [("a", 2.0), ("b", 3.0)],
        [("x", 4.0)],
        [("b", 1.0)],
        [],
        [],
        None,
    ]
    assert apply(spark, history.bad_pieces, ["a -> q,b -> 1,,", "a -> 1", "a,,b -> 1"]) == [1, 0, 2]


def test_parse_undoes_format(spark):
    pick = random.Random(3)
    bags = [{f"T{pick.randrange(50)}_{n}": pick.random() * 10 for n in range(pick.randrange(1, 9))} for _ in range(200)]
    df = spark.createDataFrame([(b,) for b in bags], "tags map<string,double>")
    again = df.select("tags", history.parse_tag_map(history.format_tag_map(F.col("tags"))).alias("again"))
    assert all(r.tags == r.again for r in again.collect())


@pytest.mark.parametrize("digits, shown", [(None, "a -> 1.0,b -> 0.30000000000000004"), (6, "a -> 1.0,b -> 0.3")])
def test_format_sorts_by_tag(spark, digits, shown):
    df = spark.sql("select array(struct('b' as tag, 0.1D + 0.2D as weight), struct('a' as tag, 1D as weight)) as e")
    assert column(df.select(history.format_tag_string(F.col("e"), digits))) == [shown]
