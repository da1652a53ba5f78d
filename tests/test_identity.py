import random

import pytest
from pyspark.sql import functions as F

from adspindle.operators import identity
from adspindle.sources.workspace import Workspace
from tests.conftest import rows


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


def components(spark, workspace, edges, hub_rows=10**6):
    df = spark.createDataFrame(edges, "u string, v string")
    found = identity.connected_components(df, workspace, hub_rows)
    ids = df.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    return {r.id: r.component for r in identity.all_components(ids, found).collect()}


def random_edges(seed, people, links):
    pick = random.Random(seed)
    return [(f"id{pick.randrange(people)}", f"id{pick.randrange(people)}") for _ in range(links)]


@pytest.mark.parametrize("seed, people, links, hub_rows", [(1, 400, 300, 10**6), (2, 400, 300, 2), (3, 300, 900, 5)])
def test_random_graphs(spark, workspace, seed, people, links, hub_rows):
    edges = random_edges(seed, people, links)
    assert components(spark, workspace, edges, hub_rows) == union_find(edges)


def test_shuffled_path(spark, workspace):
    names = [f"n{i:04d}" for i in range(256)]
    random.Random(5).shuffle(names)
    found = components(spark, workspace, list(zip(names, names[1:])))
    assert set(found.values()) == {"n0000"} and len(found) == 256


def test_hub_shared_by_a_third_of_the_rows(spark, workspace):
    """A default identifier makes one large star next to many small groups."""
    pick = random.Random(11)
    edges = [("zz-default", f"a{i}") for i in range(1500)] + [(f"b{i}", "00-default") for i in range(700)]
    edges += [(f"c{pick.randrange(900)}", f"d{pick.randrange(900)}") for _ in range(1500)]
    pick.shuffle(edges)
    assert components(spark, workspace, edges, hub_rows=50) == union_find(edges)


def test_order_of_rows_does_not_matter(spark, workspace):
    edges = random_edges(9, 200, 150)
    turned = [(b, a) for a, b in reversed(edges)]
    assert components(spark, workspace, edges) == components(spark, workspace, turned * 2)


def test_no_edges(spark, workspace):
    assert components(spark, workspace, [("a", "a")]) == {"a": "a"}


LOG = "imei string, mac string, idfa string, openudid string, androidid string"


def test_blank_identifiers_do_not_count(spark):
    df = spark.createDataFrame([("", "m", " ", None, "a"), (" ", None, "", "\t", None), ("i", "i", None, None, "z")], LOG)
    picked = df.select(identity.first_id().alias("userid"), identity.identity_ids().alias("ids"))
    assert [tuple(r) for r in picked.collect()] == [("m", ["m", "a"]), (None, []), ("i", ["i", "i", "z"])]


def test_records_keep_their_copies(spark, workspace):
    records = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("alone", 3)], "userid string, x int")
    edges = spark.createDataFrame([("b", "a")], "u string, v string")
    found = identity.connected_components(edges, workspace)
    expected = [("a", 1, "a"), ("a", 1, "a"), ("alone", 3, "alone"), ("b", 2, "a")]
    assert rows(identity.attach_component(records, found)) == expected
    assert rows(identity.attach_component(records, found, small=False, hot=["a"])) == expected
    members = identity.all_components(spark.createDataFrame([("a",), ("b",), ("alone",)], "id string"), found)
    assert rows(identity.component_attach_join(records, members)) == expected
    assert rows(identity.canonical_user_id(members)) == [("a", "a"), ("alone", "alone")]


def test_numbers_follow_the_order_of_identifiers(spark, workspace):
    ids = spark.createDataFrame([(f"x{i * 7919 % 5000}",) for i in range(5000)], "id string")
    numbered = identity.number_ids(ids, workspace, "ids").orderBy("number").collect()
    assert [r.id for r in numbered] == sorted(r.id for r in numbered)
    assert len({r.number for r in numbered}) == 5000


class Watched(Workspace):
    """A workspace that remembers how many rows it has written under which names."""

    def __init__(self, spark):
        super().__init__(spark, "watched")
        self.rows = {}

    def save(self, df, name, **metrics):
        table, seen = super().save(df, name, **metrics)
        self.rows[name] = seen["rows"]
        return table, seen


def records_of(spark, listed):
    return spark.createDataFrame([(ids[0], list(ids)) for ids in listed], "userid string, ids array<string>")


@pytest.mark.parametrize("limit, min_rows", [(2**27, 10**6), (0, 10**6), (0, 3)])
def test_days_one_by_one_are_all_at_once(spark, limit, min_rows):
    pick = random.Random(4)
    days = [
        [[f"id{pick.randrange(250):03d}" for _ in range(pick.randrange(1, 4))] for _ in range(n)] for n in (120, 60, 40)
    ]
    days[1] += [["id000", f"id{i:03d}"] for i in range(0, 60, 3)]  # one user that many are merged into
    days[2].append(["a-lower-name", "id001"])
    stored = spark.createDataFrame([], "userid string, id string")
    seen = []
    for day in days:
        old = dict((i, u) for u, i in rows(stored))
        found = identity.resolve_increment(records_of(spark, day), stored, Watched(spark), limit, min_rows)
        members = rows(found.all_members())
        seen += [(ids[0], i) for ids in day for i in ids]
        want = union_find(seen)
        assert dict((i, u) for u, i in members) == want and len(members) == len(want)
        met = {i for ids in day for i in ids}
        assert dict(rows(found.touched)) == {old[i]: want[i] for i in met if i in old}
        assert dict(rows(found.users.components)) == {i: want[i] for i in met}
        stored = spark.createDataFrame(members, "userid string, id string")


def test_a_small_day_costs_little(spark):
    stored = spark.createDataFrame([(f"u{i // 4:05d}", f"u{i // 4:05d}" if i % 4 == 0 else f"x{i}") for i in range(8000)], "userid string, id string")
    day = records_of(spark, [["x1", "x9"], ["znew", "x9"], ["zlone", "zlone"], ["x6", "u00001"]])
    workspace = Watched(spark)
    found = identity.resolve_increment(day, stored, workspace)
    # Two stored users become one, one new identifier joins them, and one record stays within its user.
    assert dict(rows(found.touched)) == {"u00000": "u00000", "u00001": "u00001", "u00002": "u00000"}
    assert rows(found.fresh) == [("u00000", "znew"), ("zlone", "zlone")]
    assert found.all_members().count() == 8002
    assert max(workspace.rows.values()) <= 8 and sum(workspace.rows.values()) <= 60


def test_a_first_day_and_a_day_without_records(spark, workspace):
    nothing = spark.createDataFrame([], "userid string, id string")
    first = identity.resolve_increment(records_of(spark, [["b", "a"], ["c"]]), nothing, workspace)
    assert rows(first.all_members()) == [("a", "a"), ("a", "b"), ("c", "c")] and first.touched.count() == 0
    stored = spark.createDataFrame(rows(first.all_members()), "userid string, id string")
    later = identity.resolve_increment(spark.createDataFrame([], "userid string, ids array<string>"), stored, workspace)
    assert rows(later.all_members()) == rows(stored) and later.touched.count() == 0
