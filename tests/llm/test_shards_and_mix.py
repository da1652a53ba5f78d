import collections
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from adspindle.llm import mixing
from adspindle.llm.mixing import fill_targets, mix_sources, sample_copies
from adspindle.llm.queries import QUERIES
from adspindle.llm.sharding import shard_by_bytes
from adspindle.sources.workspace import Workspace

from . import brute

SF = "/root/testdata/sf0.01"


def check_shards(found, texts, shards):
    assert collections.Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in found) == collections.Counter(
        (d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for d, t in texts
    )
    by_shard = collections.defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r)
    assert set(by_shard) <= set(range(shards))
    last = None
    for shard in sorted(by_shard):
        rows = sorted(by_shard[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(len(rows)))
        for r in rows:
            key = (r["doc_id"] is not None, r["doc_id"] or 0)
            assert last is None or last <= key
            last = key
    largest = max((r["size"] for r in found), default=0)
    share = sum(r["size"] for r in found) / shards
    for rows in by_shard.values():
        assert abs(sum(r["size"] for r in rows) - share) <= largest
    return by_shard


def test_shard_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op6_sharding"](spark, SF).collect()
    assert len(check_shards(found, texts, 24)) == 24
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_shards_of_odd_rows(make_docs, ws, odd_texts):
    texts = list(enumerate(odd_texts)) + [(None, "x"), (None, "x"), (2, "y" * 100)] + [(4, "one")] * 40
    check_shards(shard_by_bytes(make_docs(texts), 5, ws).collect(), texts, 5)
    assert shard_by_bytes(make_docs([]), 5, ws).count() == 0
    assert shard_by_bytes(make_docs([None]), 5, ws).first()["shard"] in range(5)


def test_sharding_runs_no_python(spark, make_docs, ws):
    plan = shard_by_bytes(make_docs(["a"]), 3, ws)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    "sizes, weights, total, want",
    [
        ([100, 100, 100], [5, 2, 1], 160, [100, 40, 20]),
        ([10, 100, 100], [5, 2, 1], 240, [20, 440 / 3, 220 / 3]),
        ([10, 10], [1, 1], 100, [20, 20]),
        ([0, 10], [5, 1], 12, [0, 12]),
        ([], [], 0, []),
    ],
)
def test_targets(sizes, weights, total, want):
    assert fill_targets(sizes, weights, total, 2) == pytest.approx(want)


def check_mix(found, docs, tolerance):
    sizes = collections.Counter()
    for _, text, _, source in docs:
        sizes[source] += len(brute.words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(order, fill_targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)))
    taken, source_of = collections.Counter(), {d: s for d, _, _, s in docs}
    assert len(found) == len(docs)
    for r in found:
        source = source_of[r["doc_id"]]
        assert r["target"] == pytest.approx(targets[source]) and r["source_size"] == sizes[source]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for source in order:
        assert abs(taken[source] - targets[source]) <= tolerance(sizes[source])


def test_mix_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    found = QUERIES["op8_mixing"](spark, SF).collect()
    check_mix(found, docs, lambda size: 0.01 * size)
    again = QUERIES["op8_mixing"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mix_of_odd_rows(spark, make_docs, odd_texts, tmp_path):
    rows = [(i, t, "en", [None, "b", "a", ""][i % 4]) for i, t in enumerate(odd_texts)]
    rows += [(100 + i, " ".join(["w"] * (i % 7 + 1)), "en", "big") for i in range(60)]
    docs = make_docs(rows, tmp_path / "docs")
    drawn = sample_copies(docs, Workspace(spark, "mix"))
    found = drawn.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"),
    )
    check_mix(found.collect(), rows, lambda size: 3000)
    mixed = mix_sources(docs, Workspace(spark, "mix"))
    assert mixed.columns == [*docs.columns, "__copies"] and mixed.count() == len(rows)
    copies = {r["doc_id"]: r["__copies"] for r in drawn.collect()}
    assert {r["doc_id"]: r["__copies"] for r in mixed.collect()} == copies
    assert sample_copies(make_docs([]), Workspace(spark, "mix")).count() == 0


def test_mixed_rows_are_found_again_when_the_table_is_split_in_another_way(spark, make_docs, ws, tmp_path):
    mixed = mix_sources(make_docs([(i, f"w{i} x y z") for i in range(400)], tmp_path / "docs"), ws)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        found = mixed.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert sorted(r["doc_id"] for r in found) == list(range(400)) and sum(r["__copies"] for r in found) == 600


def test_repeated_rows_are_drawn_each(spark, make_docs, ws):
    drawn = sample_copies(make_docs([(1, "a b c")] * 30 + [(None, "a b c")] * 30), ws)
    assert drawn.count() == 60
    assert drawn.agg(F.sum(F.col("__copies") * F.col("__size"))).first()[0] == 60 * 3 * 1.5


def test_a_document_longer_than_the_words_wanted_is_passed_over(make_docs, ws):
    # Half a copy each: about as many words are wanted as the long one has, but a little fewer.
    for seed in range(4):
        rows = [(i, f"s{seed} " + "w " * (99 if i else 19_999)) for i in range(200)]
        drawn = sample_copies(make_docs(rows), ws, weights=(1,), share=0.4).collect()
        target, taken = drawn[0]["__target"], sum(r["__copies"] * r["__size"] for r in drawn)
        assert target < 20_000 and abs(taken - target) <= 50


def drawn_one_by_one(rows):
    """Copies of rows (size, source, uniform number): the sample drawn document by document, source by source."""
    sizes = collections.Counter()
    for size, source, _ in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = [(5, 2, 1)[i % 3] for i in range(len(order))]
    targets = dict(zip(order, fill_targets([sizes[s] for s in order], weights, 1.5 * sum(sizes.values()), 2)))
    copies = [0] * len(rows)
    for source in order:
        own = [i for i, r in enumerate(rows) if r[1] == source]
        mean = sum(rows[i][0] for i in own) / len(own)

        def lean(i):
            size = rows[i][0]
            return 1_000_000 + math.floor(250_000 * (size - mean) / (size + mean) + 0.5 if size + mean else 0)

        scale = sum(lean(i) * rows[i][0] for i in own)
        ranks, left = [], targets[source]
        for i in own:
            size, _, u = rows[i]
            expected = min(lean(i) * targets[source] / scale, 2.0) if size and scale else 0.0
            copies[i] = int(expected)
            left -= copies[i] * size
            part = expected - copies[i]
            if part > 0:
                ranks.append((u / (1 - u) / (part / (1 - part)), i))
        # Pareto order: taken one after the other if they fit, the others passed over.
        passed = []
        for rank, i in sorted(ranks):
            if rows[i][0] <= left:
                copies[i] += 1
                left -= rows[i][0]
            else:
                passed.append((abs(left - rows[i][0]), rank, i))
        if passed and min(passed)[0] < abs(left):
            copies[min(passed)[2]] += 1
    return copies


def test_the_sample_is_that_of_drawing_one_by_one(spark, make_docs, ws, tmp_path):
    rng = random.Random(12)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 20, rng.randint(1, 400)])), "en", rng.choice([None, "a", "b", "c", "c", "c"])) for i in range(500)]
    docs = make_docs(rows, tmp_path / "docs")
    uniform = {r[0]: r[1] for r in docs.select("doc_id", mixing._uniform(F.col("doc_id"), F.col("text"))).collect()}
    want = drawn_one_by_one([(len(brute.words(t)), s, uniform[i]) for i, t, _, s in rows])
    found = {r["doc_id"]: r["__copies"] for r in sample_copies(docs, ws).collect()}
    assert [found[i] for i in range(500)] == want
    assert set(want) == {0, 1, 2}


def test_inclusion_odds_follow_the_expectation(spark, make_docs, ws):
    # Of equally long documents with 1.5 expected copies, each is taken once or twice, half of them twice.
    drawn = sample_copies(make_docs([(i, f"w{i} x y z") for i in range(400)]), ws, weights=(1,), share=1.5)
    copies = collections.Counter(r["__copies"] for r in drawn.collect())
    assert copies == {1: 200, 2: 200}


def test_shards_equal_their_oracle(spark):
    sf = "/root/testdata/sf0.001"
    brute.same_as_oracle(QUERIES["op6_sharding"](spark, sf), "op6_sharding", sf)
