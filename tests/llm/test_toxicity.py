import collections
import math
import re

import numpy as np

from adspindle.llm import toxicity
from adspindle.llm.queries import QUERIES
from adspindle.llm.text import mix, words_of
from adspindle.llm.toxicity import (
    Model, classify_toxicity, decay_of, entry_scores, learn, logistic_of, segments, tokens_of, toxic_passages,
)

from . import brute

SF = "/root/testdata/sf0.01"


def tables(spark, sf=SF):
    return [spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_accuracy(spark):
    _, labels = tables(spark)
    found = QUERIES["op11_toxicity"](spark, SF).join(labels, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.95
    assert not any(r["predicted"] and not r["toxic"] for r in held)
    toxic = [r for r in found if r["toxic"]]
    assert np.mean([r["predicted"] for r in toxic]) > 0.85


def test_learns_nothing_from_held_out_labels(spark, ws):
    docs, labels = tables(spark)
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    a, b = (classify_toxicity(docs, x, ws).collect() for x in (labels, turned))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_counts_and_scores_of_entries(spark, ws):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    model = learn(docs, labels, ws)
    rows = docs.join(labels, "doc_id").where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0").collect()
    counts, totals = collections.defaultdict(lambda: [0, 0]), [0, 0]
    for text, toxic in {(r["text"] or "", r["toxic"]) for r in rows}:
        words = {brute.lower(w).encode() for w in re.findall(r"(?:[A-Za-z]|[^\x00-\x7f])+", text)}
        totals[toxic] += len(words)
        for w in words:
            for entry in [(w, True), *((w[:k], False) for k in range(4, 11) if len(w) > k)]:
                counts[entry][toxic] += 1
    want = []
    for clean, toxic in counts.values():
        prior = 2000 * (clean + toxic) / sum(totals) + 0.01
        a, b = toxic + prior, clean + prior
        score = math.log(a / (totals[1] + 2000 - a)) - math.log(b / (totals[0] + 2000 - b)) - 2 * math.sqrt(1 / a + 1 / b) - 0.5
        if score > 0:
            want.append(score)
    assert want and np.allclose(sorted(model.scores), sorted(want))
    assert (np.diff(model.entries.astype(object)) > 0).all()


def test_segments_are_those_of_the_definition():
    rng = np.random.default_rng(4)
    for n in range(300):
        scores = np.where(rng.random(n % 25) < 0.4, rng.random(n % 25), -0.3)
        found, want = segments(scores, 0.3), brute.best_segments(scores.tolist())
        assert [x[:2] for x in found] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in found], [x[2] for x in want])
    assert segments(np.full(5, -0.1)) == [] and segments(np.zeros(0)) == []


def test_long_texts_are_linear():
    rng = np.random.default_rng(5)
    for scores in (np.where(np.arange(400_000) % 2, 0.2, -0.1), np.full(400_000, 0.1), rng.random(400_000) - 0.5):
        scores[scores <= 0] = -0.1
        assert segments(scores)
    # Left sums that fall one after the other: every search ends at the segment before.
    assert len(segments(np.where(np.arange(400_000) % 4 == 0, 0.1, -0.1))) == 100_000


def test_extreme_value_law():
    scores, counts = np.array([2.0, -0.5]), np.array([1.0, 9.0])
    decay = decay_of(scores, counts)
    assert abs((counts * np.exp(decay * scores)).sum() / 10 - 1) < 1e-9
    # How often random text exceeds a score falls with that power.
    rng = np.random.default_rng(6)
    found = [s for _ in range(40) for *_, s in segments(np.where(rng.random(20_000) < 0.1, 2.0, -0.5), 0.5)]
    a, b = (sum(s >= x for s in found) for x in (6, 12))
    assert abs(math.log(a / b) / 6 - decay) < 0.25 * decay
    assert decay_of(np.array([1.0, -0.1]), np.array([5.0, 5.0])) == 1.0


def test_logistic():
    slope, middle = logistic_of(np.array([0.0, 2, 4, 6]), np.array([0.0, 0, 1, 1]), np.array([50.0, 10, 10, 50]))
    assert slope > 0.5 and 2.5 < middle < 3.5


def test_tokens_and_their_beginnings():
    data = "Trash,trashy’s É9 x".encode()
    found = tokens_of(np.array([0, len(data)]), np.frombuffer(data, dtype=np.uint8))
    assert [data[a:b].decode() for a, b in zip(found.start, found.end)] == ["Trash", "trashy’s", "É", "x"]
    kinds = dict(zip(("whole", *toxicity.BEGINNINGS), found.entries))
    assert kinds[5][0].tolist() == [1] and kinds[4][0].tolist() == [0, 1]
    assert kinds[4][1][0] == kinds[4][1][1]
    assert kinds["whole"][1][0] not in kinds[5][1]


def test_passages(spark, make_docs):
    word = np.frombuffer(b"scum", dtype=np.uint8)
    number = tokens_of(np.array([0, 4]), word).entries[0][1]
    model = Model(number, np.array([3.0]), 2.0, 0.01, 1.0, 5.0)
    docs = make_docs([(4, "ä b Scum c scum, d"), (5, "clean"), (6, None), (None, "scum")])
    found = toxic_passages(docs, model).collect()
    assert [(r["doc_id"], r["start"], r["end"]) for r in found] == [(4, 5, 16), (None, 0, 4)]
    assert abs(found[0]["score"] - 5.9) < 1e-9
    assert abs(found[0]["expected"] - 0.01 * 6 * math.exp(-2 * 5.9)) < 1e-12
    assert toxic_passages(make_docs([]), model).count() == 0


def test_odd_rows(spark, make_docs, ws, odd_texts):
    docs = make_docs(odd_texts + [(None, "no id"), (7, "again"), (7, "again")])
    labels = spark.createDataFrame(
        [(5, 1, 0), (6, 0, 1), (6, 0, 1), (8, 0, None), (None, 0, 1), (7, 0, 3)], "doc_id bigint, quality int, toxic int"
    )
    found = classify_toxicity(docs, labels, ws).collect()
    assert len(found) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (0, 1, 2, 3)}
    assert len(empty) == 1 and empty == {min(r["score"] for r in found)}
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in classify_toxicity(docs, none, ws).collect()} == {0.5}
    assert classify_toxicity(make_docs([]), labels, ws).count() == 0


def test_copies_count_once_and_the_bound_holds(spark, make_docs, ws):
    texts = [(i, "awful thing here") for i in range(1, 40)] + [(i, f"plain words number {i}") for i in range(40, 90)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(1, 90)], "doc_id bigint, toxic int")
    rows = toxicity._labelled(make_docs(texts), labels, 10)
    assert 0 < rows.count() < 40
    assert len(entry_scores(np.zeros(1), np.ones(1), 10.0, 10.0)) == 1
    assert words_of(np.array([0, 1]), np.array([97], dtype=np.uint8)).number.dtype == mix(np.zeros(1, np.uint64)).dtype
