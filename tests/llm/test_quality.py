import numpy as np

from adspindle.llm import quality
from adspindle.llm.quality import classify_quality, document_statistics, fit_discriminant, keep_good
from adspindle.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = QUERIES["op1_quality_classifier"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 100
    assert np.mean([r["predicted"] == r["quality"] for r in found]) > 0.97


def test_learns_nothing_from_held_out_labels(spark, ws):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality"
    )
    a = classify_quality(docs, labels, ws).collect()
    b = classify_quality(docs, turned, ws).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_scores_are_the_densities(spark):
    rng = np.random.default_rng(1)
    points = [rng.normal(size=(50, quality.DIM)), 2 + rng.normal(size=(30, quality.DIM)) * 0.5]
    model = fit_discriminant(
        np.array([50.0, 30.0]), np.stack([p.sum(axis=0) for p in points]), np.stack([p.T @ p for p in points])
    )
    x = rng.normal(size=(7, quality.DIM))
    want = []
    for row in x:
        logs = []
        for c in (0, 1):
            inverse = model.whiten[c].T @ model.whiten[c]
            away = row - model.means[c]
            logs.append(np.log((50, 30)[c] / 80) + 0.5 * np.linalg.slogdet(inverse)[1] - 0.5 * away @ inverse @ away)
        want.append(1 / (1 + np.exp(logs[0] - logs[1])))
    assert np.allclose(model.scores(x), want)


def test_odd_rows(spark, make_docs, ws, odd_texts):
    docs = make_docs(odd_texts + [(None, "no id")])
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = classify_quality(docs, labels, ws).collect()
    assert len(found) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    same = {r["score"] for r in found if r["doc_id"] in (6, 8)}
    assert len(same) == 1


def test_one_class_or_none(spark, make_docs, ws):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = classify_quality(make_docs(["a", None]), labels, ws).collect()
    assert [r["score"] for r in found] == [0.5, 0.5]
    assert classify_quality(make_docs([]), labels, ws).count() == 0
    docs = make_docs(["a", None])
    assert keep_good(docs, None).collect() == docs.collect()


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"One two!! three", b"", b"three three # 4 5", "Élan À".encode()]
    whole = document_statistics(np.cumsum([0, *map(len, texts)]), np.frombuffer(b"".join(texts), dtype=np.uint8))
    for i, t in enumerate(texts):
        alone = document_statistics(np.array([0, len(t)]), np.frombuffer(t, dtype=np.uint8))
        assert np.allclose(whole[i], alone[0])
