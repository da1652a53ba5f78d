"""The five stages over a small table, each against its operator's brute-force version."""

import collections

import corpus_pipeline
from adspindle.llm.queries import QUERIES
from adspindle.llm.secret_scan import RULES, Scanner

from . import brute

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, after = docs.columns, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        after[name] = spark.read.parquet(str(tmp_path / str(n)))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert after[name].columns == names
        docs = after[name]
    first, second, third, fourth, last = (after[name] for name, _ in corpus_pipeline.STAGES)

    good = {r["doc_id"] for r in QUERIES["op1_quality_classifier"](spark, SF).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in first.collect()} == good

    rows = [(r["doc_id"], r["text"]) for r in first.collect()]
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(d for d, n, c in brute.components(rows, 5, 80) if not n or d == c)

    assert third.count() == second.count()
    texts = {r["doc_id"]: r["text"] for r in second.collect()}
    masked = {r["doc_id"]: r["text"] for r in third.collect()}
    import pyarrow as pa

    scanner = Scanner(RULES)
    changed = [d for d in texts if texts[d] != masked[d]]
    assert changed and all(next(scanner.spans(pa.array([texts[d]]))) for d in changed)

    copies = collections.Counter(r["doc_id"] for r in fourth.collect())
    assert max(copies.values()) <= 2 and set(copies) <= set(masked)
    total = sum(len(brute.words(t)) for t in masked.values())
    taken = sum(len(brute.words(masked[d])) * n for d, n in copies.items())
    assert abs(taken - 1.5 * total) < 0.01 * total

    pieces = last.collect()
    assert {r["doc_id"] for r in pieces} == set(copies)
    assert max(r["offset"] + r["length"] for r in pieces) <= 2048


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_near_copies_of_five_words_and_80_percent(spark, make_docs, tmp_path):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base + [f"n{i}" for i in range(extra)]) for extra in (0, 30, 70)]
    rows = list(enumerate([*texts, " ".join(reversed(base)), "few words here"]))
    kept = corpus_pipeline.keep_one_of_each_group(spark, make_docs(rows, tmp_path / "docs"), SF)
    # 15 percent more text is a near copy; 35 percent more is near the second, not the first.
    want = sorted(d for d, n, c in brute.components(rows, 5, 80) if d == c)
    assert want == [0, 3, 4]
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_near_copy_stage_at_five_words_and_80_percent(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, n, c in brute.components(rows, 5, 80) if not n or d == c)


def written(spark, docs, path):
    docs.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_odd_rows_go_through_all_stages(spark, make_docs, odd_texts, tmp_path):
    """Null ids, texts and sources, repeated rows, and columns with names that stages use themselves."""
    texts = [(100 + i, f"some plain words in document number {i} " + " ".join(f"w{i}x{k}" for k in range(40 + i))) for i in range(12)]
    rows = list(enumerate(odd_texts)) + texts + [texts[0]] * 3 + [(None, "no id here at all"), (None, None)]
    rows = [(i, t, "en", [None, "a", "b"][n % 3]) for n, (i, t) in enumerate(rows)]
    docs = make_docs(rows, tmp_path / "docs")
    for name in ("key", "place", "class", "u", "bits", "tokens", "queue"):
        docs = docs.withColumn(name, docs.n_chars)
    docs = written(spark, docs, tmp_path / "more")
    names = docs.columns
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(spark, stage(spark, docs, SF), tmp_path / str(n))
        if n < 4:
            assert docs.columns == names
        if n == 1:
            left = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert len([1 for _, t in left if brute.words(t)]) == len({frozenset(brute.shingles(t, 5)) for _, t in left if brute.words(t)})
    mixed = spark.read.parquet(str(tmp_path / "3"))
    assert mixed.where("text is null or trim(text) = ''").count() == 0
    total = sum(r["length"] for r in docs.collect())
    offsets = sorted((r["sequence_id"], r["offset"], r["length"]) for r in docs.collect())
    assert total == sum(n for _, _, n in offsets) and offsets[0][:2] == (0, 0)


def test_an_empty_table_goes_through_all_stages(spark, make_docs, tmp_path):
    docs = make_docs([], tmp_path / "docs")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(spark, stage(spark, docs, SF), tmp_path / str(n))
        assert docs.count() == 0


def test_a_bounded_number_of_labelled_documents_is_measured(spark):
    from adspindle.llm import quality

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    usable = labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1")
    ids = quality.fitting_ids(labels)
    assert sorted(ids) == sorted(r["doc_id"] for r in usable.collect())
    some = quality.fitting_ids(labels, 100)
    assert 0 < len(some) < 160 and set(some) < set(ids)
    measured = quality.measure(docs, ids)
    assert {r["doc_id"] for r in measured.collect()} == set(ids)
    assert quality.fitting_ids(labels.where("quality > 1")) == [] and quality.measure(docs, []).count() == 0
