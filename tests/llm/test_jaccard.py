import random

import numpy as np
import pyarrow as pa
import pytest

from adspindle.llm import jaccard
from adspindle.llm.jaccard import (
    BlockSearch, class_of, jaccard_components, keep_representatives, least_different, linked, most_different, parities,
    rarest, sets_of, signatures,
)
from adspindle.llm.queries import QUERIES
from adspindle.llm.text import mix
from adspindle.sources.workspace import Workspace

from . import brute


def varied(rng, base, most):
    out = list(base)
    for _ in range(rng.randint(0, most)):
        where = rng.randrange(len(out))
        if rng.random() < 0.5:
            out[where] = f"w{rng.randrange(50)}"
        elif len(out) > 3:
            del out[where]
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 40, 150]))] for _ in range(12)]
    shared = [f"s{i}" for i in range(50)]
    texts = []
    for _ in range(n):
        text = varied(rng, rng.choice(bases), 3)
        texts.append(" ".join(shared + text if rng.random() < 0.3 else text))
    return texts


def check(docs, ws, rows, size=3, percent=90):
    found = jaccard_components(docs, ws, size, percent).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr)
    assert got == sorted(brute.components(rows, size, percent), key=repr)


@pytest.mark.parametrize("seed, percent", [(1, 90), (2, 80), (3, 60)])
def test_search_finds_all_pairs(seed, percent):
    rng = random.Random(seed)
    for _ in range(60):
        bases = [rng.sample(range(10**6), rng.randint(8, 120)) for _ in range(3)]
        sets = []
        for _ in range(rng.randint(2, 20)):
            members = list(rng.choice(bases))
            for _ in range(rng.randint(0, 4)):
                members[rng.randrange(len(members))] = rng.randrange(10**6)
            sets.append(np.unique(mix(np.array(members, dtype=np.uint64))))
        sets.sort(key=len)
        index = BlockSearch(sets, percent)
        for x, a in enumerate(sets):
            want = [y for y in range(x + 1, len(sets)) if linked(len(np.intersect1d(a, sets[y])), len(a), len(sets[y]), percent)]
            assert sorted(index.partners(x)) == want
            for y in want:
                same = class_of(a) == class_of(sets[y])
                assert same or len(np.intersect1d(signatures(a, percent), signatures(sets[y], percent)))


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_components_match_brute_force(make_docs, ws, size, percent):
    rows = list(enumerate(corpus(3)))
    check(make_docs(rows), ws, rows, size, percent)


@pytest.mark.parametrize("name, value", [("BLOCK_SHINGLES", 300), ("BLOCK_CLASSES", 4)])
def test_large_blocks_are_searched_in_cells(make_docs, ws, monkeypatch, name, value):
    monkeypatch.setattr(jaccard, name, value)
    rows = list(enumerate(corpus(4)))
    check(make_docs(rows), ws, rows)


def test_odd_rows(make_docs, ws, odd_texts):
    rows = list(enumerate(odd_texts)) + [(3, "a b c"), (None, "q r s t"), (None, "q r s t"), (7, "q r s t"), (None, "z z y")]
    check(make_docs(rows), ws, rows)


def test_empty_table(make_docs, ws):
    assert jaccard_components(make_docs([]), ws).count() == 0


def test_one_of_each_group_stays(make_docs, ws, tmp_path):
    texts = corpus(5)
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "lone one here"), (None, None), (500, "  ")]
    docs = make_docs(rows, tmp_path / "docs")
    kept = keep_representatives(docs, ws)
    assert kept.columns == docs.columns
    want = {d for d, n, c in brute.components(rows) if d == c and n} | {None, 500}
    got = [r["doc_id"] for r in kept.collect()]
    assert set(got) == want and len(got) == len(want) + 1  # two rows without an id


def test_rows_are_found_again_when_the_table_is_split_in_another_way(spark, make_docs, ws, tmp_path):
    rows = [(i, f"w{i} x{i} y{i}") for i in range(300)] + [(i, f"w{i} x{i} y{i}") for i in range(300)]
    docs = make_docs(rows, tmp_path / "docs")
    kept = keep_representatives(docs, ws)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_query_equals_its_oracle(spark):
    sf = "/root/testdata/sf0.01"
    brute.same_as_oracle(QUERIES["op7_ngram_jaccard_join"](spark, sf), "op7_ngram_jaccard_join", sf)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_linked_sets_share_one_of_their_rarest(percent):
    rng = random.Random(percent)
    pool = rng.sample(range(10**6), 60)
    common = np.unique(mix(np.array(rng.sample(pool, 25), dtype=np.uint64)))
    counts = np.array([rng.randint(2, 9) for _ in common])
    met = 0
    for _ in range(3000):
        a = rng.sample(pool, rng.randint(1, 40))
        b = a[: len(a) - rng.randint(0, len(a) // 3)] + rng.sample(range(10**6, 2 * 10**6), rng.randint(0, 6))
        x, y = (np.unique(mix(np.array(s, dtype=np.uint64))) for s in (a, b))
        if linked(len(np.intersect1d(x, y)), len(x), len(y), percent):
            met += 1
            assert len(np.intersect1d(rarest(x, percent, common, counts), rarest(y, percent, common, counts)))
    assert met > 100


@pytest.mark.parametrize("few", [2, 4, 32])
@pytest.mark.parametrize("percent", [60, 80])
def test_linked_sets_are_tied_by_their_rarest(monkeypatch, few, percent):
    monkeypatch.setattr(jaccard, "FEW", few)
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    sets = {class_of(s): s for s in sets_of(pa.array(corpus(few + percent, 400)), 5) if len(s)}
    classes = list(sets)
    signs = [rarest(sets[c], percent, *none).tobytes() for c in classes]
    sizes = [len(sets[c]) for c in classes]
    table = pa.table({"class": pa.array(classes), "n_shingles": pa.array(sizes), "signatures": pa.array(signs, pa.binary())})
    sent = pa.Table.from_batches(jaccard._sized_postings(table.to_batches(40), percent))
    sent = sent.sort_by([("signature", "ascending"), ("size", "ascending"), ("class", "ascending")])
    root = {c: c for c in classes}

    def top(c):
        while root[c] != c:
            c = root[c]
        return c

    for batch in jaccard._sized_stars(iter(sent.to_batches(7)), percent):  # groups go over the batches' ends
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
            root[top(u)] = top(v)
    links = 0
    for i, a in enumerate(classes):
        for b in classes[:i]:
            if linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), percent):
                links += 1
                assert top(a) == top(b)
    assert links > 100


def test_one_of_each_group_stays_at_the_pipelines_setting(make_docs, ws, tmp_path):
    rows = list(enumerate(corpus(6))) + [(500, None), (501, "one two")]
    kept = keep_representatives(make_docs(rows, tmp_path / "docs"), ws, 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, n, c in brute.components(rows, 5, 80) if not n or d == c)


def test_bitmaps_never_prove_too_much():
    rng = np.random.default_rng(8)
    for _ in range(400):
        both, a, b = (rng.integers(0, 2**63, size=rng.integers(0, n), dtype=np.uint64) for n in (400, 120, 120))
        x, y = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
        if len(x) and len(y):
            different = len(np.setxor1d(x, y))
            least = least_different(parities(x), parities(y))
            assert least <= different and (different - least) % 2 == 0
            assert least == least_different(parities(y), parities(x))
    assert least_different(parities(x), parities(x)) == 0
    far = [np.unique(rng.integers(0, 2**63, size=n, dtype=np.uint64)) for n in (1000, 1100)]
    assert least_different(*map(parities, far)) > most_different(1100, 80)


def test_texts_that_share_passages_do_not_meet(spark, make_docs, ws, tmp_path, monkeypatch):
    """Each text shares a passage with the next: all are connected by candidate pairs, and no two are similar."""
    # As in a table so large that these passages are not among the common ones.
    monkeypatch.setattr(jaccard, "_common", lambda *_: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    passages = [[f"p{i}x{k}" for k in range(60)] for i in range(41)]
    texts = [" ".join(passages[i] + [f"t{i}w{k}" for k in range(200)] + passages[i + 1]) for i in range(40)]
    texts += [" ".join([f"c{k}" for k in range(300)] + [f"e{i}"] * (i > 0)) for i in range(5)]
    docs = make_docs(texts, tmp_path / "docs")
    found = jaccard_components(docs, ws, 5, 80).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute.components(list(enumerate(texts)), 5, 80)
    assert spark.read.parquet(ws._latest["pairs"]).where("tied = 0").count() > 30
    assert spark.read.parquet(ws._latest["members"]).count() == 5


@pytest.mark.parametrize("most", [0, 5, 40])
def test_any_part_of_the_order_of_common_shingles_will_do(make_docs, ws, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST_COMMON", most)
    rows = list(enumerate(corpus(7)))
    check(make_docs(rows), ws, rows, 5, 80)


def test_passages_of_a_large_table_tie_no_texts(make_docs, ws, monkeypatch, tmp_path):
    """The sample that common shingles are judged from grows with the table: unlike texts meet nowhere."""
    monkeypatch.setattr(jaccard, "SAMPLE_TEXTS", 20)
    monkeypatch.setattr(jaccard, "FEW", 16)
    saved, save = {}, Workspace.save

    def watched(self, df, name, **metrics):
        found = save(self, df, name, **metrics)
        saved[name] = found[1]["rows"]
        return found

    monkeypatch.setattr(Workspace, "save", watched)
    rng = random.Random(5)
    passages = [" ".join(f"p{k}x{i}" for i in range(8)) for k in range(20)]
    texts = [f"{passages[n % 20]} " + " ".join(f"w{n}x{i}" for i in range(30 + rng.randrange(8))) for n in range(3200)]
    texts += [texts[0], f"{texts[1]} more"]
    kept = keep_representatives(make_docs(texts, tmp_path / "docs"), ws, 5, 80)
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == list(range(3200))
    assert saved["pairs"] < 20 and saved["members"] < 20 and saved["gone"] == 2


def test_one_row_of_each_class_without_shuffling_the_others(spark, ws):
    signed = spark.createDataFrame([(k % 70 if k < 90 else k, bytes([k])) for k in range(200)], "class bigint, signatures binary")
    found = jaccard._one_of_each(signed, ws).collect()
    names = [r["class"] for r in found]
    assert sorted(names) == [*range(70), *range(90, 200)]
    assert all(r["signatures"][0] % 70 == r["class"] or r["signatures"][0] == r["class"] for r in found)
