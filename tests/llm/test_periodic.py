import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from adspindle.llm.periodic import find_runs, kept_words, most_repeated, repeated_from, run_digests, runs_of, suffix_order
from adspindle.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.01"


def runs_together(texts):
    """Runs of several lists of small numbers, searched in one go."""
    numbers = [np.array(t, dtype=np.int64) + 100 * i for i, t in enumerate(texts)]
    return runs_of(np.concatenate(numbers), np.cumsum([0, *map(len, texts)]))


def test_runs_are_those_of_the_definition():
    rng = random.Random(3)
    texts = []
    for n in range(400):
        letters = rng.choice([1, 2, 2, 3])
        text = [rng.randrange(letters) for _ in range(rng.randrange(0, 40))]
        piece = [rng.randrange(3) for _ in range(rng.randrange(1, 5))]
        texts.append(text[: n % 17] + piece * rng.randrange(0, 9) + piece[: rng.randrange(len(piece))] + text[n % 17 :])
    for i in range(0, 400, 50):
        assert runs_together(texts[i : i + 50]) == [brute.runs(t) for t in texts[i : i + 50]]


def test_suffixes_are_in_order():
    rng = random.Random(1)
    words = np.array([rng.randrange(3) for _ in range(300)])
    order, common = suffix_order(words)
    listed = words.tolist()

    def shared(a, b):
        n = 0
        while max(a, b) + n < len(listed) and listed[a + n] == listed[b + n]:
            n += 1
        return n

    assert order.tolist() == sorted(order.tolist(), key=lambda i: listed[i:])
    assert common[1:].tolist() == [shared(a, b) for a, b in zip(order[:-1].tolist(), order[1:].tolist())]
    assert set(order.tolist()) == {i for i in range(300) if any(j != i and shared(i, j) >= 4 for j in range(300))}


@pytest.mark.parametrize("text", [[0] * 20000, [0, 1, 2] * 7000, list(range(9)) * 2000 + [3] * 3000], ids=["one", "three", "many"])
def test_long_runs_take_no_longer_than_others(text):
    begin = time.time()
    (found,) = runs_together([text])
    assert time.time() - begin < 10
    assert max(length for _, length, _ in found) >= 3000


def test_a_line_with_other_words_around_it_many_times():
    # One interval of many places with many left words, none of them near enough.
    text = [w for i in range(5000) for w in (i + 20, *range(12))]
    begin = time.time()
    assert runs_of(np.array(text), np.array([0, len(text)])) == [[]]
    assert time.time() - begin < 10


def test_best_and_kept():
    assert most_repeated([]) is None
    assert most_repeated([(9, 12, 2), (5, 24, 4), (5, 18, 3), (0, 11, 2)]) == (5, 18, 3)
    assert kept_words(10, [(1, 8, 2)]).tolist() == [True, True, True, *[False] * 6, True]
    assert kept_words(3, []).all()


def test_seeded_repeats():
    assert repeated_from(5, 11).tolist() == [0, 1, 2, 3, 4]
    assert repeated_from(0, 10).tolist() == []
    # g = 4, a = 4, p = 1 + (20 - 4) // 7
    assert repeated_from(20, 40).tolist() == [0, 1, 2, 3] + [4 + k % 3 for k in range(16)]


def test_query_is_its_oracle(spark):
    brute.same_as_oracle(QUERIES["op13_periodic_runs"](spark, SF), "op13_periodic_runs", SF)


def test_query_is_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        words = brute.words(text)
        words = [words[k] for k in repeated_from(len(words), zlib.crc32(str(doc_id).encode())).tolist()]
        runs, row = brute.runs(words), found[doc_id]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_odd_rows(spark, make_docs, odd_texts):
    texts = odd_texts + [(None, "a b a b a b a b a"), (40, "x " * 9), (40, "x " * 9), (41, "A a A a A a A a")]
    found = find_runs(make_docs(texts)).collect()
    assert len(found) == len(texts)
    for (doc_id, text), row in zip([t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)], found):
        assert row["doc_id"] == doc_id
        assert [tuple(r) for r in row["runs"]] == brute.runs(brute.words(text))
    assert found[0]["collapsed"] == "" and found[0]["best"] is None
    assert found[len(odd_texts)]["collapsed"] == "a b" and tuple(found[len(odd_texts)]["best"]) == (0, 9, 2)
    assert run_digests(make_docs([])).count() == 0
    assert run_digests(make_docs(texts)).count() == len(texts)
