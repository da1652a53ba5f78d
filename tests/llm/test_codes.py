import hashlib
import random

import numpy as np
import pytest

from adspindle.llm.codes import Assigner, code_digests, codebook_text, compress_vectors, moved, next_book
from adspindle.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error double"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.5) for r in rows], SCHEMA)


def same(spark, ws, rows):
    found = code_digests(table(spark, rows), ws).collect()
    want, books = brute.vector_codes(rows)
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    assert {r["codebooks_sha256"] for r in found} <= {digest}
    return found


def test_query_is_its_oracle(spark):
    brute.same_as_oracle(QUERIES["op12_vector_codes"](spark, SF), "op12_vector_codes", SF)


def test_clusters_and_ties(spark, ws):
    rng = random.Random(5)
    middles = [[rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(16)] for _ in range(12)]
    # Coarse steps make many equal distances.
    rows = [(i, [round(x + rng.randrange(-4, 5) / 8, 3) for x in rng.choice(middles)], rng.choice([None, 0, 1])) for i in range(400)]
    same(spark, ws, rows)


def test_odd_rows(spark, ws):
    rng = random.Random(6)
    rows = [(i, [rng.random() * 2 - 1 for _ in range(8)], 1) for i in range(40)]
    rows = [(i, list(np.float32(v).tolist()), c) for i, v, c in rows]
    odd = [(3, None, 1), (4, [1.0] * 7 + [None], None), (5, [float("nan")] * 8, 1), (6, [float("-inf")] + [0.0] * 7, 2)]
    more = [(None, [0.5] * 8, None), (None, [0.25] * 8, None), (7, [0.0] * 8, 2), (7, [0.0] * 8, 2), (7, [-0.00001] * 8, 2)]
    more = [(i, list(np.float32(v).tolist()), c) for i, v, c in more]
    assert len(same(spark, ws, rows + odd + more)) == 45
    # Fewer rows than entries; all alike; one.
    same(spark, ws, rows[:5])
    same(spark, ws, [(i, [0.5] * 8, None) for i in range(30)])
    same(spark, ws, rows[:1])
    assert code_digests(table(spark, []), ws).collect() == []
    assert code_digests(table(spark, odd), ws).collect() == []


@pytest.mark.parametrize("vectors", [[[1.0] * 8, [1.0] * 16], [[1.0] * 7], [[]], [[1e30] * 8]], ids=["sizes", "seven", "none", "huge"])
def test_what_cannot_be_coded_is_refused(spark, ws, vectors):
    with pytest.raises(Exception, match="vectors|components"):
        code_digests(table(spark, [(i, v, 0) for i, v in enumerate(vectors * 20)]), ws).collect()


def rounds(x, entries, n, width):
    """States and codebooks of n rounds, with how many rows each round had to look at."""
    book = x[:entries].reshape(entries, -1, width).transpose(1, 0, 2).copy()
    history, state, seen = [book], None, []
    for _ in range(n):
        assigner = Assigner(list(history))
        state = assigner.first(x) if state is None else assigner.update(x, state)
        seen.append((assigner.settled, assigner.own, assigner.scanned))
        history.append(next_book(history[-1], assigner.sums(x, state)))
        yield history, state, seen


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(2)
    middles = rng.integers(-4000, 4000, size=(16, 16))
    x = np.concatenate([middles, middles[rng.integers(0, 16, 2000)] + rng.integers(-300, 300, size=(2000, 16))])
    for history, state, seen in rounds(x, 16, 6, 8):
        book = history[-2]
        for p in range(2):
            away = ((x[:, None, p * 8 : (p + 1) * 8] - book[p][None]) ** 2).sum(axis=2)
            entry = state[:, p]["entry"].astype(int)
            assert (entry == away.argmin(axis=1)).all()
            # Each bound holds for the codebook of its own round.
            for kind in ("upper", "lower"):
                for r in np.unique(state[:, p][f"{kind}_round"]):
                    rows = np.flatnonzero(state[:, p][f"{kind}_round"] == r)
                    then = np.sqrt(((x[rows, None, p * 8 : (p + 1) * 8] - history[r][p][None]) ** 2).sum(axis=2))
                    own = then[np.arange(len(rows)), entry[rows]]
                    then[np.arange(len(rows)), entry[rows]] = np.inf
                    if kind == "upper":
                        assert (state[rows, p]["upper"] >= own - 1e-6).all()
                    else:
                        assert (state[rows, p]["lower"] <= then.min(axis=1) + 1e-6).all()
    assert seen[0] == (0, 0, 2 * len(x))
    assert all(scanned < len(x) // 4 for _, _, scanned in seen[2:])
    assert max(settled for settled, _, _ in seen) > len(x)


def test_net_displacement_is_no_more_than_the_steps():
    rng = np.random.default_rng(3)
    history = [rng.integers(-50, 50, size=(2, 4, 3)) for _ in range(5)]
    own, others = moved(history)
    steps = [np.sqrt(((b - a) ** 2).sum(axis=2)) for a, b in zip(history, history[1:])]
    for s in range(5):
        assert (own[s] <= sum(steps[s:], np.zeros((2, 4))) + 1e-9).all()
        for j in range(4):
            assert np.allclose(others[s, :, j], np.delete(own[s], j, axis=1).max(axis=1))
    assert (own[4] == 0).all() and (own[0] < sum(steps) - 1e-9).any()


def test_codebooks_of_all_rounds(spark, ws):
    coded, history = compress_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"), ws, parts=4, entries=5, rounds=3)
    assert len(history) == 4 and history[0].shape == (4, 5, history[0].shape[2])
    assert {len(r["code"]) for r in coded.collect()} == {8}
    assert codebook_text(np.array([[[1, -2]], [[3, 4]]])) == "1,-2,3,4"
