import random
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from adspindle.llm import tokens
from adspindle.llm.packing import cut, pack_by_mixture, schedule
from adspindle.llm.queries import BYTE_VOCABULARY, QUERIES, WORD_VOCABULARY
from adspindle.llm.tokens import Counter, WordEncoder, count_tokens, single_tokens

TRICKY = [
    "a\x1cb \x1c c", "x\x85 y \x85z", "it's <|endoftext|> <|endoftext|>we'll <|ENDOFTEXT|>", "é́ ́a   b　c   d",
    "ﬁ ſ İSTANBUL ΑΣ Σ", "<|startoftext|>hi<|endoftext|>", "'s's 'T don'T", "١٢٣ ²½ 12345", "a ̈ b", " <|endoftext|>",
    "🙂 👩‍👩‍👧 x", "trailing ", "two  spaces", "tab\t here", "\x00 \x7f \x1f a",
]


def random_texts(n=1500):
    rng = random.Random(3)
    letters = list("ab Z9'.,\n\t \x1c\x85é́　ſΣİ") + ["<|endoftext|>", " the", "ing"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture()
def texts(odd_texts):
    return odd_texts + TRICKY + random_texts()


def test_counts_are_the_librarys(texts):
    known = Tokenizer.from_file(BYTE_VOCABULARY)
    want = [len(known.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert Counter(BYTE_VOCABULARY).count(pa.array(texts)).tolist() == want


def test_counts_survive_a_full_cache(texts, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 5)
    counter, encoder = Counter(BYTE_VOCABULARY), WordEncoder(WORD_VOCABULARY)
    assert counter.count(pa.array(texts)).tolist() == Counter(BYTE_VOCABULARY).count(pa.array(texts)).tolist()
    first = encoder.encode(pa.array(texts))
    assert all((a == b).all() for a, b in zip(first, encoder.encode(pa.array(texts))))


def test_single_tokens_are_proved():
    known = Tokenizer.from_file(BYTE_VOCABULARY)
    single = single_tokens(BYTE_VOCABULARY)
    assert 40_000 < len(single) <= known.get_vocab_size(False)
    for token in random.Random(1).sample(sorted(single), 300):
        assert [t.value for t in known.model.tokenize(token)] == [token]


def test_ids_are_the_librarys(texts):
    known = Tokenizer.from_file(WORD_VOCABULARY)
    ids, first = WordEncoder(WORD_VOCABULARY).encode(pa.array(texts))
    for text, a, b in zip(texts, first[:-1], first[1:]):
        assert ids[a:b].tolist() == known.encode(text or "", add_special_tokens=False).ids


def test_parts_of_a_table(texts):
    whole, known = pa.array(texts), Tokenizer.from_file(WORD_VOCABULARY)
    cuts = list(tokens.parts(whole, 300))
    assert len(cuts) > 20 and pa.concat_arrays(cuts).equals(whole)
    counter, encoder, at = Counter(BYTE_VOCABULARY), WordEncoder(WORD_VOCABULARY), 0
    for part in cuts:
        ids, first = encoder.encode(part)
        counts = counter.count(part)
        for i, text in enumerate(texts[at : at + len(part)]):
            assert ids[first[i] : first[i + 1]].tolist() == known.encode(text or "", add_special_tokens=False).ids
            assert counts[i] == counter.count_one(text or "")
        at += len(part)


def test_count_query(spark, make_docs, odd_texts):
    found = count_tokens(make_docs(odd_texts + [(None, "the end")]), BYTE_VOCABULARY).collect()
    known = Tokenizer.from_file(BYTE_VOCABULARY)
    for r, text in zip(found, odd_texts + ["the end"]):
        n = len(known.encode(text or "", add_special_tokens=False).ids)
        assert tuple(r)[1:] == (len((text or "").encode()), n, n > 512)
    assert count_tokens(make_docs([]), BYTE_VOCABULARY).count() == 0


def test_schedule_covers_every_token_once():
    rng = random.Random(1)
    for _ in range(200):
        n, window = rng.randint(1, 6), rng.choice([8, 16, 64])
        totals, docs = [0] * n, []
        for _ in range(rng.randint(1, 40)):
            q, size = rng.randrange(n), rng.randint(1, 50)
            docs.append((q, totals[q], size))
            totals[q] += size
        weights = rng.choice([totals, [rng.random() for _ in totals], [0.0] * n])
        columns = [np.array(c) for c in zip(*docs)]
        doc, start, length, place = cut(schedule(totals, weights, window), *columns, window)
        covered = np.zeros(sum(totals), dtype=int)
        for p, m in zip(place, length):
            assert p // window == (p + m - 1) // window
            covered[p : p + m] += 1
        assert (covered == 1).all()
        for k, (_, _, size) in enumerate(docs):
            at = 0
            for i in np.flatnonzero(doc == k):
                assert start[i] == at
                at += length[i]
            assert at == size


def test_windows_keep_the_proportions():
    totals, window = [600_000, 250_000, 150_000], 1000
    phases = schedule(totals, totals, window)
    columns = [np.array(c) for c in zip(*[(q, 0, n) for q, n in enumerate(totals)])]
    doc, _, length, place = cut(phases, *columns, window)
    share = np.zeros((1000, 3))
    np.add.at(share, (place // window, doc), length)
    assert np.abs(share - np.array([600, 250, 150])).max() <= 3


def test_target_weights_hold_until_a_source_runs_dry():
    phases = schedule([1000, 9000], [0.5, 0.5], 100)
    _, _, length, place = cut(phases, np.array([0]), np.array([0]), np.array([1000]), 100)
    assert place.max() < 2000 and (length <= 51).all()


def round_robin(totals, weights, window, quantum):
    """The stream of (source, token) of deficit round-robin, round by round."""
    room = 1 << max(8, min(30, 60 - max(sum(totals) + quantum, window).bit_length()))
    sent, deficit, stream = [0] * len(totals), [0] * len(totals), []
    while any(s < t for s, t in zip(sent, totals)):
        open_ = [s < t for s, t in zip(sent, totals)]
        whole = sum(w for w, o in zip(weights, open_) if o) or 1
        units = [max(1, round(w / whole * room)) if o else 0 for w, o in zip(weights, open_)]
        # Whole tokens of credit go on with the sources that are left, but never cover all that one has.
        deficit = [Fraction(min(int(d), t - s - 1)) if o else Fraction(0) for d, s, t, o in zip(deficit, sent, totals, open_)]
        dry = False
        while not dry:
            for q, u in enumerate(units):
                deficit[q] += Fraction(window * u, sum(units))
                left = totals[q] - sent[q]
                size = quantum if window * u < quantum * sum(units) else 1
                n = left if deficit[q] >= left else int(deficit[q]) // size * size
                stream += [(q, sent[q] + k) for k in range(n)]
                sent[q], deficit[q] = sent[q] + n, deficit[q] - n
                dry |= open_[q] and sent[q] == totals[q]
    return stream


def test_pieces_are_those_of_round_robin_step_by_step():
    rng = random.Random(7)
    for trial in range(60):
        n, window, quantum = rng.randint(1, 7), rng.choice([16, 50, 128]), rng.choice([1, 4, 16])
        totals = [rng.choice([0, rng.randint(1, 30), rng.randint(200, 1500)]) for _ in range(n)]
        weights = rng.choice([totals, [rng.random() for _ in totals], [rng.choice([0.0, 0.01, 1.0]) for _ in totals]])
        docs = []
        for q, total in enumerate(totals):
            at = 0
            while at < total:
                size = min(rng.randint(1, 90), total - at)
                docs.append((q, at, size))
                at += size
        if not docs:
            continue
        queue, begin, length = (np.array(c) for c in zip(*docs))
        phases = schedule(totals, weights, window, quantum)
        doc, start, size, place = cut(phases, queue, begin, length, window)
        stream = [None] * sum(totals)
        for d, s, m, p in zip(doc.tolist(), start.tolist(), size.tolist(), place.tolist()):
            for k in range(m):
                assert stream[p + k] is None
                stream[p + k] = (docs[d][0], docs[d][1] + s + k)
        assert stream == round_robin(totals, weights, window, quantum)


@pytest.mark.parametrize("rare", [1, 1000, 200_000])
def test_a_rare_source_takes_little_memory(rare):
    totals = [rare] + [7 * 10**9 // 19] * 19
    phases = schedule(totals, totals, 2048)
    tracemalloc.start()
    doc, start, length, place = cut(phases, np.array([0]), np.array([0]), np.array([rare]), 2048)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 200 * 2**20
    assert length.sum() == rare and len(doc) <= 2 * (rare // 64 + 2)
    # Spread over the whole stream, in quanta; only sequence borders cut these.
    if rare > 64:
        assert place.min() < sum(totals) / 100 + 64 * sum(totals) / rare and place.max() > 0.99 * sum(totals)
        assert np.median(length) == 64


def test_a_hundred_sources_keep_their_targets(spark, make_docs, ws, tmp_path):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(400, 900))), "en", f"s{i % 100:02d}") for i in range(400)]
    docs = make_docs(texts, tmp_path / "docs")
    weights = {f"s{q:02d}": 1.0 + q % 4 for q in range(100)}
    pieces = pack_by_mixture(docs, WORD_VOCABULARY, ws, weights=weights, sequence=4096).collect()
    source = {i: s for i, _, _, s in texts}
    sequences = sorted({r["sequence_id"] for r in pieces})
    taken = np.zeros((len(sequences), 100))
    for r in pieces:
        taken[r["sequence_id"], int(source[r["doc_id"]][1:])] += r["length"]
    upto = taken.cumsum(axis=0)
    # Until a source runs dry each has its share of the stream, but for what it saves up.
    want = np.array([1.0 + q % 4 for q in range(100)]) / 250
    whole = taken.sum(axis=0)
    ahead = [n for n in range(len(sequences)) if (want * upto[n].sum() < whole - 100).all()]
    assert len(ahead) > 10
    for n in ahead:
        assert np.abs(upto[n] - want * upto[n].sum()).max() < 2 * 128 + 20
    with pytest.raises(ValueError, match="weights"):
        pack_by_mixture(docs, WORD_VOCABULARY, ws, weights=weights, queues=99)


def check_pieces(found, texts):
    known = Tokenizer.from_file(WORD_VOCABULARY)
    rows = sorted(found, key=lambda r: (r["sequence_id"], r["offset"]))
    at = (0, 0)
    for r in rows:
        assert (r["sequence_id"], r["offset"]) == at and r["length"] > 0
        end = r["offset"] + r["length"]
        at = (r["sequence_id"], end) if end < 2048 else (r["sequence_id"] + 1, 0)
    by_doc = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in texts:
        ids = np.array([*known.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        done = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r["start"]):
            assert r["start"] == done and r["doc_tokens"] == len(ids)
            piece = ids[done : done + r["length"]].tobytes()
            assert r["ids_crc32"] == zlib.crc32(piece)
            done += r["length"]
        assert done == len(ids)
    assert not by_doc


def test_packing_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(QUERIES["op5_packing"](spark, sf).collect(), texts)


def test_packing_odd_rows(spark, make_docs, ws, odd_texts, tmp_path):
    texts = [(i, t) for i, t in enumerate(odd_texts + TRICKY)]
    docs = make_docs([(i, t, "en", [None, "a", "b"][i % 3]) for i, t in texts], tmp_path / "docs")
    pieces = pack_by_mixture(docs, WORD_VOCABULARY, ws).selectExpr("* except (ids)", "crc32(ids) AS ids_crc32")
    check_pieces(pieces.collect(), texts)
    few = pack_by_mixture(docs, WORD_VOCABULARY, ws, queues=2).selectExpr("* except (ids)", "crc32(ids) AS ids_crc32")
    check_pieces(few.collect(), texts)
    assert pack_by_mixture(make_docs([]), WORD_VOCABULARY, ws).count() == 0


def test_repeated_rows_are_packed_each(spark, make_docs, ws):
    found = pack_by_mixture(make_docs([(1, "same text")] * 3), WORD_VOCABULARY, ws).collect()
    assert sum(r["length"] for r in found) == 9
