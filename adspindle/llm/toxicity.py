"""Toxic passages: maximum-scoring segments over token log-odds, calibrated as extreme values.

A token is a run of ASCII letters and other characters beyond ASCII, A-Z as a-z. It scores by the log-odds of the
toxic against the clean class, under a Dirichlet prior made of both classes' counts, for itself and for its
beginnings; the best supported of these counts, less a margin, and all others cost a little. The stretches
that no longer or shorter stretch beats are found in one linear scan. How often clean text of some length
has a stretch of some score follows an extreme-value law, whose two parameters come from the clean training
documents; what a document has beyond that is added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.llm.text import _powers, _values, in_task, mix, names_of, slices, words_of
from adspindle.sources.workspace import Workspace

FOLDS, HELD_OUT = 5, 0
# About so many labelled documents are learnt from, chosen by a hash of their ids; fewer are all used.
FIT_DOCS = 200_000
# Beginnings of a token, in bytes, that are scored as well; the whole token always is.
BEGINNINGS = range(4, 11)
# Weight of the prior in tokens, and the least that any entry gets of it.
PRIOR, LEAST_PRIOR = 2000.0, 0.01
# A token's log-odds count less so many standard deviations, and less the margin.
DEVIATIONS, MARGIN = 2.0, 0.5
# What a token without evidence costs a stretch.
COST = 0.1
# Histograms that reach the driver: steps of token and stretch scores, and of documents' sums, up to a limit.
SCORE_STEP, SUM_STEP, MOST_SUM = 0.01, 0.125, 64.0
# Entries that a task counts before it hands them on.
HELD = 2_000_000

_letter = np.zeros(256, dtype=bool)
_letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_WHOLE = np.uint64(0x9FB21C651E98DF25)
_of_size = mix(np.arange(256, dtype=np.uint64))


def fold(doc_id: Column) -> Column:
    """The fold of a document, 0 to 4; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


@dataclass
class Tokens:
    """All tokens of a slice: where they begin and end, each text's first one, and numbers of them and their beginnings."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    entries: list[tuple[np.ndarray, np.ndarray]]  # (tokens, their numbers) per kind of entry


def tokens_of(offsets: np.ndarray, data: np.ndarray) -> Tokens:
    letters = np.where(_letter[data], data, np.uint8(32))
    found = words_of(offsets, letters)
    up, down = _powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_values[letters] * up[: len(data)], out=sums[1:])
    length = found.end - found.start
    entries = [(np.arange(len(found.start)), mix(found.number ^ _WHOLE))]
    for k in BEGINNINGS:
        at = np.flatnonzero(length > k)
        start = found.start[at]
        number = (sums[start + k] - sums[start]) * down[start]
        entries.append((at, mix(number ^ _of_size[k])))
    return Tokens(found.start, found.end, found.first, entries)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Entries, each once, with the sums of their clean and toxic counts."""
    entry, back = np.unique(np.concatenate([e for e, _ in parts]), return_inverse=True)
    counts = np.concatenate([c for _, c in parts], axis=1)
    return entry, np.stack([np.bincount(back, c, len(entry)).astype(np.int64) for c in counts])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every entry, in how many clean and toxic documents it is found, once for each different token with it.

    The row without an entry has the numbers of tokens.
    """
    totals, held = np.zeros(2, dtype=np.int64), []

    def rows(entry: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"entry": pa.array(entry.view(np.int64)), "clean": pa.array(counts[0]), "toxic": pa.array(counts[1])}
        )

    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for row, offsets, data in slices(batch.column("__text")):
            tokens = tokens_of(offsets, data)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(tokens.first))
            _, once = np.unique(np.stack([owner.astype(np.uint64), tokens.entries[0][1]]), axis=1, return_index=True)
            known = np.zeros(len(owner), dtype=bool)
            known[once] = True
            kind = toxic[row + owner]
            totals += np.bincount(kind[known], minlength=2)
            for at, number in tokens.entries:
                mine = known[at]
                is_toxic = kind[at][mine]
                held.append((number[mine], np.stack([1 - is_toxic, is_toxic])))
        if sum(len(e) for e, _ in held) > HELD:
            held = [_merged(held)]
            if len(held[0][0]) > HELD:
                yield rows(*held.pop())
    if held:
        yield rows(*_merged(held))
    yield pa.RecordBatch.from_pydict(
        {"entry": pa.array([None], pa.int64()), "clean": pa.array(totals[:1]), "toxic": pa.array(totals[1:])}
    )


def entry_scores(clean: np.ndarray, toxic: np.ndarray, clean_total: float, toxic_total: float) -> np.ndarray:
    """What entries with these counts score: the lower end of their log-odds, less the margin."""
    prior = PRIOR * (clean + toxic) / max(clean_total + toxic_total, 1) + LEAST_PRIOR
    a, b = toxic + prior, clean + prior
    odds = np.log(a / np.maximum(toxic_total + PRIOR - a, LEAST_PRIOR)) - np.log(b / np.maximum(clean_total + PRIOR - b, LEAST_PRIOR))
    return odds - DEVIATIONS * np.sqrt(1 / a + 1 / b) - MARGIN


def segments(scores: np.ndarray, cost: float = COST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text, (first, end, score) in order, from its tokens' scores.

    Positive scores are visited one by one; all others cost the same, so the sum up to any token is known.
    A segment remembers the nearest one before it whose left sum is lower; a search that goes along these
    links never visits a segment twice that a later one has passed, so the scan is linear.
    """
    at = np.flatnonzero(scores > 0)
    before = (np.concatenate([[0.0], np.cumsum(scores[at])])[:-1] - cost * (at - np.arange(len(at)))).tolist()
    found: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, first, end, link
    for i, left, gain in zip(at.tolist(), before, scores[at].tolist()):
        right, first = left + gain, i
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append((left, right, first, i + 1, j))
                break
            left, first = found[j][0], found[j][2]
            del found[j:]
    return [(first, end, right - left) for left, right, first, end, _ in found]


@dataclass(frozen=True)
class Model:
    """Entries that speak for toxicity, the extreme-value law of clean text, and the logistic of a document's sum."""

    entries: np.ndarray
    scores: np.ndarray
    decay: float = 1.0
    often: float = 1.0
    slope: float = 0.0
    middle: float = 0.0

    def of_tokens(self, tokens: Tokens) -> np.ndarray:
        best = np.full(len(tokens.start), -COST)
        if len(self.entries):
            for at, number in tokens.entries:
                place = np.minimum(np.searchsorted(self.entries, number), len(self.entries) - 1)
                hit = self.entries[place] == number
                best[at[hit]] = np.maximum(best[at[hit]], self.scores[place[hit]])
        return best

    def beyond(self, score: float, n: int) -> float:
        """By how much a stretch's score goes beyond what clean text of ``n`` tokens has once: minus its log E-value."""
        return self.decay * score - np.log(self.often * n)

    def probability(self, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.slope * (self.middle - total), -700, 700)))


def _texts(texts: pa.Array, model: Model) -> Iterator[tuple[Tokens, int, int, np.ndarray, np.ndarray]]:
    """For each text its slice's tokens, its own range of them, their scores, and the text's first byte."""
    for _, offsets, data in slices(texts):
        tokens = tokens_of(offsets, data)
        scores = model.of_tokens(tokens)
        for i, (a, b) in enumerate(zip(tokens.first[:-1].tolist(), tokens.first[1:].tolist())):
            yield tokens, a, b, scores[a:b], offsets[i]


def _trial(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Of training documents: number of tokens, the positive token scores, and the scores of all segments."""
    for batch in batches:
        sizes, positive, found = [], [], []
        for _, a, b, scores, _ in _texts(batch.column("__text"), model):
            sizes.append(b - a)
            positive.append(scores[scores > 0])
            found.append([s for *_, s in segments(scores)])
        yield pa.RecordBatch.from_pydict(
            {
                "toxic": batch.column("toxic"),
                "tokens": pa.array(sizes, pa.int64()),
                "positive": pa.array(positive, pa.list_(pa.float64())),
                "segments": pa.array(found, pa.list_(pa.float64())),
            }
        )


def decay_of(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of the mean of exp(decay * score) = 1 over a distribution of token scores."""

    def excess(decay: float) -> float:
        return float((counts * np.expm1(np.minimum(decay * scores, 700))).sum())

    if not len(scores) or (counts * scores).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e6:
        low, high = high, 2 * high
    for _ in range(100):
        low, high = ((low + high) / 2, high) if excess((low + high) / 2) < 0 else (low, (low + high) / 2)
    return low


def logistic_of(total: np.ndarray, toxic: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve through binned sums, by Newton's method with a weak prior."""
    x, beta = np.stack([np.ones(len(total)), total], axis=1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(np.clip(-x @ beta, -700, 700)))
        gradient = x.T @ (count * (toxic - p)) - np.array([1e-3, 1e-2]) * beta
        hessian = (x * (count * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-2])
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    slope = max(beta[1], 1e-3)
    return float(slope), float(-beta[0] / slope)


def _labelled(docs: DataFrame, labels: DataFrame, fit_docs: int) -> DataFrame:
    """``toxic, __text`` of the labelled documents outside the held-out fold, each text once."""
    usable = labels.where("toxic IN (0, 1)").select(F.col("doc_id").alias("__id"), F.col("toxic").cast("bigint").alias("toxic"))
    usable = usable.where(fold(F.col("__id")) != HELD_OUT).distinct()
    share = fit_docs / max(usable.count(), 1)
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64("__id"), F.lit(2**30)) < int(share * 2**30))
    # About fit_docs ids at most.
    rows = docs.select("doc_id", F.col("text").alias("__text")).join(F.broadcast(usable), F.col("doc_id") == F.col("__id"))
    return rows.select("toxic", "__text")


def _each_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's two numbers go with it, so that copies can be found without comparing texts."""
    for batch in batches:
        a, b = [], []
        for _, offsets, data in slices(batch.column("__text")):
            x, y = names_of(offsets, data)
            a.append(x)
            b.append(y)
        numbers = [pa.array((np.concatenate(v) if v else np.zeros(0, np.uint64)).view(np.int64)) for v in (a, b)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=[*batch.schema.names, "a", "b"])


def learn(docs: DataFrame, labels: DataFrame, workspace: Workspace, fit_docs: int = FIT_DOCS) -> Model:
    """The model of the labelled documents outside the held-out fold; copies of a text count once.

    What reaches the driver is the entries that speak for toxicity, of at most about ``fit_docs``
    documents, and three histograms of bounded size. Without a label of each class no entry speaks.
    """
    rows = _labelled(docs, labels, fit_docs).mapInArrow(in_task(_each_once), "toxic bigint, __text string, a bigint, b bigint")
    rows, _ = workspace.save(rows.dropDuplicates(["toxic", "a", "b"]).select("toxic", "__text"), "labelled")
    counts = rows.mapInArrow(in_task(_count), "entry bigint, clean bigint, toxic bigint")
    counts = counts.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts, _ = workspace.save(counts, "counts")
    whole = counts.where("entry IS NULL").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0))
    clean, toxic = whole["clean"], whole["toxic"]
    # An entry that is no more frequent among toxic than among clean tokens can't score.
    likely = counts.where("entry IS NOT NULL").where(F.col("toxic") * float(clean) > F.col("clean") * float(toxic))
    prior = F.lit(PRIOR / (clean + toxic)) * (F.col("clean") + F.col("toxic")) + LEAST_PRIOR
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(a / (F.lit(toxic + PRIOR) - a)) - F.log(b / (F.lit(clean + PRIOR) - b))
    speaking = likely.where(odds - DEVIATIONS * F.sqrt(1 / a + 1 / b) > MARGIN).toPandas()
    entry = speaking["entry"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(entry)
    score = entry_scores(*(speaking[c].to_numpy(dtype=float) for c in ("clean", "toxic")), clean, toxic)
    return _calibrated(rows, Model(entry[order], score[order]), workspace)


def _calibrated(rows: DataFrame, model: Model, workspace: Workspace) -> Model:
    trial = rows.mapInArrow(
        in_task(_trial, model), "toxic bigint, tokens bigint, positive array<double>, segments array<double>"
    )
    trial, _ = workspace.save(trial, "trial")
    clean = trial.where("toxic = 0")

    def bins(column: str) -> tuple[np.ndarray, np.ndarray]:
        step = F.round(F.col("s") / SCORE_STEP).cast("bigint").alias("bin")
        found = clean.select(F.explode(column).alias("s")).groupBy(step).count().orderBy("bin").collect()
        return np.array([r[0] * SCORE_STEP for r in found]), np.array([float(r[1]) for r in found])

    tokens = float(clean.agg(F.sum("tokens")).first()[0] or 0)
    score, count = bins("positive")
    # The best entry counts as seen once, so clean text without any evidence has a law as well.
    score = np.append(score, [model.scores.max(initial=MARGIN), -COST])
    count = np.append(count, [1.0, max(tokens - count.sum(), 1.0)])
    decay = decay_of(score, count)
    score, count = bins("segments")
    above = np.cumsum(count[::-1])[::-1]  # segments at each score or higher
    level = int(np.searchsorted(-above, -max(above[0] / 10, 1), side="right")) - 1 if len(above) else 0
    seen, at = (above[level], score[level]) if len(above) else (0.0, float(model.scores.max(initial=MARGIN)))
    often = (seen + 1) / (max(tokens, 1.0) * np.exp(-decay * at))
    found = Model(model.entries, model.scores, decay, float(max(often, 1e-300)))
    beyond = F.aggregate(
        "segments", F.lit(0.0), lambda t, s: t + F.greatest(F.lit(0.0), s * decay - F.log(F.col("tokens") * found.often))
    )
    step = F.least(F.floor(beyond / SUM_STEP), F.lit(int(MOST_SUM / SUM_STEP))).alias("bin")
    rows = trial.groupBy("toxic", step).count().orderBy("toxic", "bin").collect()
    totals = np.array([r["bin"] * SUM_STEP for r in rows])
    slope, middle = logistic_of(totals, np.array([float(r["toxic"]) for r in rows]), np.array([float(r["count"]) for r in rows]))
    return Model(model.entries, model.scores, decay, found.often, slope, middle)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, passages = [], []
        for _, a, b, scores, _ in _texts(batch.column("__text"), model):
            beyond = [model.beyond(s, b - a) for *_, s in segments(scores)]
            totals.append(min(sum(x for x in beyond if x > 0), MOST_SUM))
            passages.append(sum(x > 0 for x in beyond))
        made = pa.array(model.probability(np.array(totals, dtype=float)), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), made, pa.array(passages, pa.int64())], names=["doc_id", "score", "passages"]
        )


def classify_toxicity(docs: DataFrame, labels: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` of every row of ``docs``; ``passages`` counts significant ones.

    Learnt from labelled rows outside the held-out fold; only the text is an input of a score. A null
    text is empty, has no passage and the lowest score; a null doc_id is in no held-out fold and never
    labelled. Labels other than 0 and 1 are not used; equal rows have equal scores. Without a label of each
    class every score is 0.5. An empty table gives no rows. Only ``doc_id`` and ``text`` are read of
    ``docs``, ``doc_id`` and ``toxic`` of ``labels``.
    """
    return predictions(docs, learn(docs, labels, workspace))


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.col("text").alias("__text"))
    scored = narrow.mapInArrow(in_task(_score, model), f"doc_id {kind}, score double, passages bigint")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


def _passages(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, (tokens, a, b, scores, base) in enumerate(_texts(batch.column("__text"), model)):
            for first, end, score in segments(scores):
                beyond = model.beyond(score, b - a)
                if beyond > 0:
                    rows.append((i, tokens.start[a + first] - base, tokens.end[a + end - 1] - base, score, np.exp(-beyond)))
        owner = pa.array([r[0] for r in rows], pa.int64())
        columns = [batch.column("doc_id").take(owner)]
        columns += [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64()), (4, pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "end", "score", "expected"])


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, start, end, score, expected`` of every significant passage, one row each.

    ``start`` and ``end`` are bytes of the UTF-8 text; ``expected`` is how many passages of that score clean
    text of the same length has. Texts without one, null and empty texts have no row.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.col("text").alias("__text"))
    schema = f"doc_id {kind}, start bigint, end bigint, score double, expected double"
    return narrow.mapInArrow(in_task(_passages, model), schema)
