"""Periodic runs of words by maximal pairs of a bottom-up LCP-interval tree.

A pair of places whose words agree for some length, but not one word to the left and not one further to the
right, is maximal. If the distance of the places is at most a third of that length, the words from the first
place to the end of the second are a run: they repeat with that distance at least four times, and the pair
being maximal is what keeps the run from going on. So nothing has to be extended. Pairs are enumerated while
the intervals of the suffix array with a common beginning are merged, the longest beginnings first. An interval
keeps its places sorted, all together and by the word to their left; the smaller of two merged intervals
asks the larger one for places near each of its own with another word to their left.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspindle.llm.text import in_task, raw_texts

# A run repeats at least so often and has at least so many words.
REPEATS, LEAST_WORDS = 4, 6
# With one word less than LEAST_WORDS in common the period is 1; fewer are never enough.
LEAST_COMMON = LEAST_WORDS - 1
# Documents of about so many words are sorted together; a longer one by itself.
TOGETHER_WORDS = 1 << 18

Run = tuple[int, int, int]  # first word, number of words, smallest period


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``LEAST_COMMON`` - 1 words occur elsewhere, in the order of their suffixes, and common lengths.

    Prefix doubling: names of 1, 2, 4, ... words in order, refined only where two places still agree. The
    names of all steps give the number of words that neighbours in the order share: entry ``i`` is about
    places ``i - 1`` and ``i``.
    """
    n = len(words)
    names = np.full(n + 1, -1, dtype=np.int64)
    names[:n] = words
    steps, width = [], 1
    order = np.argsort(words, kind="stable")
    while True:
        ranked = names[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        if width > 1:
            follow = names[np.minimum(order + width // 2, n)]
            new[1:] |= follow[1:] != follow[:-1]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        refined = names.copy()
        if width == 1:
            refined[order] = head[group]
        else:
            old = np.ones(len(order), dtype=bool)
            old[1:] = ranked[1:] != ranked[:-1]
            start_of_old = np.flatnonzero(old)[np.cumsum(old) - 1]
            refined[order] = ranked + head[group] - start_of_old
        names = refined
        steps.append((width, names))
        order = order[np.bincount(group, minlength=len(head))[group] > 1] if len(order) else order
        if width == LEAST_COMMON - 1:
            kept = order
        if width >= LEAST_COMMON - 1 and not len(order):
            break
        order = order[np.lexsort((names[np.minimum(order + width, n)], names[order]))]
        width *= 2
    kept = kept[np.argsort(names[kept], kind="stable")]
    left, right = kept[:-1].copy(), kept[1:].copy()
    common = np.zeros(len(kept), dtype=np.int64)
    for width, names in reversed(steps):
        same = names[np.minimum(left, n)] == names[np.minimum(right, n)]
        same &= (left < n) & (right < n)
        common[1:][same] += width
        left[same] += width
        right[same] += width
    return kept, common


class Interval:
    """Places with a common beginning, sorted: all, and those with the same word to their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, before: int):
        self.places = [place]
        self.classes = {before: [place]}

    def near(self, low: int, high: int, before: int, left_words: list[int]) -> Iterator[int]:
        """Places from ``low`` to ``high`` whose left word is not ``before``.

        Places nearer to each other than two thirds of what they have in common are evenly spaced, and all
        but the first have the same left word; so the two ends tell which classes lie in between.
        """
        a = bisect_left(self.places, low)
        b = bisect_right(self.places, high, a)
        if a < b:
            for other in {left_words[self.places[a]], left_words[self.places[b - 1]]} - {before}:
                listed = self.classes[other]
                yield from listed[bisect_left(listed, low) : bisect_right(listed, high)]

    def take(self, other: Interval) -> None:
        for place in other.places:
            insort(self.places, place)
        for before, listed in other.classes.items():
            mine = self.classes.setdefault(before, listed)
            if mine is not listed:
                for place in listed:
                    insort(mine, place)


def maximal_pairs(order: np.ndarray, common: np.ndarray, left_words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(first place, distance, common length) of every maximal pair near enough to be a run, the bottom of the tree first."""
    stack: list[tuple[int, Interval]] = []  # each with what it has in common with the interval before it
    ahead = np.append(common[1:], 0).tolist()
    behind = 0
    for place, next_common in zip(order.tolist(), ahead):
        # Suffixes that share too little with both neighbours are in no pair.
        if behind >= LEAST_COMMON or next_common >= LEAST_COMMON:
            stack.append((behind, Interval(place, left_words[place])))
        while len(stack) > 1 and stack[-1][0] > next_common and stack[-1][0] >= LEAST_COMMON:
            shared, last = stack.pop()
            before, first = stack.pop()
            reach = shared // (REPEATS - 1)
            small, large = (first, last) if len(first.places) < len(last.places) else (last, first)
            for listed_before, listed in small.classes.items():
                for one in listed:
                    for two in large.near(one - reach, one + reach, listed_before, left_words):
                        yield min(one, two), abs(one - two), shared
            large.take(small)
            stack.append((before, large))
        if next_common < LEAST_COMMON:
            stack.clear()
        behind = next_common


def runs_of(words: np.ndarray, first: np.ndarray) -> list[list[Run]]:
    """The runs of several texts, each by start and then period.

    ``words`` are numbers of all words, with no number in two texts, so no suffix agrees with one of another
    text; ``first`` is where each text begins, one entry more than texts. A run of a multiple of its smallest
    period is found for that as well; the least is kept.
    """
    found: list[list[Run]] = [[] for _ in range(len(first) - 1)]
    if not len(words):
        return found
    left_words = np.append(-1, words[:-1])
    begins = first[:-1][np.diff(first) > 0]
    left_words[begins] = -1 - np.arange(len(begins))  # the beginning of a text is like no word
    order, common = suffix_order(words)
    least: dict[tuple[int, int], int] = {}
    for place, distance, shared in maximal_pairs(order, common, left_words.tolist()):
        key = (place, shared + distance)
        least[key] = min(distance, least.get(key, distance))
    if least:
        runs = sorted((place, period, length) for (place, length), period in least.items())
        text = np.searchsorted(first, [r[0] for r in runs], side="right") - 1
        for t, (place, period, length) in zip(text.tolist(), runs):
            found[t].append((place - int(first[t]), length, period))
    return found


def most_repeated(runs: list[Run]) -> Run | None:
    """The run with the greatest length by period; of equal ones the first, then that of the least period."""

    def order(a: Run, b: Run) -> int:
        return (b[1] * a[2] - a[1] * b[2]) or (a[0] - b[0]) or (a[2] - b[2])

    return min(runs, key=cmp_to_key(order)) if runs else None


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run is reduced to its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def repeated_from(n: int, seed: int) -> np.ndarray:
    """Which original word stands at each of ``n`` places; for one seed in ten the words from some place on repeat.

    The contract's rule, which makes runs of known periods.
    """
    at = np.arange(n)
    if seed % 10 == 0 and n:
        g = seed // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


@dataclass(frozen=True)
class Text:
    """A text's words, as bytes and as numbers of their own."""

    words: list[bytes]
    numbers: np.ndarray


def _texts(batch: pa.RecordBatch) -> Iterator[Text]:
    offsets, data = raw_texts(batch.column("__text"))
    seeds = batch.column("seed").to_pylist() if "seed" in batch.schema.names else None
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        words = data[a:b].tobytes().split()  # at the six ASCII white-space characters
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        numbers = np.array([known[w] for w in words], dtype=np.int64)
        if seeds is not None and seeds[i] is not None and seeds[i] % 10 == 0 and words:
            at = repeated_from(len(words), seeds[i])
            words, numbers = [words[k] for k in at.tolist()], numbers[at]
        yield Text(words, numbers)


def _found(batch: pa.RecordBatch) -> Iterator[tuple[Text, list[Run]]]:
    """Texts with their runs, some texts at a time."""

    def done(texts: list[Text]) -> Iterator[tuple[Text, list[Run]]]:
        numbers, above = [], 0
        for text in texts:
            numbers.append(text.numbers + above)
            above += len(text.words)
        first = np.concatenate([[0], np.cumsum([len(t.words) for t in texts], dtype=np.int64)])
        yield from zip(texts, runs_of(np.concatenate(numbers), first))

    held, size = [], 0
    for text in _texts(batch):
        if held and size + len(text.words) > TOGETHER_WORDS:
            yield from done(held)
            held, size = [], 0
        held.append(text)
        size += len(text.words)
    if held:
        yield from done(held)


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, best, collapsed = [], [], []
        for text, found in _found(batch):
            runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
            top = most_repeated(found)
            best.append(None if top is None else dict(zip(("start", "length", "period"), top)))
            words = text.words
            if found:
                words = [words[k] for k in np.flatnonzero(kept_words(len(words), found)).tolist()]
            collapsed.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(runs, pa.list_(_run_type)),
                pa.array(best, _run_type),
                pa.array(collapsed, pa.large_binary()).cast(pa.large_string()),
            ],
            names=["doc_id", "runs", "best", "collapsed"],
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _detect(batches):
        runs = batch.column("runs").to_pylist()
        listed = ["".join(f"{r['start']},{r['length']},{r['period']}\n" for r in sorted(own, key=lambda r: (r["start"], r["period"]))) for own in runs]
        offsets, data = raw_texts(batch.column("collapsed"))
        collapsed = [hashlib.sha256(data[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(own) for own in runs], pa.int64()),
                batch.column("best"),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in listed]),
                pa.array(collapsed),
            ],
            names=["doc_id", "n_runs", "best", "runs_sha256", "collapsed_sha256"],
        )


def _narrow(docs: DataFrame, seeded: bool) -> DataFrame:
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("seed")
    return docs.select("doc_id", F.col("text").alias("__text"), *[seed] * seeded)


def find_runs(docs: DataFrame, seeded: bool = False) -> DataFrame:
    """``doc_id, runs, best, collapsed`` of every row of ``docs``.

    ``runs`` are all stretches of words, (start, length, period), that repeat with their smallest period
    at least four times, have six words or more and go on to neither side; sorted by start, then period. ``best``
    is the one that repeats most often, null without one. ``collapsed`` is the text with each run reduced to
    its first period and one space between words.

    Words are runs of bytes other than the six ASCII white-space characters; they are compared as they are.
    With ``seeded`` one document in ten, by its id, is first made to repeat (see ``repeated_from``). A null
    or empty text has no words, no runs and an empty ``collapsed``; a null doc_id is not made to repeat.
    Equal rows have equal results. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    A text is searched as a whole, in one task, whatever its length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    best = "struct<start: bigint, length: bigint, period: bigint>"
    schema = f"doc_id {kind}, runs {RUNS}, best {best}, collapsed string"
    return _narrow(docs, seeded).mapInArrow(in_task(_detect), schema)


def run_digests(docs: DataFrame, seeded: bool = True) -> DataFrame:
    """``find_runs`` in short: number of runs, the best one, and SHA-256 digests of all runs and of the collapsed text.

    Rows are those of ``find_runs``, also in what it says about odd ones.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    best = "struct<start: bigint, length: bigint, period: bigint>"
    schema = f"doc_id {kind}, n_runs bigint, best {best}, runs_sha256 string, collapsed_sha256 string"
    found = _narrow(docs, seeded).mapInArrow(in_task(_digest), schema)
    return found.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
