"""Near copies: all pairs of texts whose sets of word shingles have a Jaccard similarity of some percent or more.

Equal sets are one class. Which classes can be similar is settled by signatures, exactly: the shingle
space is dealt into more buckets than two similar sets can differ in shingles, so similar sets agree
on a whole bucket, and a bucket's content is a signature. For lower similarities a set's signatures are
its rarest shingles instead, as many as a linked set can't all be without; two classes that share one are a
candidate pair only if a short bitmap of each, the parities of their shingles' hashes, doesn't prove that they
differ in too many. Classes that are connected by signatures form a block; blocks are small, since a signature
stands for several shingles at once, or the pairs that connect them are nearly all similar. Within a block a
T-occurrence search over inverted lists finds the classes that share enough shingles with each class.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.llm.text import in_task, mix, shingles_of, slices, words_of
from adspindle.operators.identity import connected_components
from adspindle.operators.joins import key_bits, key_filter, with_possible_match
from adspindle.sources.workspace import Workspace

# The contract's fixed values.
SHINGLE, PERCENT = 3, 90
# Below this similarity buckets hold so few shingles that unlike texts agree on empty ones and nearly
# all meet in one block: signatures are then each set's rarest shingles.
BUCKET_PERCENT = 90
# Which shingles are common is judged from about so many texts, or every so manieth if that is more: the sample grows
# with the table, so a shingle that it misses is in a bounded number of texts. The order of no more than so many is kept.
SAMPLE_TEXTS, SAMPLE_EVERY, MOST_COMMON = 16_384, 16, 2**20
# So many classes with the same shingle are compared one by one; more are taken together.
FEW = 128
# Bands of set sizes; similar sets lie in one band or in neighbouring ones.
BAND = 1.25
# A block with more shingles than this is searched in cells of half this size, pair by pair.
BLOCK_SHINGLES = 400_000
# So is one with more classes, in cells of half as many.
BLOCK_CLASSES = 1024
# DivideSkip's weight of a binary probe against a step of the merge.
PROBE_WEIGHT = 0.0085

_edges = [1]
while _edges[-1] < 2**40:
    _edges.append(max(_edges[-1] + 1, int(_edges[-1] * BAND)))
BAND_EDGES = np.array(_edges, dtype=np.int64)


def most_different(largest: int, percent: int = PERCENT) -> int:
    """How many shingles two linked sets, none larger than ``largest``, can have on one side only."""
    # 100 * shared >= percent * union and |x| + |y| = shared + union give union - shared.
    return 2 * largest * (100 - percent) // (100 + percent)


def linked(shared: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def needed(a: int, b: int, percent: int = PERCENT) -> int:
    """The least number of shared shingles that links sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def sets_of(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each text's set of shingles as sorted 64-bit numbers."""
    for _, offsets, data in slices(texts):
        numbers, first = shingles_of(words_of(offsets, data), size)
        for a, b in zip(first[:-1], first[1:]):
            yield np.unique(numbers[a:b])


def class_of(numbers: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    total = mix(numbers).sum(keepdims=True, dtype=np.uint64) ^ np.uint64(len(numbers))
    return int((mix(total) >> np.uint64(1))[0])


def signatures(numbers: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """A set's signatures, one per bucket of its band and of each higher band that can hold a larger partner.

    The band of a pair is that of its larger set. Buckets left empty have a signature as well: two sets
    may agree on nothing else.
    """
    n = len(numbers)
    band = int(np.searchsorted(BAND_EDGES, n, side="right")) - 1
    last = int(np.searchsorted(BAND_EDGES, 100 * n // percent, side="right")) - 1
    bands = range(band, last + 1)
    spread = mix(numbers ^ np.uint64(0x2545F491)) >> np.uint64(32)
    content = mix(numbers ^ np.uint64(0x9E3779B9))
    found = []
    for b in bands:
        buckets = most_different(int(BAND_EDGES[b + 1]) - 1, percent) + 1
        if buckets == 1:
            continue  # only equal sets are linked
        sums = np.zeros(buckets, dtype=np.uint64)
        np.add.at(sums, ((spread * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64), content)
        name = np.uint64(b * 0x100000001B3) + np.arange(buckets, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        found.append(mix(sums + mix(name)))
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)).view(np.int64)


def rarest(numbers: np.ndarray, percent: int, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set's signatures: so many of its shingles, rarest first, that it shares one with every linked set.

    A linked set shares ``percent`` of these or more, so leaves out fewer than are taken here. That holds
    for any one order of all shingles; ``common``, sorted, and its ``counts`` only decide how few unlike
    sets meet.
    """
    n = len(numbers)
    at = np.minimum(np.searchsorted(common, numbers), max(len(common) - 1, 0))
    level = np.where(common[at] == numbers, counts[at], 0) if len(common) else np.zeros(n, dtype=np.int64)
    names = mix(numbers ^ np.uint64(0x9E3779B9))
    return names[np.lexsort((names, level))[: n + percent * -n // 100 + 1]].view(np.int64)


def parities(numbers: np.ndarray) -> bytes:
    """A bitmap of one to two bits per shingle, a power of two of them: whether a bit's shingles are odd in number.

    Of two such bitmaps, the longer one folded to the length of the other, no more bits differ than the sets
    have shingles on one side only.
    """
    bits = max(64, 1 << (len(numbers) - 1).bit_length())
    at = (mix(numbers ^ np.uint64(0x94D049BB)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_different(a: bytes, b: bytes) -> int:
    """A number of shingles that two sets with these ``parities`` have on one side only, at least."""
    if len(a) > len(b):
        a, b = b, a
    x, y, size = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(b)
    while size > 8 * len(a):
        size //= 2
        y = (y >> size) ^ (y & ((1 << size) - 1))
    return (x ^ y).bit_count()


def _near_enough(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs whose bitmaps leave it open that they are linked."""
    for batch in batches:
        u, v, nu, nv, a, b = (batch.column(c).to_pylist() for c in ("u", "v", "u_size", "v_size", "u_bits", "v_bits"))
        # What is not on one side only is on both.
        kept = [
            linked((nu[i] + nv[i] - least_different(a[i], b[i])) // 2, nu[i], nv[i], percent) for i in range(len(u))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(kept, pa.bool_()))


def _candidates(edges: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """``edges`` (u, v, tied) without the pairs that bitmaps show to be too different; ties stay."""
    pairs = edges.where("tied = 0")
    for side in ("u", "v"):
        named = maps.select(F.col("class").alias(side), F.col("n_shingles").alias(f"{side}_size"), F.col("bits").alias(f"{side}_bits"))
        pairs = pairs.join(named.hint("shuffle_hash"), side)
    near = pairs.mapInArrow(in_task(_near_enough, percent), "u bigint, v bigint")
    return edges.where("tied = 1").select("u", "v").unionByName(near)


def _shingles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for numbers in sets_of(batch.column("__text"), size):
            yield pa.RecordBatch.from_pydict({"shingle": pa.array(numbers.view(np.int64))})


def _common(narrow: DataFrame, size: int, workspace: Workspace) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several different texts of a sample have, sorted, and in how many."""
    every = max(1, min(narrow.count() // SAMPLE_TEXTS, SAMPLE_EVERY))
    texts = narrow.where(F.pmod("key", F.lit(every)) == 0).dropDuplicates(["key"]).select("__text")
    counts = texts.mapInArrow(in_task(_shingles, size), "shingle bigint").groupBy("shingle").count().where("count > 1")
    counts, _ = workspace.save(counts, "common")
    # As many rows as there are different counts, which the sample's shingles bound by their square root.
    levels = counts.groupBy(F.col("count").alias("level")).count().orderBy(F.desc("level")).collect()
    kept, least, part, of = 0, 1, 1, 1
    for level, many in levels:
        if kept + many > MOST_COMMON:
            least, part, of = level, MOST_COMMON - kept, many
            break
        kept += many
    # Of the level that exceeds the limit about as many as there is room for.
    rows = counts.where((F.col("count") > least) | (F.pmod(F.xxhash64("shingle"), F.lit(of)) < part) & (F.col("count") == least))
    rows = rows.toArrow()
    found = rows.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], rows.column("count").to_numpy()[order].astype(np.int32)


def _classify(
    batches: Iterator[pa.RecordBatch], size: int, percent: int, common: tuple[np.ndarray, np.ndarray] | None
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, names, signs, bits = [], [], [], []
        for numbers in sets_of(batch.column("__text"), size):
            sizes.append(len(numbers))
            names.append(class_of(numbers) if len(numbers) else None)
            made = signatures(numbers, percent) if common is None else rarest(numbers, percent, *common)
            signs.append(made.tobytes() if len(numbers) else None)
            bits.append(parities(numbers) if len(numbers) and common is not None else None)
        made = {c: batch.column(c) for c in ("doc_id", "key", "place")} | {"n_shingles": pa.array(sizes, pa.int64())}
        made |= {"class": pa.array(names, pa.int64()), "signatures": pa.array(signs, pa.binary()), "bits": pa.array(bits, pa.binary())}
        yield pa.RecordBatch.from_pydict(made)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per signature and class. Classes that meet on a signature already here send it once.

    The others are tied to the first by an edge row, which goes its own way, so that a signature shared
    by a large part of all classes does not gather in one place.
    """
    for batch in batches:
        signs = batch.column("signatures").to_pylist()
        counts = np.array([len(s) // 8 for s in signs], dtype=np.int64)
        sign = np.frombuffer(b"".join(signs), dtype=np.int64)
        owner = np.repeat(batch.column("class").to_numpy(zero_copy_only=False).astype(np.int64), counts)
        order = np.lexsort((owner, sign))
        sign, owner = sign[order], owner[order]
        head = np.ones(len(sign), dtype=bool)
        head[1:] = sign[1:] != sign[:-1]
        leader = owner[head][np.cumsum(head) - 1] if len(sign) else owner
        tied = np.unique(np.stack([owner[~head], leader[~head]], axis=1), axis=0)
        tied = tied[tied[:, 0] != tied[:, 1]]
        yield pa.RecordBatch.from_pydict(
            {
                "signature": pa.array(np.concatenate([sign[head], mix(tied[:, 0].astype(np.uint64)).view(np.int64)])),
                "class": pa.array(np.concatenate([owner[head], tied[:, 0]])),
                "leader": pa.array(
                    np.concatenate([np.zeros(head.sum(), dtype=np.int64), tied[:, 1]]),
                    mask=np.concatenate([np.ones(head.sum(), dtype=bool), np.zeros(len(tied), dtype=bool)]),
                ),
            }
        )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each class to the first class with the same signature; rows come sorted by signature."""
    last_sign, last_leader = None, 0
    for batch in batches:
        sign, owner = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("signature", "class"))
        known = batch.column("leader").is_valid().to_numpy(zero_copy_only=False)
        tied = np.stack([owner[known], batch.column("leader").drop_null().to_numpy(zero_copy_only=False)], axis=1)
        sign, owner = sign[~known], owner[~known]
        if len(sign):
            head = np.ones(len(sign), dtype=bool)
            head[1:] = sign[1:] != sign[:-1]
            leaders = owner[head].copy()
            if last_sign is not None and sign[0] == last_sign:
                leaders[0] = last_leader
            leader = leaders[np.cumsum(head) - 1]
            last_sign, last_leader = sign[-1], leader[-1]
            found = np.concatenate([tied, np.stack([owner, leader], axis=1)])
        else:
            found = tied
        found = np.unique(found[found[:, 0] != found[:, 1]], axis=0)
        yield pa.RecordBatch.from_pydict({"u": pa.array(found[:, 0]), "v": pa.array(found[:, 1])})


def _sized_postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """``_postings`` with set sizes and the signature's place in the set's order.

    Of more than ``FEW`` classes in a narrow band of sizes, only the smallest and the largest are sent. Any
    two of a band are near enough in size to be linked, so a class from elsewhere that is near enough to
    one of the band is so to one that is sent.
    """
    for batch in batches:
        signs = batch.column("signatures").to_pylist()
        counts = np.array([len(s) // 8 for s in signs], dtype=np.int64)
        sign = np.frombuffer(b"".join(signs), dtype=np.int64)
        owner, n = (
            np.repeat(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), counts) for c in ("class", "n_shingles")
        )
        at = np.arange(len(sign)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.lexsort((owner, n, sign))
        sign, owner, n, at = sign[order], owner[order], n[order], at[order]
        band = np.floor(np.log(n) / (np.log(100 / percent) * 0.999))
        head = np.ones(len(sign), dtype=bool)
        head[1:] = (sign[1:] != sign[:-1]) | (band[1:] != band[:-1])
        group = np.cumsum(head) - 1
        many = np.bincount(group)[group] > FEW if len(sign) else head
        sent = ~many | head | np.append(head[1:], True)[: len(head)]
        leader = owner[head][group] if len(sign) else owner
        tied = np.unique(np.stack([owner[~sent], leader[~sent]], axis=1), axis=0)
        none = np.zeros(len(tied), dtype=np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "signature": pa.array(np.concatenate([sign[sent], mix(tied[:, 0].astype(np.uint64)).view(np.int64)])),
                "size": pa.array(np.concatenate([n[sent], none])),
                "class": pa.array(np.concatenate([owner[sent], tied[:, 0]])),
                "at": pa.array(np.concatenate([np.where(many, -1, at)[sent], none])),
                "leader": pa.array(
                    np.concatenate([np.zeros(sent.sum(), dtype=np.int64), tied[:, 1]]),
                    mask=np.concatenate([np.ones(sent.sum(), dtype=bool), np.zeros(len(tied), dtype=bool)]),
                ),
            }
        )


def _sized_stars(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges between classes with the same signature that sizes and places allow to be linked.

    Rows come sorted by signature, size and class. A signature's classes fall apart where the next larger
    set is too large. Up to ``FEW`` classes that stay together are compared one by one: of the first signature
    that two linked sets share, enough of both orders must be left. More are tied to the first of them;
    such an edge, ``tied`` = 1, only says that the two stay in one block.
    """
    held = np.zeros((4, 0), dtype=np.int64)

    def heads(rows: np.ndarray) -> np.ndarray:
        head = np.ones(rows.shape[1], dtype=bool)
        head[1:] = (rows[0, 1:] != rows[0, :-1]) | (100 * rows[1, :-1] < percent * rows[1, 1:])
        return head

    def edges(rows: np.ndarray) -> np.ndarray:
        _, n, owner, at = rows
        head = heads(rows)
        group = np.cumsum(head) - 1
        many = ((np.bincount(group) > FEW) | (np.bincount(group, at < 0) > 0))[group] if len(n) else head
        found = [rows_of(owner[many], owner[head][group[many]], 1)]
        left = n - at
        x = np.flatnonzero(~many)
        for k in range(1, FEW):
            x = x[x + k < len(n)]
            x = x[(group[x] == group[x + k]) & (100 * n[x] >= percent * n[x + k])]
            if not len(x):
                break
            y = x + k
            near = np.minimum(left[x], left[y]) >= -(-percent * (n[x] + n[y]) // (100 + percent))
            found.append(rows_of(np.minimum(owner[x], owner[y])[near], np.maximum(owner[x], owner[y])[near], 0))
        return np.concatenate(found)

    def rows_of(u: np.ndarray, v: np.ndarray, tied: int) -> np.ndarray:
        return np.stack([u, v, np.full(len(u), tied)], axis=1)

    def batch_of(found: np.ndarray) -> pa.RecordBatch:
        found = np.unique(found[found[:, 0] != found[:, 1]], axis=0)
        return pa.RecordBatch.from_pydict({c: pa.array(found[:, i]) for i, c in enumerate(("u", "v", "tied"))})

    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("signature", "size", "class", "at")]
        known = batch.column("leader").is_valid().to_numpy(zero_copy_only=False)
        tied = rows_of(columns[2][known], batch.column("leader").drop_null().to_numpy(zero_copy_only=False), 1)
        rows = np.concatenate([held, np.stack(columns)[:, ~known]], axis=1)
        # The last classes may go on in the next batch; of many the first and the last will do.
        last = int(np.flatnonzero(heads(rows))[-1]) if rows.shape[1] else 0
        held, rows = rows[:, last:], rows[:, :last]
        found = [tied, edges(rows)]
        if held.shape[1] > FEW:
            found.append(edges(held))
            held = held[:, [0, -1]]
            held[3] = -1
        yield batch_of(np.concatenate(found))
    yield batch_of(edges(held))


class BlockSearch:
    """The inverted lists of a block: sorted keys ``list * members + member``, members by ascending set size."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.members, self.percent = len(sets), percent
        owner = np.repeat(np.arange(self.members), self.sizes)
        _, self.list_of = np.unique(np.concatenate(sets), return_inverse=True)
        self.keys = np.sort(self.list_of * self.members + owner)
        self.ends = np.searchsorted(self.keys, (np.arange(self.list_of.max() + 1) + 1) * self.members)

    def partners(self, x: int, others: np.ndarray | None = None) -> list[int]:
        """Members after ``x`` that share enough shingles with it, by DivideSkip.

        The lists of x's shingles are told apart by length. The short ones are merged by a heap that
        skips members that can't reach the threshold any more; who does reach it there is looked up in
        the long ones by binary search. ``others`` restricts the answer to some members.
        """
        n = int(self.sizes[x])
        limit = int(np.searchsorted(self.sizes, n * 100 // self.percent, side="right"))
        least = needed(n, n, self.percent)  # partners are not smaller
        lists = self.list_of[self.first[x] : self.first[x + 1]]
        begin = np.searchsorted(self.keys, lists * self.members + x) + 1
        length = np.minimum(np.searchsorted(self.keys, lists * self.members + limit), self.ends[lists]) - begin
        open_ = length > 0
        if open_.sum() < least:
            return []
        lists, begin, length = lists[open_], begin[open_], length[open_]
        order = np.argsort(length, kind="stable")
        lists, begin, length = lists[order], begin[order], length[order]
        n_long = min(least - 1, int(least / (PROBE_WEIGHT * np.log2(length[-1] + 1) + 1)))
        n_short = len(lists) - n_long
        probed = lists[n_short:] * self.members
        short = [
            (self.keys[b : b + m] - k * self.members).tolist()
            for k, b, m in zip(lists[:n_short].tolist(), begin[:n_short].tolist(), length[:n_short].tolist())
        ]
        found = []
        for y, seen in _merge_skip(short, least - n_long):
            if others is not None and not others[y]:
                continue
            want = needed(n, int(self.sizes[y]), self.percent)
            if seen + n_long >= want:
                at = np.searchsorted(self.keys, probed + y)
                shared = seen + int((self.keys[np.minimum(at, len(self.keys) - 1)] == probed + y).sum())
                if linked(shared, n, int(self.sizes[y]), self.percent):
                    found.append(y)
        return found


def _merge_skip(lists: list[list[int]], threshold: int) -> Iterator[tuple[int, int]]:
    """Members that occur in at least ``threshold`` of the sorted lists, with their counts."""
    heap = [(members[0], i, 0) for i, members in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= threshold:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= threshold:
            yield top, len(popped)
            for _, i, at in popped:
                if at + 1 < len(lists[i]):
                    heapq.heappush(heap, (lists[i][at + 1], i, at + 1))
            continue
        # Too few: the next member that can be in enough lists is the one now at the top, once
        # threshold - 1 lists have been taken off.
        while heap and len(popped) < threshold - 1:
            popped.append(heapq.heappop(heap))
        if not heap:
            return
        goal = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], goal, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))


def _search(names: list[int], sets: list[np.ndarray], sides: np.ndarray, across: bool, percent: int) -> dict[str, list]:
    """Of each member: how many linked partners, and the first member of its group here."""
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = [0] * len(sets)
    index = BlockSearch(sets, percent)
    for x in range(len(sets)):
        for y in index.partners(x, sides != sides[x] if across else None):
            links[x] += 1
            links[y] += 1
            a, b = top(x), top(y)
            root[max(a, b)] = min(a, b)
    return {"class": names, "links": links, "root": [names[top(i)] for i in range(len(sets))]}


def _search_tasks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Searches block after block; rows come sorted by task, set size and class."""
    task, names, sets, sides = None, [], [], []

    def done() -> Iterator[pa.RecordBatch]:
        if len(names) > 1:
            side = np.array(sides)
            found = _search(names, sets, side, task.endswith("x"), percent)
            if any(found["links"]):
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in found.items()})

    for batch in batches:
        for t, name, side, raw in zip(*(batch.column(c).to_pylist() for c in ("task", "class", "side", "set"))):
            if t != task:
                yield from done()
                task, names, sets, sides = t, [], [], []
            if not names or names[-1] != name:
                names.append(name)
                sets.append(np.frombuffer(raw, dtype=np.uint64))
                sides.append(side)
    yield from done()


def _wanted_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The set of each class, once per partition however often its row is repeated."""
    seen = set()
    for batch in batches:
        wanted = batch.column("class").to_pylist()
        keep, raw = [], []
        for i, numbers in enumerate(sets_of(batch.column("__text"), size)):
            if wanted[i] not in seen:
                seen.add(wanted[i])
                keep.append(i)
                raw.append(numbers.tobytes())
        kept = batch.take(pa.array(keep, pa.int64()))
        names = ["class", "n_shingles", "tasks"]
        yield pa.RecordBatch.from_arrays([*[kept.column(n) for n in names], pa.array(raw, pa.binary())], names=[*names, "set"])


SIZED = "signature bigint, size bigint, class bigint, at bigint, leader bigint"
TASKS = "array<struct<task: string, side: int>>"


def _tasks(blocks: DataFrame, percent: int) -> DataFrame:
    """``blocks`` with ``tasks``: a block is one task, or if it is too large, all pairs of its cells of near sizes.

    Cells are bands of set sizes, so wide that partners lie in the same or the next one, and are dealt
    further by the class. Every pair of classes that can be linked meets in exactly one task; a task
    whose name ends with x compares its two sides only with each other.
    """
    columns = blocks.columns
    sums = blocks.groupBy(F.col("block").alias("b")).agg(F.sum("n_shingles").alias("all"), F.count(F.lit(1)).alias("many"))
    large = (F.col("all") > BLOCK_SHINGLES) | (F.col("many") > BLOCK_CLASSES)
    known = blocks.join(sums, F.col("block") == F.col("b")).drop("b")
    one = F.array(F.struct(F.concat(F.lit("b"), F.col("block")).alias("task"), F.lit(0).alias("side")))
    small = known.where(~large).select(*columns, one.alias("tasks"))
    band = F.floor(F.log(F.col("n_shingles")) / float(np.log(100 / percent) * 1.0001)).cast("int")
    rows = known.where(large).withColumn("band", band)
    size = F.greatest(F.sum("n_shingles") / (BLOCK_SHINGLES / 2), F.count(F.lit(1)) / (BLOCK_CLASSES / 2))
    cells = rows.groupBy("block", "band").agg(F.ceil(size).cast("int").alias("cells"))
    next_cells = cells.select("block", (F.col("band") - 1).alias("band"), F.col("cells").alias("above"))
    last_cells = cells.select("block", (F.col("band") + 1).alias("band"), F.col("cells").alias("below"))
    for more, how in ((cells, "inner"), (next_cells, "left"), (last_cells, "left")):
        rows = rows.join(more, ["block", "band"], how)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("cells")).cast("int"))
    here, mine = F.col("band"), F.col("mine")

    def across(low_band: Column, low: Column, high_band: Column, high: Column, side: Column) -> Column:
        name = F.concat_ws("-", F.lit("c"), F.col("block"), low_band, low, high_band, high, F.lit("x"))
        return F.struct(name.alias("task"), side.cast("int").alias("side"))

    def upto(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    alone = F.array(F.struct(F.concat_ws("-", F.lit("c"), F.col("block"), here, mine).alias("task"), F.lit(0).alias("side")))
    same = F.transform(
        F.filter(upto(F.col("cells")), lambda j: j != mine),
        lambda j: across(here, F.least(mine, j), here, F.greatest(mine, j), (j < mine)),
    )
    above = F.transform(upto(F.coalesce("above", F.lit(0))), lambda j: across(here, mine, here + 1, j, F.lit(0)))
    below = F.transform(upto(F.coalesce("below", F.lit(0))), lambda j: across(here - 1, j, here, mine, F.lit(1)))
    split = rows.select(*columns, F.concat(alone, same, above, below).alias("tasks"))
    return small.unionByName(split)


def _all_vertices(components: DataFrame, name: str) -> DataFrame:
    """``class`` and its component, the lowest vertex of each included."""
    lowest = components.select(F.col("component").alias("id")).distinct().withColumn("component", F.col("id"))
    return components.unionByName(lowest).select(F.col("id").alias("class"), F.col("component").alias(name))


def _one_of_each(signed: DataFrame, workspace: Workspace) -> DataFrame:
    """One row of each class. Only rows that a bitmap of the classes with several lets through are shuffled."""
    several = signed.groupBy("class").count().where("count > 1").select("class")
    several, seen = workspace.save(several, "several")
    bits = key_bits(seen["rows"])
    asked = with_possible_match(signed, "class", key_filter(several, "class", bits), "__may", bits)
    alone, others = asked.where("NOT __may"), asked.where("__may").dropDuplicates(["class"])
    return alone.unionByName(others).drop("__may")


def _first() -> Column:
    """The row of a group that stands for it: the smallest doc_id, rows without one last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "place"))


def _grouped(
    docs: DataFrame, workspace: Workspace, size: int, percent: int, place: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """All rows ``doc_id, key, place, n_shingles, class``, and ``class, first, links`` of every class.

    ``first`` is the row that stands for the class's component. ``place`` is a stored number of each row,
    for who looks rows up by it; other scans of the table may number them in another way.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = F.monotonically_increasing_id() if place is None else place
    narrow = docs.select("doc_id", F.xxhash64("text").alias("key"), place.alias("place"), F.col("text").alias("__text"))
    schema = f"doc_id {kind}, key bigint, place bigint, n_shingles bigint, class bigint, signatures binary, bits binary"
    common = _common(narrow, size, workspace) if percent < BUCKET_PERCENT else None
    rows, _ = workspace.save(narrow.mapInArrow(in_task(_classify, size, percent, common), schema), "classes")
    full = rows.where("class IS NOT NULL")
    signed = full.where("octet_length(signatures) > 0")
    if common is None:
        one = signed.select("class", "signatures").dropDuplicates(["class"])
        postings = one.mapInArrow(in_task(_postings), "signature bigint, class bigint, leader bigint")
        placed = postings.repartition("signature").sortWithinPartitions("signature", "class")
        edges = placed.mapInArrow(in_task(_stars), "u bigint, v bigint")
    else:
        one = _one_of_each(signed, workspace)
        postings = one.select("class", "n_shingles", "signatures").mapInArrow(in_task(_sized_postings, percent), SIZED)
        placed = postings.repartition("signature").sortWithinPartitions("signature", "size", "class")
        edges = placed.mapInArrow(in_task(_sized_stars, percent), "u bigint, v bigint, tied bigint").distinct()
        edges = _candidates(workspace.save(edges, "pairs")[0], one.select("class", "n_shingles", "bits"), percent)
    edges, _ = workspace.save(edges.distinct(), "edges")
    blocks = _all_vertices(connected_components(edges, workspace, name="blocks"), "block")
    firsts = full.groupBy("class").agg(_first().alias("own"), F.max("n_shingles").alias("n_shingles"))
    firsts, _ = workspace.save(firsts, "firsts")
    members, seen = workspace.save(_tasks(blocks.join(firsts, "class"), percent), "members")
    # Members grow with the table, so they are not sent to every task, whatever their number.
    wanted = members.select("class", "n_shingles", "tasks", F.col("own.doc_id").alias("__id"), F.col("own.key").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))
    # Only texts that a bitmap of the members' keys lets through are shuffled to them.
    bits = key_bits(seen["rows"])
    near = with_possible_match(narrow, "key", key_filter(wanted, "__key", bits), "__may", bits).where("__may").drop("__may")
    texts = near.join(wanted.hint("shuffle_hash"), same).select("class", "n_shingles", "tasks", "__text")
    sets = texts.mapInArrow(in_task(_wanted_sets, size), f"class bigint, n_shingles bigint, tasks {TASKS}, set binary")
    work = sets.select("class", "n_shingles", F.explode("tasks").alias("t"), "set").select("t.task", "n_shingles", "class", "t.side", "set")
    work = work.repartition("task").sortWithinPartitions("task", "n_shingles", "class")
    found = work.mapInArrow(in_task(_search_tasks, percent), "class bigint, links bigint, root bigint")
    found, _ = workspace.save(found, "links")
    ties = found.select(F.col("class").alias("u"), F.col("root").alias("v")).where("u <> v").distinct()
    ties, _ = workspace.save(ties, "ties")
    groups = _all_vertices(connected_components(ties, workspace, name="groups"), "group")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = firsts.join(groups, "class", "left").join(counts, "class", "left")
    named = named.select("class", "own", F.coalesce("group", "class").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
    smallest = named.groupBy("group").agg(F.min("own").alias("first"))
    classes, _ = workspace.save(named.join(smallest, "group").select("class", "first", "links"), "named")
    return rows.drop("signatures", "bits"), classes


def jaccard_components(
    docs: DataFrame, workspace: Workspace, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, links`` of every row of ``docs``.

    Two rows are linked if 100 times the shingles they share is at least ``percent`` times those that
    either has; shingles are runs of ``size`` lower-cased words, or all words of a shorter text. ``component_id``
    is the smallest doc_id that links lead to, the row's own included; ``links`` is the number of
    different other sets that the row's set is linked to.

    Exact: no candidate is left out (see the module's text), and shared shingles are counted on the
    whole sets. Shingles and sets are told apart by 64-bit numbers. A null text and one without words
    have an empty set, linked with nothing; equal rows are linked. Null doc_ids don't count as
    smallest. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    rows, classes = _grouped(docs, workspace, size, percent)
    known = rows.where("class IS NOT NULL").join(classes, "class")
    alone = rows.where("class IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("links")
    )
    return known.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), "links").unionByName(alone)


def keep_representatives(
    docs: DataFrame, workspace: Workspace, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest doc_id.

    If that row is repeated the first one stays, by its place in the table. Rows with an empty set are
    in no group and stay. The table is written with its rows numbered, since a second scan of it may be
    split in another way. Columns may have any names but those led by two underscores; an empty table gives
    no rows.
    """
    docs, _ = workspace.save(docs.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    rows, classes = _grouped(docs, workspace, size, percent, F.col("__at"))
    first = classes.select("class", F.col("first.place").alias("__first"))
    gone = rows.where("class IS NOT NULL").join(first, "class").where(F.col("place") != F.col("__first"))
    gone, seen = workspace.save(gone.select(F.col("place").alias("__at")), "gone")
    workspace.drop("classes")  # its signatures are large, and only ``gone`` is still read
    bits = key_bits(seen["rows"])
    # What goes may grow with the table: a bitmap of it tells which texts must be shuffled to find out.
    asked = with_possible_match(docs, "__at", key_filter(gone, "__at", bits), "__may", bits)
    sure, unsure = asked.where("NOT __may"), asked.where("__may")
    return sure.unionByName(unsure.join(gone.hint("shuffle_hash"), "__at", "left_anti")).drop("__at", "__may")
