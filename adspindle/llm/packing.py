"""Packing documents into sequences that all mix their sources in the target proportions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspindle.llm.text import in_task
from adspindle.llm.tokens import encoder, parts
from adspindle.sources.workspace import Workspace

SEQUENCE = 2048
END = 1
# More sources than this share queues by a hash of their name; weights are refused then.
QUEUES = 1024
# A source that earns less than this part of a window saves its credit up until it can send so much at once.
QUANTA = 32
PIECE_ROWS = 20_000
# Sums over all sources are taken for so many rounds at a time that this many numbers are held.
CELLS = 1 << 18


@dataclass(frozen=True)
class Phase:
    """Rounds of deficit round-robin in which the same sources have tokens left.

    In each round a source's credit grows by ``window * weight / sum(weights)`` tokens. It sends what its
    credit covers, in whole tokens, or if it earns less than a quantum a round in whole quanta, at the end
    all that is left; the rest of the credit is carried to the next round and, in whole tokens, to the next
    phase. So what it has sent after ``r`` rounds follows from ``r``: no round has to know the one before it,
    and every partition finds the rounds of its own documents.
    """

    stream: int  # tokens of all sources sent before
    sent: np.ndarray  # tokens of each source sent before
    left: np.ndarray  # and those it still has
    rounds: int
    step: np.ndarray  # window * weight
    unit: int  # sum of weights
    carry: np.ndarray  # credit from before
    quantum: np.ndarray

    def after(self, rounds: np.ndarray) -> np.ndarray:
        """[rounds, sources]: tokens sent from each source, within the phase, after so many rounds."""
        credit = self.carry[None, :] + rounds[:, None] * self.step[None, :] // self.unit
        sent = np.where(credit >= self.left[None, :], self.left[None, :], credit - credit % self.quantum[None, :])
        return np.where(rounds[:, None] > 0, sent, 0)  # also what was carried is sent in a round

    def until(self) -> np.ndarray:
        return self.sent + self.after(np.array([self.rounds]))[0]

    def round_of(self, q: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The round, from 0, that sends a token of source ``q``, counted from the phase's first."""
        size = self.quantum[q]
        goal = np.minimum(self.left[q], (token // size + 1) * size) - self.carry[q]
        return np.maximum((goal * self.unit - 1) // self.step[q], 0)


def schedule(totals: Sequence[int], weights: Sequence[float], window: int, quantum: int | None = None) -> list[Phase]:
    """The phases until all queues are empty; a phase ends with the round in which one runs dry."""
    totals = [int(t) for t in totals]
    quantum = quantum or max(1, window // QUANTA)
    # Weights as whole numbers, so coarse that no product of them leaves 62 bits.
    room = 1 << max(8, min(30, 60 - max(sum(totals) + quantum, window).bit_length()))
    sent, carry, stream, phases = [0] * len(totals), [0] * len(totals), 0, []
    while any(s < t for s, t in zip(sent, totals)):
        left = [t - s for s, t in zip(sent, totals)]
        whole = sum(w for w, n in zip(weights, left) if n) or 1
        # A source of weight 0 still moves on, by the least share that can be written.
        units = [max(1, round(w / whole * room)) if n else 0 for w, n in zip(weights, left)]
        unit = sum(units)
        # Credit for all that is left would be spent before the first round.
        carry = [min(c, n - 1) if n else 0 for c, n in zip(carry, left)]
        rounds = min(-(-(n - c) * unit // (window * u)) for n, c, u in zip(left, carry, units) if n)
        sizes = [quantum if window * u < quantum * unit else 1 for u in units]
        columns = [np.array(x, dtype=np.int64) for x in (sent, left, [window * u for u in units], carry, sizes)]
        phases.append(Phase(stream, columns[0], columns[1], rounds, columns[2], unit, columns[3], columns[4]))
        until = phases[-1].until().tolist()
        credit = [c + rounds * window * u // unit for c, u in zip(carry, units)]
        carry = [max(0, c - (b - a)) for c, a, b in zip(credit, sent, until)]
        stream += sum(until) - sum(sent)
        sent = until
    return phases


def _rounds_of(phase: Phase, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of documents with the tokens ``[low, high)`` of a phase's sources: every round that sends some, with the document.

    There are no more of them than a document has quanta, however many rounds lie between.
    """
    size = phase.quantum[q]
    first, last = phase.round_of(q, low), phase.round_of(q, high - 1)
    # A source without quanta sends in each round; of the others each quantum has its round.
    begin = np.where(size == 1, first, low // size)
    n = np.where(size == 1, last, (high - 1) // size) - begin + 1
    doc = np.repeat(np.arange(len(q)), n)
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    rounds = np.where(size[doc] == 1, at, phase.round_of(q[doc], at * size[doc]))
    # The last, smaller quantum may go with the one before it.
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (rounds[1:] != rounds[:-1])
    return doc[new], rounds[new]


def cut(
    phases: Sequence[Phase], queue: np.ndarray, begin: np.ndarray, length: np.ndarray, sequence: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents that take ``[begin, begin + length)`` of their queues: document, start, length, stream place."""
    found = []
    for phase in phases:
        low = np.maximum(begin, phase.sent[queue])
        high = np.minimum(begin + length, phase.until()[queue])
        own = np.flatnonzero(low < high)
        if not len(own):
            continue
        q, low, high = queue[own], low[own], high[own]
        base = phase.sent[q]
        doc, rounds = _rounds_of(phase, q, low - base, high - base)
        step = max(1, CELLS // len(phase.sent))
        for i in range(0, len(doc), step):
            d, r = doc[i : i + step], rounds[i : i + step]
            before, after = phase.after(r), phase.after(r + 1)
            row, mine = np.arange(len(d)), q[d]
            # Within a round the sources come in order.
            place = phase.stream + before.sum(axis=1)
            place += np.where(np.arange(before.shape[1])[None, :] < mine[:, None], after - before, 0).sum(axis=1)
            start = np.maximum(low[d], base[d] + before[row, mine])
            end = np.minimum(high[d], base[d] + after[row, mine])
            place += start - base[d] - before[row, mine]
            kept = start < end
            found.append((own[d[kept]], start[kept], (end - start)[kept], place[kept]))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    doc, start, size, place = (np.concatenate(c) for c in zip(*found))
    n = (place + size - 1) // sequence - place // sequence + 1
    again = np.repeat(np.arange(len(doc)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    edge = (place[again] // sequence + step) * sequence
    left = np.maximum(place[again], edge)
    right = np.minimum(place[again] + size[again], edge + sequence)
    start = start[again] + left - place[again] - begin[doc[again]]
    order = np.lexsort((start, doc[again]))
    return doc[again][order], start[order], (right - left)[order], left[order]


def _encode(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    before: dict[int, int] = {}
    for batch in batches:
        done = 0
        for texts in parts(batch.column("__text")):
            ids, first = encoder(path).encode(texts)
            n = len(texts)
            sizes = np.diff(first) + 1
            # The end id follows each document's ids.
            whole = np.insert(ids, first[1:], end).astype("<u4")
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            narrow = whole.astype("<u2") if not len(whole) or whole.max() < 1 << 16 else whole
            width = narrow.dtype.itemsize
            queues = batch.column("queue").slice(done, n).to_numpy(zero_copy_only=False)
            begins = np.zeros(n, dtype=np.int64)
            for q in np.unique(queues):
                own = np.flatnonzero(queues == q)
                upto = before.get(q, 0) + np.cumsum(sizes[own])
                begins[own] = upto - sizes[own]
                before[q] = int(upto[-1])
            data = pa.Array.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64) * width), pa.py_buffer(narrow)]
            )
            made = {
                "key": batch.column("key").slice(done, n),
                "part": batch.column("part").slice(done, n),
                "queue": batch.column("queue").slice(done, n),
                "tokens": pa.array(sizes, pa.int64()),
                "begin": pa.array(begins, pa.int64()),  # within the partition, so far
                "width": pa.array(np.full(n, width), pa.int32()),
                "ids": data.cast(pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(made)
            done += n


def _pieces(batches: Iterator[pa.RecordBatch], phases: Sequence[Phase], sequence: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, PIECE_ROWS // 20):
            batch = whole.slice(at, PIECE_ROWS // 20)
            queue, begin, tokens, width = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("queue", "begin", "tokens", "width")
            )
            doc, start, length, place = cut(phases, queue, begin, tokens, sequence)
            raw = batch.column("ids").to_pylist()
            for i in range(0, len(doc), PIECE_ROWS):
                d, s, n, p = (c[i : i + PIECE_ROWS] for c in (doc, start, length, place))
                ids = [
                    (piece if w == 4 else np.frombuffer(piece, "<u2").astype("<u4").tobytes())
                    for w, piece in (
                        (width[k], raw[k][a * width[k] : (a + m) * width[k]]) for k, a, m in zip(d, s, n)
                    )
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch.column("key").take(pa.array(d)),
                        "start": pa.array(s),
                        "length": pa.array(n),
                        "ids": pa.array(ids, pa.binary()),
                        "doc_tokens": pa.array(tokens[d]),
                        "sequence_id": pa.array(p // sequence),
                        "offset": pa.array(p % sequence),
                    }
                )


def _queued(docs: DataFrame, queues: int) -> tuple[DataFrame, list | None]:
    """Each row with its ``__queue``, and the sources in the order of their queues (None: they are hashed)."""
    names = [r[0] for r in docs.select("source").distinct().limit(queues + 1).collect()]
    if len(names) > queues:
        return docs.withColumn("__queue", F.pmod(F.xxhash64("source"), F.lit(queues)).cast("int")), None
    names.sort(key=lambda s: (s is None, (s or "").encode()))
    # At most ``queues`` rows.
    table = docs.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "__source string, __queue int")
    return docs.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("__source"))), names


def pack_by_mixture(
    docs: DataFrame,
    path: str,
    workspace: Workspace,
    key: str = "doc_id",
    sequence: int = SEQUENCE,
    end: int = END,
    weights: Mapping[str | None, float] | None = None,
    queues: int = QUEUES,
) -> DataFrame:
    """Pieces ``key, start, length, ids, doc_tokens, sequence_id, offset`` that fill sequences without gaps.

    Every document is encoded and ended by the id ``end``; its ids wait in the queue of its source.
    Deficit round-robin takes from each queue, window by window, as many tokens as the target says:
    ``weights`` per source, by default each source's share of all tokens, so all queues run dry
    together. Credit that is not spent is carried to the next window: of sources that earn a 32nd
    of a window the part of a token, of rarer ones up to such a quantum, so that they send runs of tokens every few
    windows. Since what has been sent by a window follows from its number, it is carried across partitions too:
    nothing is packed in one place. The stream of all windows is cut every ``sequence`` tokens; only the last
    sequence can be short. A queue that is empty leaves its part to the others.

    Places in a queue come from per-partition totals over the written table of ids. ``ids`` are
    little-endian unsigned 32-bit numbers. A null text is empty and has the end id only; a null source
    is a source like others; more than ``queues`` sources share queues by hash, and weights are refused. Long documents go on over as many sequences as they need. Equal rows are packed each. An
    empty table gives no rows. Only ``key``, ``text`` and ``source`` are read.
    """
    kind = docs.schema[key].dataType.simpleString()
    queued, names = _queued(docs.select(F.col(key).alias("__key"), "source", F.col("text").alias("__text")), queues)
    if weights and names is None:
        raise ValueError(f"weights need a queue for each source, and there are more than {queues}")
    narrow = queued.select(F.col("__key").alias("key"), F.spark_partition_id().alias("part"), F.col("__queue").alias("queue"), "__text")
    schema = f"key {kind}, part int, queue int, tokens bigint, begin bigint, width int, ids binary"
    encoded, _ = workspace.save(narrow.mapInArrow(in_task(_encode, path, end), schema), "ids")
    sums = encoded.groupBy("part", "queue").agg(F.sum("tokens").alias("n"))
    sums, _ = workspace.save(sums, "sums")
    totals = [0] * (queues if names is None else max(len(names), 1))
    for row in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        totals[row["queue"]] = row["n"]
    shares = [float(weights.get(n, 0.0)) for n in names] if weights else totals
    phases = schedule(totals, shares, sequence)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__base"))
    placed = encoded.join(base, ["part", "queue"]).withColumn("begin", F.col("begin") + F.col("__base"))
    placed = placed.select("key", "queue", "tokens", "begin", "width", "ids")
    schema = f"key {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    pieces = placed.mapInArrow(in_task(_pieces, phases, sequence), schema)
    return pieces.withColumnRenamed("key", key)
