"""Vector codes: one small codebook per part of the vectors, refined in rounds with norm-of-sum bounds.

A row keeps, for every part, the entry it is assigned to, an upper bound of its distance to that entry and a
lower bound of its distance to all others, each with the round whose codebook it was taken from. All
codebooks since the first are kept. A bound of round s still holds in round t once it is moved by how far entries
have really come from s to t: the norm of the sum of their steps, which is at most the sum of the steps'
norms that running bounds add up. Only where the bounds then leave a doubt is the own distance taken again,
and only if that does not settle it, all distances. Components are whole numbers, so distances are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.llm.text import in_task
from adspindle.operators.joins import lookup_join
from adspindle.sources.workspace import Workspace

# The contract's fixed values.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# Whole components stay below this, so that a vector's squared distances fit in 63 bits.
LARGEST = 2**25
# Bounds are square roots in floating point; a doubt smaller than this is not settled by them.
SLACK = 1e-9

ROW = "vec_id {id}, label {label}, vector binary, state binary, sums array<bigint>"
STATE = np.dtype(
    [("entry", "u1"), ("upper_round", "u1"), ("lower_round", "u1"), ("upper", "<f8"), ("lower", "<f8")]
)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    infinite = float("inf")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return vector.isNotNull() & ~bad


def whole_components(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    """[rows, dim]: components times ``SCALE``, rounded down."""
    listed = batch.column(column)
    if not len(listed):
        return np.zeros((0, dim), dtype=np.int64)
    values = listed.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes != dim).any():
        raise ValueError(f"vectors have {dim} components and others")
    whole = np.floor(SCALE * values)
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} can't be coded")
    return whole.astype(np.int64).reshape(-1, dim)


def moved(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """[rounds, parts, entries]: how far each entry is now from where it was in each round, and how far the others are at most."""
    now = history[-1]
    own = np.stack([np.sqrt(((now - then) ** 2).sum(axis=2).astype(np.float64)) for then in history])
    others = np.zeros_like(own)
    for j in range(own.shape[2]):
        rest = np.delete(own, j, axis=2)
        others[:, :, j] = rest.max(axis=2) if rest.shape[2] else 0.0
    return own, others


class Assigner:
    """Assigns rows to the last codebook of a history, [parts, entries, width] each; counts what the bounds have saved."""

    def __init__(self, history: list[np.ndarray]):
        self.book, self.round = history[-1], len(history) - 1
        self.own_move, self.other_move = moved(history)
        self.parts, self.entries, self.width = self.book.shape
        self.settled = self.own = self.scanned = 0

    def first(self, x: np.ndarray) -> np.ndarray:
        """The state of rows never seen before: nothing is known, so all distances are taken."""
        state = np.zeros((len(x), self.parts), dtype=STATE)
        state["upper"], state["lower"] = np.inf, 0.0
        return self.update(x, state)

    def update(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        for p in range(self.parts):
            part, own = x[:, p * self.width : (p + 1) * self.width], state[:, p].copy()
            entry = own["entry"].astype(np.int64)
            upper = own["upper"] + self.own_move[own["upper_round"], p, entry]
            lower = own["lower"] - self.other_move[own["lower_round"], p, entry]
            doubt = np.flatnonzero(~(upper * (1 + SLACK) + SLACK < lower))
            self.settled += len(x) - len(doubt)
            if len(doubt):
                exact = ((part[doubt] - self.book[p, entry[doubt]]) ** 2).sum(axis=1)
                upper = np.sqrt(exact.astype(np.float64))
                own["upper"][doubt], own["upper_round"][doubt] = upper, self.round
                still = ~(upper * (1 + SLACK) + SLACK < lower[doubt])
                self.own += int((~still).sum())
                scan = doubt[still]
                self.scanned += len(scan)
                if len(scan):
                    self._scan(part, scan, own, p)
            state[:, p] = own
        return state

    def _scan(self, part: np.ndarray, rows: np.ndarray, own: np.ndarray, p: int) -> None:
        all_ = np.stack([((part[rows] - c) ** 2).sum(axis=1) for c in self.book[p]], axis=1)
        best = all_.argmin(axis=1)  # the lower index of equal ones
        at = np.arange(len(rows))
        own["entry"][rows] = best
        own["upper"][rows] = np.sqrt(all_[at, best].astype(np.float64))
        all_[at, best] = np.iinfo(np.int64).max
        own["lower"][rows] = np.sqrt(all_.min(axis=1).astype(np.float64)) if self.entries > 1 else np.inf
        own["upper_round"][rows] = own["lower_round"][rows] = self.round

    def sums(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        """[parts, entries, width + 1]: sums of the assigned parts, and their number."""
        found = np.zeros((self.parts, self.entries, self.width + 1), dtype=np.int64)
        for p in range(self.parts):
            entry = state[:, p]["entry"].astype(np.int64)
            found[p, :, -1] = np.bincount(entry, minlength=self.entries)
            for c in range(self.width):
                # Below 2**53 for any batch that fits in memory, so these sums are exact.
                column = np.bincount(entry, x[:, p * self.width + c].astype(np.float64), self.entries)
                found[p, :, c] = column.astype(np.int64)
        return found

    def errors(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x), dtype=np.int64)
        for p in range(self.parts):
            near = self.book[p, state[:, p]["entry"].astype(np.int64)]
            total += ((x[:, p * self.width : (p + 1) * self.width] - near) ** 2).sum(axis=1)
        return total


def next_book(book: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each entry replaced by the mean of its parts, rounded down; entries without any stay."""
    counts = sums[:, :, -1:]
    return np.where(counts > 0, sums[:, :, :-1] // np.maximum(counts, 1), book)


def _binary(rows: np.ndarray) -> pa.Array:
    size = rows.dtype.itemsize * rows[0].size if len(rows) else 1
    data = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(rows), [None, pa.py_buffer(data)]).cast(pa.binary())


def _rows(batch: pa.RecordBatch, column: str, dtype: np.dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), dtype=dtype).reshape(-1, width).copy()


def _assign(batches: Iterator[pa.RecordBatch], history: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows with their new state, and at the end one row with the sums of all of them."""
    assigner = Assigner(history)
    dim = assigner.parts * assigner.width
    total = np.zeros_like(assigner.sums(np.zeros((0, dim), np.int64), np.zeros((0, assigner.parts), STATE)))
    names, kinds = [], []
    for batch in batches:
        if assigner.round:
            x = _rows(batch, "vector", np.dtype("<i4"), dim).astype(np.int64)
            state = assigner.update(x, _rows(batch, "state", STATE, assigner.parts))
            vectors = batch.column("vector")
        else:
            x = whole_components(batch, "vector", dim)
            state = assigner.first(x)
            vectors = _binary(x.astype("<i4"))
        total += assigner.sums(x, state)
        names = ["vec_id", "label", "vector", "state", "sums"]
        kinds = [batch.column("vec_id").type, batch.column("label").type]
        none = pa.nulls(len(x), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vectors, _binary(state), none], names=names)
    if kinds:
        last = [pa.nulls(1, kinds[0]), pa.nulls(1, kinds[1]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([*last, pa.array([total.ravel()], pa.list_(pa.int64()))], names=names)


def _finish(batches: Iterator[pa.RecordBatch], history: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    assigner = Assigner(history)
    for batch in batches:
        x = _rows(batch, "vector", np.dtype("<i4"), assigner.parts * assigner.width).astype(np.int64)
        state = assigner.update(x, _rows(batch, "state", STATE, assigner.parts))
        codes = ["".join(f"{e:02x}" for e in row) for row in state["entry"].tolist()]
        columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(assigner.errors(x, state))]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])


def _first_book(kept: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """[parts, entries, width]: the vectors of the smallest ids, cut into parts."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not rows:
        return None
    dim = len(rows[0]["vector"])
    if dim == 0 or dim % parts or any(len(r["vector"]) != dim for r in rows):
        raise ValueError(f"vectors have to be of one size, a multiple of {parts}")
    batch = pa.RecordBatch.from_pydict({"vector": pa.array([list(r["vector"]) for r in rows], pa.list_(pa.float64()))})
    whole = whole_components(batch, "vector", dim)
    return whole.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2).copy()


def _summed(table: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sums of all tasks, added up by Spark: one number per part, entry and component."""
    numbers = table.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "value"))
    found = np.zeros(int(np.prod(shape)), dtype=np.int64)
    for row in numbers.groupBy("at").agg(F.sum("value").alias("value")).collect():
        found[row["at"]] = row["value"]
    return found.reshape(shape)


def codebook_text(book: np.ndarray) -> str:
    """All components by part, entry and place within the part, joined by commas."""
    return ",".join(map(str, book.ravel().tolist()))


def compress_vectors(
    vectors: DataFrame, workspace: Workspace, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every usable row of ``vectors``, and the codebooks of all rounds, the last one last.

    Rows whose ``embedding`` is null or has a null or non-finite component are left out. Components are
    multiplied by 4096 and rounded down; codebooks are whole numbers. They start from the usable rows with
    the smallest ids, equal ids by their vectors, null ids last; with fewer rows they have fewer entries.
    Each round is one written table, with what a row knows beside its vector; the tasks' sums lie in the same
    table and are added up by Spark, so the driver sees the codebooks alone. Equal rows get equal codes.
    An empty table gives no rows and no codebook. Vectors of different sizes, sizes that are no multiple of
    ``parts``, and components beyond 8192 raise an error. Only ``vec_id``, ``embedding`` and ``label`` are read.
    """
    if not 1 <= entries <= 256 or not 1 <= rounds <= 255:
        raise ValueError("codes have one byte per part, and rounds too")
    id_kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    kept = vectors.where(usable(F.col("embedding"))).select("vec_id", "label", F.col("embedding").alias("vector"))
    schema = ROW.format(id=id_kind, label=label_kind)
    book = _first_book(kept, parts, entries)
    if book is None:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), []
    history, table = [book], kept
    for number in range(rounds):
        step = in_task(_assign, list(history))
        table, _ = workspace.save(table.mapInArrow(step, schema), f"round-{number}")
        sums = _summed(table, (*book.shape[:2], book.shape[2] + 1))
        if number:
            workspace.drop(f"round-{number - 1}")
        table = table.where("sums IS NULL")
        book = next_book(book, sums)
        history.append(book)
    coded = table.mapInArrow(in_task(_finish, list(history)), f"vec_id {id_kind}, label {label_kind}, code string, error bigint")
    coded, _ = workspace.save(coded, "codes")
    workspace.drop(f"round-{rounds - 1}")
    return coded, history


def code_digests(vectors: DataFrame, workspace: Workspace) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: codes, with errors summed up per label.

    Labels are compared as they are, null ones together. Rows are those of ``compress_vectors``.
    """
    coded, history = compress_vectors(vectors, workspace)
    book = codebook_text(history[-1]) if history else ""
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("__label")
    coded = coded.select("vec_id", "code", "error", key)
    # Summed up where the rows are; a label with a third of them is one number per task.
    labels, _ = workspace.save(coded.groupBy("__label").agg(F.sum("error").alias("label_error")), "labels")
    joined = lookup_join(coded, labels, "__label", "inner", null_keys=False)
    digest = F.lit(hashlib.sha256(book.encode()).hexdigest()).alias("codebooks_sha256")
    return joined.select("vec_id", "code", "error", "label_error", digest)
