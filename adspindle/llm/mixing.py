"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.llm.prefix import numbered, totals_before
from adspindle.llm.text import WORD
from adspindle.sources.workspace import Workspace

# The contract's fixed values.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
# How far a document's expected copies may lean on its length, either way, in millionths.
LEAN, WHOLE = 250_000, 1_000_000


def fill_targets(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``cap`` times its size; the excess goes to the others by weight."""
    targets = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight >= cap * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(cap * sizes[i])
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return targets


def _uniform(*key: Column) -> Column:
    """A number strictly between 0 and 1 that only the key decides."""
    return (F.pmod(F.xxhash64(F.lit("mix"), *key), F.lit(2**52)) + 0.5) / float(2**52)


def mix_sources(
    docs: DataFrame,
    workspace: Workspace,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """Every row of ``docs`` with ``__copies``, how often the mix takes it.

    A source's target is its part by weight of ``share`` times all words, at most ``max_copies``
    times its own words. A document's expected copies are its source's ratio of target to words, a
    quarter more or less for long and short documents, so inclusion odds differ within a source too.
    The whole part of that number is certain. The rest is a Pareto order sample: documents are ranked
    by the odds of a random number divided by the odds of that remainder, and taken in this order if
    they fit into the words still wanted; who doesn't is passed over. The sample is fixed in words, not
    in documents; one last document, the one whose size comes nearest to what is still missing, closes
    the gap. No document is cut.

    The ranking is a global sort by source and rank with running sums from partition totals, so no
    source has to fit a task; after each document too long for the words left the sums are taken anew
    over those that fit. Random numbers come from a hash of doc_id and text, ties go by the
    row's place in the table, and sums are of whole numbers, so reruns agree. A null source is a source of its own; documents without words are never taken.
    An empty table gives no rows. The columns of ``docs`` may have any name not led by two underscores.
    The table is written with its rows numbered, since a second scan of it may be split in another way.
    """
    read, _ = workspace.save(docs.withColumn("__number", F.monotonically_increasing_id()), "numbered")
    taken = sample_copies(read, workspace, weights, share, max_copies, F.col("__number"))
    taken = taken.select("__read", F.col("doc_id").alias("__doc"), "__copies")
    same = (F.col("__number") == F.col("__read")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
    return read.join(taken, same).drop("__read", "__doc", "__number")


def sample_copies(
    docs: DataFrame,
    workspace: Workspace,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    place: Column | None = None,
) -> DataFrame:
    """``doc_id, __read, __size, __source_size, __target, __copies`` of every row; ``__read`` is its place in the scan.

    ``place`` is a stored number of each row to take instead. ``mix_sources`` describes the sample.
    """
    place = F.monotonically_increasing_id() if place is None else place
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    narrow = docs.select(
        "doc_id",
        place.alias("__read"),
        size.alias("__size"),
        F.col("source").alias("__source"),
        _uniform(F.col("doc_id"), F.col("text")).alias("__u"),
    )
    narrow, _ = workspace.save(narrow, "sizes")
    targets = _targets(narrow, weights, share, max_copies)
    expected, _ = workspace.save(_expected(narrow, targets, max_copies, workspace), "expected")
    return _sample(expected, workspace)


def _targets(narrow: DataFrame, weights: Sequence[float], share: float, cap: int) -> DataFrame:
    """One row per source: ``__s, __source_size, __target, __mean``, the mean size of its documents.

    Targets depend on all sources in their order, so the driver sees one name and its sums per source. Sources
    are the collections that a corpus is made of; a million of them, some 300 MB on the driver, is what this is for.
    """
    rows = narrow.groupBy("__source").agg(F.sum("__size").alias("n"), F.avg("__size").alias("mean")).collect()
    rows.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    sizes = [r["n"] for r in rows]
    given = [float(weights[i % len(weights)]) for i in range(len(rows))]
    targets = fill_targets(sizes, given, share * sum(sizes), cap)
    made = [(r[0], r["n"], t, r["mean"]) for r, t in zip(rows, targets)]
    return narrow.sparkSession.createDataFrame(
        made, "__s string, __source_size bigint, __target double, __mean double"
    )


def _expected(narrow: DataFrame, targets: DataFrame, cap: int, workspace: Workspace) -> DataFrame:
    """Documents with their certain copies and the odds of one more.

    Tables of one row per source are local or written, so the join is planned by their size.
    """
    same = F.col("__source").eqNullSafe(F.col("__s"))
    known = narrow.join(targets, same, "left").drop("__s")
    away = F.try_divide(F.col("__size") - F.col("__mean"), F.col("__size") + F.col("__mean"))
    lean = (WHOLE + F.round(LEAN * F.coalesce(away, F.lit(0.0)))).cast("decimal(18,0)")
    known = known.withColumn("__lean", lean)
    scale = known.groupBy(F.col("__source").alias("__s")).agg(
        F.sum(F.col("__lean") * F.col("__size").cast("decimal(18,0)")).cast("double").alias("__scale")
    )
    scale, _ = workspace.save(scale, "scale")
    known = known.join(scale, same, "left").drop("__s")
    copies = F.coalesce(F.try_divide(F.col("__lean").cast("double") * F.col("__target"), F.col("__scale")), F.lit(0))
    copies = F.when(F.col("__size") > 0, F.least(copies, F.lit(float(cap)))).otherwise(0.0)
    known = known.withColumn("__expected", copies)
    return known.select(
        "doc_id", "__read", "__source", "__size", "__source_size", "__target", "__u",
        F.floor("__expected").alias("__whole"),
        (F.col("__expected") - F.floor("__expected")).alias("__part_copy"),
    )


def _sample(expected: DataFrame, workspace: Workspace) -> DataFrame:
    """The drawn copies of every document, certain ones included."""
    odds = lambda p: p / (1 - p)
    # Documents without a remainder rank last: they take no part in the sample.
    chance = F.col("__part_copy")
    rank = F.when(chance > 0, odds(F.col("__u")) / odds(chance)).otherwise(F.lit(float("inf")))
    placed = numbered(expected.withColumn("__rank", rank), ["__source", "__rank", "__read"], workspace, "ranked")
    placed = placed.withColumn("__in", F.lit(False))
    columns = [c for c in placed.columns if c != "__in"]
    taken = (F.col("__whole") + F.col("__in").cast("bigint")) * F.col("__size")
    same = F.col("__source").eqNullSafe(F.col("__s"))
    while True:
        gaps = placed.groupBy(F.col("__source").alias("__s")).agg((F.first("__target") - F.sum(taken)).alias("__gap"))
        gaps, _ = workspace.save(gaps, "gaps")
        known = placed.join(gaps, same).drop("__s")
        # Sizes are positive here, so each round takes the first that fits of every source that has one.
        fits = ~F.col("__in") & (F.col("__rank") < float("inf")) & (F.col("__size") <= F.col("__gap"))
        if known.where(fits).isEmpty():
            break
        known = known.withColumn("__fits", fits)
        size = F.when(F.col("__fits"), F.col("__size")).otherwise(F.lit(0))
        known = totals_before(known, ["__source"], {"__before": size}, workspace)
        now = F.col("__fits") & (F.col("__before") + F.col("__size") <= F.col("__gap"))
        placed, _ = workspace.save(known.select(*columns, (F.col("__in") | now).alias("__in")), "placed")
    open_ = placed.where("NOT __in AND __size > 0 AND __rank < double('inf')").join(gaps, same)
    miss = F.abs(F.col("__gap") - F.col("__size"))
    last = (
        open_.groupBy("__s")
        .agg(F.min(F.struct(miss.alias("miss"), "__rank", "__read", "__gap")).alias("best"))
        .where("best.miss < abs(best.__gap)")
        .select(F.col("best.__read").alias("__closing"))
    )
    last, _ = workspace.save(last, "last")
    one_more = F.col("__in") | F.col("__closing").isNotNull()
    return placed.join(last, F.col("__read") == F.col("__closing"), "left").select(
        "doc_id", "__read", "__size", "__source_size", "__target",
        (F.col("__whole") + one_more.cast("bigint")).alias("__copies"),
    )
