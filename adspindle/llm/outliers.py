"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Native: only DataFrame functions touch the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspindle.llm.text import WORD
from adspindle.operators.joins import lookup_join
from adspindle.sources.workspace import Workspace

# The contract's base rule.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"

# The statistic vector: its columns, and the least standard deviation that each is given. Most clean
# documents have no symbol and no repeated line at all; the floors say which differences are large.
FEATURES = {"x_words": 0.5, "x_length": 0.25, "x_symbols": 0.15, "x_lines": 0.3, "x_repeats": 0.3}
DIM = len(FEATURES)
CHI2_MEDIAN = 4.351  # of the chi-square distribution with 5 degrees of freedom
CUTOFF = 60.0  # far beyond that distribution's 0.9999999 quantile: clean tails stay
SUBSET = 0.75
# Concentration ends when no determinant falls any more; it never took more than a few steps.
MOST_STEPS = 20
# A group's estimate counts as much as its language's when it has so many documents, and a language's as all.
EVEN = 50.0
GRID = 1024.0  # statistics are rounded to 1/1024, so that their sums don't depend on the order of rows
BINS = 16  # distance bins per doubling


def bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once per row although ``use`` names it often."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur more than once in the array."""

    def covered(places: Column) -> Column:
        # Each place covers three words, or only up to the next one.
        last = F.size(places) - 1
        steps = F.transform(
            places, lambda p, i: F.when(i == last, 3).otherwise(F.least(F.lit(3), places[F.least(i + 1, last)] - p))
        )
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def places_of_repeats(windows: Column) -> Column:
        def repeated(pairs: Column) -> Column:
            last = F.size(pairs) - 1

            def same(a: Column, i: Column) -> Column:
                return ((i > 0) & (pairs[F.greatest(i - 1, F.lit(0))]["h"] == a["h"])) | (
                    (i < last) & (pairs[F.least(i + 1, last)]["h"] == a["h"])
                )

            return bound(F.sort_array(F.transform(F.filter(pairs, same), lambda a: a["at"])), covered)

        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return bound(F.sort_array(placed), repeated)

    def any_repeat(windows: Column) -> Column:
        distinct = F.size(F.array_distinct(windows))
        return F.when(distinct == F.size(windows), F.lit(0)).otherwise(places_of_repeats(windows))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        hashed = F.transform(starts, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        return F.when(F.size(w) >= 3, bound(hashed, any_repeat)).otherwise(F.lit(0))

    return bound(words, windows)


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    split = docs.select(*keep, text.alias("__text"), words.alias("__words"), lines.alias("__lines"))
    counted = split.select(
        *keep,
        F.size("__words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        (F.char_length("__text") - F.char_length(F.translate("__text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("__lines").cast("bigint").alias("__n_lines"),
        _repeated_words(F.col("__words")).cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _features(stats: DataFrame) -> DataFrame:
    def per(n: str, of: str) -> Column:
        return F.coalesce(F.try_divide(F.col(n), F.col(of)), F.lit(0.0))

    made = {
        "x_words": F.log1p("n_words"),
        "x_length": F.log1p(per("word_chars", "n_words")) * 2,
        "x_symbols": F.sqrt(per("n_symbols", "n_words")),
        "x_lines": F.sqrt(per("n_dup_lines", "__n_lines")),
        "x_repeats": F.sqrt(per("n_repeat_words", "n_words")),
    }
    return stats.withColumns({n: F.round(x * GRID) / GRID for n, x in made.items()})


EVERY = "a"


def _at_levels(rows: DataFrame, starts: int = 0) -> DataFrame:
    """Each row once as one of its language and source, of its language, and of all, by ``__g``; and per start."""
    levels = F.array("__source_group", "__lang_group", F.lit(EVERY))
    if starts:
        each = F.array(*[F.lit(str(k)) for k in range(starts)])
        levels = F.flatten(F.transform(each, lambda k: F.transform(levels, lambda g: F.concat(k, g))))
    return rows.select("*", F.explode(levels).alias("__g"))


def _medians_and_spreads(rows: DataFrame) -> DataFrame:
    """One start: each coordinate's median and quartile range, from counted bins."""
    entries = F.array(*[F.struct(F.lit(i).alias("j"), F.floor(F.col(n) * 64).alias("bin")) for i, n in enumerate(FEATURES)])
    bins = rows.select("__g", F.explode(entries).alias("e")).groupBy("__g", "e.j", "e.bin").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("__g", "j").orderBy("bin")
    ranked = bins.withColumns({"upto": F.sum("n").over(along), "all": F.sum("n").over(Window.partitionBy("__g", "j"))})

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))) / 64.0

    quartiles = ranked.groupBy("__g", "j").agg(
        quantile(0.5).alias("mid"), ((quantile(0.75) - quantile(0.25)) / 1.349).alias("spread")
    )
    aggs = []
    for i in range(DIM):
        own = F.col("j") == i
        aggs.append(F.max(F.when(own, F.col("mid"))).alias(f"m{i}"))
        aggs += [(F.max(F.when(own, F.col("spread") ** 2)) if i == k else F.lit(0.0)).alias(f"c{i}{k}") for k in range(i + 1)]
    return _factored(quartiles.groupBy("__g").agg(*aggs), list(FEATURES))


def _factored(estimates: DataFrame, names: list[str]) -> DataFrame:
    """Adds the Cholesky factor ``l00, l10, ...`` of each group's covariance, floors on its diagonal."""
    for i in range(DIM):
        for k in range(i + 1):
            done = sum((F.col(f"l{i}{t}") * F.col(f"l{k}{t}") for t in range(k)), F.lit(0.0))
            if i == k:
                floor = FEATURES[names[i]] ** 2
                value = F.sqrt(F.greatest(F.col(f"c{i}{i}") + floor - done, F.lit(floor * 1e-3)))
            else:
                value = (F.col(f"c{i}{k}") - done) / F.col(f"l{k}{k}")
            estimates = estimates.withColumn(f"l{i}{k}", value)
    return estimates


def _distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance from the row's group, by forward substitution."""
    known = estimates.select("__g", *[f"m{i}" for i in range(DIM)], *[f"l{i}{k}" for i in range(DIM) for k in range(i + 1)])
    # Sent to the rows if its size allows, or else with the rows of large groups spread.
    joined = lookup_join(rows, known, "__g", "inner", null_keys=False)
    steps: list[Column] = []
    for i, name in enumerate(FEATURES):
        done = sum((F.col(f"l{i}{t}") * steps[t] for t in range(i)), F.lit(0.0))
        steps.append((F.col(name) - F.col(f"m{i}") - done) / F.col(f"l{i}{i}"))
    return joined.withColumn("d2", sum((s * s for s in steps), F.lit(0.0)))


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 1e-3) * BINS)


_PAIRS = [(i, k) for i in range(DIM) for k in range(i + 1)]
_ESTIMATE = [*[f"m{i}" for i in range(DIM)], *[f"c{i}{k}" for i, k in _PAIRS]]


def _sums() -> list[Column]:
    x = [F.col(n) for n in FEATURES]
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(DIM)],
        *[F.sum(x[i] * x[k]).alias(f"s{i}{k}") for i, k in _PAIRS],
    ]


def _moments(sums: DataFrame) -> DataFrame:
    """Each group's mean and covariance, factored, from its sums."""
    moments = sums.select(
        "__g",
        *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIM)],
        *[
            (F.col(f"s{i}{k}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{k}") / F.col("n")).alias(f"c{i}{k}")
            for i, k in _PAIRS
        ],
    )
    return _factored(moments, list(FEATURES))


def _with_determinant(estimates: DataFrame) -> DataFrame:
    """Adds ``det``, the logarithm of the covariance's determinant."""
    return estimates.withColumn("det", sum((2 * F.log(f"l{i}{i}") for i in range(DIM)), F.lit(0.0)))


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One C-step: mean and covariance of the three quarters of each group that lie nearest to its estimate.

    Counts and sums are taken per bin of distance, so the nearest rows are those of the first bins,
    and a step is one pass without sorting or collecting a group.
    """
    binned = _distances(rows, estimates).groupBy("__g", _bin(F.col("d2")).alias("bin")).agg(*_sums())
    along = Window.partitionBy("__g").orderBy("bin")
    ranked = binned.withColumns({"upto": F.sum("n").over(along), "all": F.sum("n").over(Window.partitionBy("__g"))})
    near = ranked.where(F.col("upto") - F.col("n") < F.col("all") * SUBSET)
    names = ["n", *[f"s{i}" for i in range(DIM)], *[f"s{i}{k}" for i, k in _PAIRS]]
    return _moments(near.groupBy("__g").agg(*[F.sum(n).alias(n) for n in names]))


def _least_determinant(sound: DataFrame, workspace: Workspace) -> DataFrame:
    """The estimate of each group at each level with the least determinant that concentration finds.

    It starts from medians and quartile ranges, and from the mean and covariance of the whole group. A step's
    estimate replaces the one before where its determinant is lower; when none is, the lower of both ends stays.
    """
    levels = _at_levels(sound)
    starts = (_medians_and_spreads(levels), _moments(levels.groupBy("__g").agg(*_sums())))
    named = [_with_determinant(s.withColumn("__g", F.concat(F.lit(str(k)), "__g"))) for k, s in enumerate(starts)]
    estimates, _ = workspace.save(named[0].select(*named[1].columns).unionByName(named[1]), "start")
    rows, columns = _at_levels(sound, len(starts)), named[1].columns
    for step in range(MOST_STEPS):
        moved = _with_determinant(_concentrated(rows, estimates)).select(
            F.col("__g").alias("__n"), F.struct(*[c for c in columns if c != "__g"]).alias("__now")
        )
        lower = F.col("__now.det") < F.col("det") - 1e-6
        joined = estimates.join(moved, F.col("__g") == F.col("__n"), "left").withColumn("__lower", F.coalesce(lower, F.lit(False)))
        taken = [F.when(F.col("__lower"), F.col(f"__now.{c}")).otherwise(F.col(c)).alias(c) for c in columns if c != "__g"]
        estimates, seen = workspace.save(joined.select("__g", *taken, "__lower"), f"step-{step}", fell=F.count_if("__lower"))
        estimates = estimates.drop("__lower")
        if not seen.get("fell"):
            break
    group = F.substr("__g", F.lit(2)).alias("__g")
    least = estimates.groupBy(group).agg(F.min(F.struct("det", *_ESTIMATE)).alias("e"))
    return least.select("__g", *[F.col(f"e.{c}").alias(c) for c in _ESTIMATE])


def _leaning(values: DataFrame, columns: list[str], groups: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """``values`` of languages and sources, each leaning on the wider group's by its number of documents, by ``__g``.

    ``groups`` (__source_group, __lang_group, __rows, __lang_rows) has one row per language and source.
    """
    values, _ = workspace.save(values, f"{name}-levels")

    def level(prefix: str) -> DataFrame:
        names = [F.col(c).alias(f"{prefix}{c}") for c in columns]
        return values.select(F.col("__g").alias(f"{prefix}g"), *names)

    wide = groups.join(level("__s"), F.col("__source_group") == F.col("__sg")).join(level("__l"), F.col("__lang_group") == F.col("__lg"))
    wide = wide.join(level("__a"), F.col("__every") == F.col("__ag"))

    def lean(own: Column, wider: Column, n: str) -> Column:
        return (own * F.col(n) + wider * EVEN) / (F.col(n) + EVEN)

    made = [lean(F.col(f"__s{c}"), lean(F.col(f"__l{c}"), F.col(f"__a{c}"), "__lang_rows"), "__rows").alias(c) for c in columns]
    return workspace.save(wide.select(F.col("__source_group").alias("__g"), *made), name)[0]


def robust_outliers(docs: DataFrame, workspace: Workspace, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the base statistics, ``base_failed``, ``distance`` and ``kept`` of every document.

    Statistic vectors (length, word length, symbols, repeated lines and words, in logs and square
    roots) are compared within a language and source. A group's centre and covariance are a minimum
    covariance determinant estimate over three quarters of its documents: concentration steps from two
    starts until no determinant falls any more, the lower one taken. They lean on those of the language, and these
    on those of all documents, the more the fewer documents there are (evenly at ``EVEN``), so a growing group
    passes from one to the other by degrees. Rows that fail the base rule take no part. Distances are scaled so
    that their median, leaning likewise, is that of the chi-square distribution, and a document beyond ``CUTOFF``
    is rejected.

    A null text is empty, and too short to be kept. Null languages and sources are groups like others. An
    empty table gives no rows. Columns other than ``text``, ``lang``, ``source`` and ``keep`` are not read.
    """
    columns = {f"__keep{i}": F.col(c) for i, c in enumerate(keep)}
    own = docs.select("text", "lang", "source", *[c.alias(n) for n, c in columns.items()])
    stats, _ = workspace.save(_features(statistics(own, "lang", "source", *columns)), "statistics")
    by_source = F.concat(F.lit("s"), F.to_json(F.struct("lang", "source")))
    by_lang = F.concat(F.lit("l"), F.to_json(F.struct("lang")))
    rows = stats.withColumns({"__source_group": by_source, "__lang_group": by_lang})
    sound = rows.where(~F.col("base_failed"))
    groups = sound.groupBy("__source_group", "__lang_group").agg(F.count(F.lit(1)).alias("__rows"))
    # As many rows as there are languages and sources.
    groups = groups.withColumn("__lang_rows", F.sum("__rows").over(Window.partitionBy("__lang_group")))
    groups, _ = workspace.save(groups.withColumn("__every", F.lit(EVERY)), "groups")
    estimates = _leaning(_least_determinant(sound, workspace), _ESTIMATE, groups, workspace, "estimates")
    judged = _distances(sound.withColumn("__g", F.col("__source_group")), _factored(estimates, list(FEATURES)))
    judged = judged.drop("__g")
    bins = _at_levels(judged).groupBy("__g", _bin(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("__g").orderBy("bin")
    ranked = bins.withColumns({"upto": F.sum("n").over(along), "all": F.sum("n").over(Window.partitionBy("__g"))})
    middle = F.min(F.when(F.col("upto") >= F.col("all") * 0.5, F.col("bin")))
    scales = _leaning(ranked.groupBy("__g").agg(middle.alias("__middle")), ["__middle"], groups, workspace, "scales")
    scale = F.pow(F.lit(2.0), (F.col("__middle") + 0.5) / BINS) / CHI2_MEDIAN
    scales = scales.withColumnRenamed("__g", "__source_group")
    judged = lookup_join(judged, scales, "__source_group", "inner", null_keys=False).withColumn("distance", F.col("d2") / scale)
    # The base rule has rejected these, and nothing was estimated from them.
    failed = rows.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    both = judged.select(*failed.columns).unionByName(failed)
    return both.select(
        *[F.col(n).alias(c) for n, c in zip(columns, keep)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & (F.col("distance") <= CUTOFF)).alias("kept"),
    )
