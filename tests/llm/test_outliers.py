import numpy as np
from pyspark.sql import functions as F

from adspindle.llm import outliers
from adspindle.llm.outliers import FEATURES, robust_outliers, statistics
from adspindle.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.01"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics(make_docs, odd_texts):
    texts = odd_texts + ["a b a b a b a", "a b c d a b c", "x x x x", "p q\np q\n \n \np q", "#a *b $ % & | < >", "a b c a b d a b c a b d"]
    rows = sorted(statistics(make_docs(texts), "doc_id").collect(), key=lambda r: r["doc_id"])
    for r, text in zip(rows, texts):
        want = brute.statistics(text)
        assert tuple(r[c] for c in BASE) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_query_rejects_junk_and_keeps_the_rest(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_quality_rules"](spark, SF)
    found = rows.collect()
    assert len(found) == len(docs)
    for r in found:
        assert tuple(r[c] for c in BASE) == brute.statistics(docs[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
    judged = rows.where("NOT base_failed").join(labels, "doc_id").collect()
    assert np.mean([r["kept"] for r in judged if r["quality"] == 1]) > 0.98
    assert np.mean([r["kept"] for r in judged if r["quality"] == 0]) < 0.1


def test_distances_are_mahalanobis(spark, ws):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], ["__g", *FEATURES])
    centre, covariance = x[:100].mean(axis=0), np.cov(x[:100].T, bias=True)
    names = {f"m{i}": float(centre[i]) for i in range(5)} | {f"c{i}{k}": float(covariance[i, k]) for i in range(5) for k in range(i + 1)}
    given = spark.createDataFrame([("g", *names.values())], ["__g", *names])
    found = outliers._distances(rows, outliers._factored(given, list(FEATURES)))
    inverse = np.linalg.inv(covariance + np.diag([f**2 for f in FEATURES.values()]))
    want = [float((r - centre) @ inverse @ (r - centre)) for r in x]
    got = [r["d2"] for r in found.orderBy(F.monotonically_increasing_id()).collect()]
    assert np.allclose(sorted(got), sorted(want))


def least_determinant(x):
    """Mean and covariance with the least determinant, by plain concentration from the same two starts."""
    floors = np.diag([f**2 for f in FEATURES.values()])
    place = np.floor(x * 64)

    def quantile(column, q):
        return np.sort(column)[int(np.ceil(len(column) * q - 1e-9)) - 1] / 64

    middle = np.array([quantile(c, 0.5) for c in place.T])
    spread = np.array([(quantile(c, 0.75) - quantile(c, 0.25)) / 1.349 for c in place.T])
    ends = []
    for mean, covariance in ((middle, np.diag(spread**2)), (x.mean(axis=0), np.cov(x.T, bias=True).reshape(5, 5))):
        det = np.linalg.slogdet(covariance + floors)[1]
        for _ in range(20):
            d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(covariance + floors), x - mean)
            bins = np.floor(np.log2(d2 + 1e-3) * 16)
            # Whole bins, the nearest first, until three quarters are reached.
            last = np.sort(bins)[int(np.ceil(len(x) * 0.75 - 1e-9)) - 1]
            near = x[bins <= last]
            now = near.mean(axis=0), np.cov(near.T, bias=True).reshape(5, 5)
            fell = np.linalg.slogdet(now[1] + floors)[1]
            if not fell < det - 1e-6:
                break
            mean, covariance, det = *now, fell
        ends.append((det, mean, covariance))
    return min(ends, key=lambda e: e[0])[1:]


def test_verdicts_are_those_of_plain_concentration(spark, ws):
    found = {r["doc_id"]: r for r in robust_outliers(spark.read.parquet(f"{SF}/documents.parquet"), ws).collect()}
    sound = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if not found[r["doc_id"]]["base_failed"]]

    def vector(text):
        n, chars, symbols, dup, repeated = brute.statistics(text)
        lines = sum(1 for line in text.split("\n") if brute.words(line))
        raw = [np.log1p(n), 2 * np.log1p(chars / n), np.sqrt(symbols / n), np.sqrt(dup / lines), np.sqrt(repeated / n)]
        return np.floor(np.array(raw) * 1024 + 0.5) / 1024

    x = np.array([vector(r["text"]) for r in sound])
    keys = {"s": [(r["lang"], r["source"]) for r in sound], "l": [r["lang"] for r in sound], "a": [0] * len(sound)}
    own = {level: {k: np.array([j == k for j in names]) for k in dict.fromkeys(names)} for level, names in keys.items()}

    def leaning(values):
        """Of each source, from (level, key) -> numbers."""
        made = {}
        for lang, source in own["s"]:
            n, m = own["l"][lang].sum(), own["s"][lang, source].sum()
            wide = (values["l", lang] * n + values["a", 0] * 50) / (n + 50)
            made[lang, source] = (values["s", (lang, source)] * m + wide * 50) / (m + 50)
        return made

    fits = {(level, k): least_determinant(x[rows]) for level, groups in own.items() for k, rows in groups.items()}
    means, covariances = (leaning({k: v[i] for k, v in fits.items()}) for i in (0, 1))
    d2 = np.zeros(len(x))
    for key, rows in own["s"].items():
        away = x[rows] - means[key]
        inverse = np.linalg.inv(covariances[key] + np.diag([f**2 for f in FEATURES.values()]))
        d2[rows] = np.einsum("ij,jk,ik->i", away, inverse, away)
    bins = np.floor(np.log2(d2 + 1e-3) * 16)
    middles = {
        (level, k): np.sort(bins[rows])[int(np.ceil(rows.sum() * 0.5 - 1e-9)) - 1]
        for level, groups in own.items() for k, rows in groups.items()
    }
    scales = leaning(middles)
    want = np.array([d / (2 ** ((scales[k] + 0.5) / 16) / 4.351) for d, k in zip(d2, keys["s"])])
    got = np.array([found[r["doc_id"]]["distance"] for r in sound])
    # A distance on the border of a bin may fall to either side of it; that moves a group's estimate by a row.
    assert np.isclose(got, want, rtol=1e-6).mean() > 0.9 and np.isclose(got, want, rtol=0.2).all()
    assert [found[r["doc_id"]]["kept"] for r in sound] == (want <= outliers.CUTOFF).tolist()


def test_a_growing_group_passes_by_degrees(make_docs, ws):
    """A document's distance changes little with each further document of its source."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(words, n))
    wide = [(i, text(60 + i % 90), "en", "wide") for i in range(150)]
    own = [(1000 + i, text(300 + i % 20), "en", "own") for i in range(130)]
    distances = []
    for n in (1, 40, 90, 99, 101, 130):
        found = robust_outliers(make_docs(wide + own[:n]), ws).where("doc_id = 1000").first()
        distances.append(found["distance"])
    # No jump at any number; two more documents move the nearest three quarters of a hundred a little.
    assert max(abs(np.diff(np.log(distances[2:5])))) < 0.5


def test_estimates_ignore_a_minority(make_docs, ws):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(500)]
    clean = [" ".join(rng.choice(words, 80 + i % 40)) for i in range(160)]
    junk = [" ".join(f"{w}###$$$" for w in rng.choice(words, 90)) for _ in range(40)]
    found = {r["doc_id"]: r["kept"] for r in robust_outliers(make_docs(clean + junk), ws).collect()}
    assert all(found[i] for i in range(160)) and not any(found[i] for i in range(160, 200))


def test_odd_rows(make_docs, ws, odd_texts):
    rows = [(i, t, [None, "en"][i % 2], [None, "a", "b"][i % 3]) for i, t in enumerate(odd_texts)]
    rows += [(None, "many words here " * 30, None, None)] * 2
    found = robust_outliers(make_docs(rows), ws)
    assert found.count() == len(rows)
    assert found.where("kept IS NULL").count() == 0
    assert robust_outliers(make_docs([]), ws).count() == 0


def test_runs_no_python(spark, ws):
    plan = robust_outliers(spark.read.parquet(f"{SF}/documents.parquet"), ws)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
