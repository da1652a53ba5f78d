"""One query per operator, over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspindle.llm import (
    codes,
    jaccard,
    mixing,
    neighbours,
    outliers,
    packing,
    periodic,
    quality,
    secret_scan,
    sharding,
    tokens,
    toxicity,
    urls,
)
from adspindle.llm.ship import ship_package
from adspindle.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SHARDS = 24


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_classifier(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.classify_quality(docs, labels, Workspace(spark, "op1"))


@query
def op2_nearest_neighbours(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, Workspace(spark, "op2"))


@query
def op3_url_filters(spark, sf_dir):
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


@query
def op4_token_counts(spark, sf_dir):
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query
def op5_packing(spark, sf_dir):
    pieces = packing.pack_by_mixture(_table(spark, sf_dir, "documents"), WORD_VOCABULARY, Workspace(spark, "op5"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_sharding(spark, sf_dir):
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), SHARDS, Workspace(spark, "op6"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_ngram_jaccard_join(spark, sf_dir):
    found = jaccard.jaccard_components(_table(spark, sf_dir, "documents"), Workspace(spark, "op7"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op8_mixing(spark, sf_dir):
    drawn = mixing.sample_copies(_table(spark, sf_dir, "documents"), Workspace(spark, "op8"))
    return drawn.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


@query
def op9_quality_rules(spark, sf_dir):
    judged = outliers.robust_outliers(_table(spark, sf_dir, "documents"), Workspace(spark, "op9"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query
def op10_secret_scans(spark, sf_dir):
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


@query
def op11_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.classify_toxicity(docs, labels, Workspace(spark, "op11"))


@query
def op12_vector_codes(spark, sf_dir):
    return codes.code_digests(_table(spark, sf_dir, "embeddings"), Workspace(spark, "op12"))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic.run_digests(_table(spark, sf_dir, "documents"))


_PARTS = """
    SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS edge FROM pages
"""

ORACLES["op3_url_filters"] = rf"""
WITH split AS (
    SELECT page_id,
           CASE WHEN edge > 0 THEN translate(regexp_extract(substr(u, edge + 3), '^[^/?#]*'),
                                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN edge > 0 THEN regexp_extract(substr(u, edge + 3), '^[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
    FROM ({_PARTS})
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), globs(place, wanted, pattern) AS (
    VALUES {", ".join(f"({i}, '{g}', '{g.replace('*', '%')}')" for i, g in enumerate(urls.BLOCKED_GLOBS))}
), fit AS (
    SELECT s.page_id, s.host, s.path,
           max_by(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
           max_by(r.verdict, length(r.rule_host || r.rule_path)) AS said
    FROM split s LEFT JOIN rules r
      ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
    GROUP BY ALL
), met AS (
    SELECT f.page_id, f.host, f.path, min_by(g.wanted, g.place) AS met
    FROM (SELECT DISTINCT page_id, host, path FROM fit) f JOIN globs g ON '.' || f.host || f.path LIKE g.pattern
    GROUP BY ALL
)
SELECT f.page_id, f.host, f.path, f.rule,
       coalesce(f.said, CASE WHEN m.met IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN f.rule IS NULL THEN m.met END AS "glob"
FROM fit f LEFT JOIN met m ON f.page_id = m.page_id AND f.host = m.host AND f.path = m.path
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op6_sharding"] = f"""
WITH codes AS (
    SELECT list(code ORDER BY i) AS code FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS code
        FROM range(256) t(i))
), raw AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
    SELECT doc_id, length(h) // 2 + 8 AS size,
           xor(list_reduce(
               list_transform(range(length(h) // 2), lambda k: cast('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)),
               lambda c, b: xor(c >> 8, code[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
    FROM raw, codes
), placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS whole
    FROM sized
), sharded AS (
    SELECT *, cast((2 * upto - size) * {SHARDS} // (2 * whole) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
       cast(NULL AS INTEGER) AS grown_shard
FROM sharded
"""

ORACLES["op7_ngram_jaccard_join"] = rf"""
WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT r, doc_id, list_distinct(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingles
    FROM split
), listed AS (
    SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), pairs AS (
    SELECT a.r AS a, b.r AS b FROM listed a JOIN listed b ON a.shingle = b.shingle AND a.r < b.r
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(r, other) AS (
    SELECT r, r FROM sets UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, min(o.doc_id) AS component_id
FROM sets s JOIN reach ON s.r = reach.r JOIN sets o ON reach.other = o.r
GROUP BY s.r, s.doc_id, s.shingles
"""

_CRC_CODES = """
    SELECT list(code ORDER BY i) AS code FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS code
        FROM range(256) t(i))
"""


def _vector_code_rounds() -> str:
    """The rounds of the codebooks, one step after the other."""
    near = """
    SELECT r, p, e FROM (
        SELECT x.r, x.p, b.e, row_number() OVER (PARTITION BY x.r, x.p ORDER BY list_sum(list_transform(
            range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))), b.e) AS place
        FROM parts x JOIN book{n} b ON x.p = b.p)
    WHERE place = 1
    """
    steps = []
    for n in range(codes.ROUNDS):
        steps.append(f"near{n} AS MATERIALIZED ({near.format(n=n)})")
        steps.append(f"""book{n + 1} AS MATERIALIZED (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
        SELECT b.p, b.e, i.i, CASE WHEN count(x.r) > 0
                   THEN (sum(x.v[i.i]) - ((sum(x.v[i.i]) % count(x.r)) + count(x.r)) % count(x.r)) // count(x.r)
                   ELSE any_value(b.v[i.i]) END AS m
        FROM book{n} b CROSS JOIN (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) i
        LEFT JOIN near{n} a ON a.p = b.p AND a.e = b.e LEFT JOIN parts x ON x.r = a.r AND x.p = a.p
        GROUP BY b.p, b.e, i.i)
    GROUP BY p, e)""")
    steps.append(f"final AS MATERIALIZED ({near.format(n=codes.ROUNDS)})")
    return ", ".join(steps)


ORACLES["op12_vector_codes"] = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
           list_transform(embedding, lambda x: cast(floor(x::DOUBLE * {codes.SCALE}) AS BIGINT)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT r, p, w[p * len(w) // {codes.PARTS} + 1 : (p + 1) * len(w) // {codes.PARTS}] AS v
    FROM kept CROSS JOIN (SELECT unnest(range({codes.PARTS})) AS p)
), book0 AS (
    SELECT p, r - 1 AS e, v FROM parts WHERE r <= {codes.ENTRIES}
), {_vector_code_rounds()}, coded AS (
    SELECT x.r, string_agg(printf('%02x', f.e), '' ORDER BY x.p) AS code,
           cast(sum(list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))) AS BIGINT) AS error
    FROM parts x JOIN final f ON f.r = x.r AND f.p = x.p JOIN book{codes.ROUNDS} b ON b.p = f.p AND b.e = f.e
    GROUP BY x.r
), digest AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{codes.ROUNDS}
)
SELECT k.vec_id, c.code, c.error, cast(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept k JOIN coded c ON c.r = k.r CROSS JOIN digest
"""

# Two places that share five words at some distance lie in a stretch that repeats at that distance; a run has such places.
ORACLES["op13_periodic_runs"] = rf"""
WITH codes AS ({_CRC_CODES}
), split AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w, hex(encode(doc_id::VARCHAR)) AS h
    FROM documents
), seeded AS (
    SELECT r, doc_id, w, len(w) AS n, xor(list_reduce(
               list_prepend(4294967295, list_transform(range(length(h) // 2), lambda k: cast('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, code[(xor(c, b) & 255) + 1])), 4294967295) AS seed
    FROM split, codes
), placed AS (
    SELECT *, (seed // 10) % greatest(n, 1) AS a FROM seeded
), made AS MATERIALIZED (
    SELECT r, doc_id, n, CASE WHEN seed % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
               w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (seed // 10) % 8)) END]) ELSE w END AS w
    FROM placed
), fives AS MATERIALIZED (
    SELECT r, i, hash(w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5]) AS five
    FROM (SELECT r, w, unnest(range(n - 4)) AS i FROM made WHERE n >= 6)
), near AS (
    SELECT a.r, a.i, b.i - a.i AS q FROM fives a JOIN fives b ON a.r = b.r AND a.five = b.five AND b.i > a.i
    JOIN made m ON m.r = a.r AND 4 * (b.i - a.i) <= m.n
), islands AS (
    SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM near
), stretches AS (
    SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM islands GROUP BY r, q, island
), runs AS MATERIALIZED (
    SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length
), dropped AS (
    SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), staying AS (
    SELECT m.r, string_agg(m.word, ' ' ORDER BY m.i) AS collapsed
    FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM made) m LEFT JOIN dropped d ON d.r = m.r AND d.i = m.i
    WHERE d.r IS NULL GROUP BY m.r
), listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS all_runs FROM runs GROUP BY r
), best AS (
    SELECT a.r, a.start, a.length, a.period FROM runs a
    QUALIFY row_number() OVER (PARTITION BY a.r ORDER BY a.length::DOUBLE / a.period DESC, a.start, a.period) = 1
)
SELECT m.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.all_runs, '')) AS runs_sha256, sha256(coalesce(s.collapsed, '')) AS collapsed_sha256
FROM made m LEFT JOIN listed l ON l.r = m.r LEFT JOIN best b ON b.r = m.r LEFT JOIN staying s ON s.r = m.r
"""
