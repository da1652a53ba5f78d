"""From raw documents to packed training sequences, in five stages.

Each stage reads the rows that the one before has written, works on all of them, and returns the
columns of ``documents`` again; only the last returns pieces of token sequences. Columns beyond those of
``documents`` are carried along; their names must not begin with two underscores. An empty table goes through
all stages and gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspindle.llm import jaccard, mixing, packing, quality, secret_scan
from adspindle.llm.queries import WORD_VOCABULARY
from adspindle.llm.ship import ship_package
from adspindle.sources.workspace import Workspace

#: No stage but the mix can be said in SQL.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier, learnt from the labelled ones among them, rejects.

    Of documents with a label outside the held-out fold about ``quality.FIT_DOCS`` are learnt from. A null text
    is judged like an empty one; equal rows stay or go together; without labels of both classes all stay.
    """
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fitting = quality.fitting_ids(labels)
    measured, _ = Workspace(spark, "quality").save(quality.measure(docs, fitting), "statistics")
    return quality.keep_good(docs, quality.learn(measured, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one with the smallest doc_id.

    Near copies share 80 percent of their runs of five words. Of equal rows one stays. Null texts and texts
    without words are in no group and stay; null doc_ids come last in their group.
    """
    ship_package(spark)
    return jaccard.keep_representatives(docs, Workspace(spark, "jaccard"), size=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret found, and brings ``n_chars`` up to date; no document goes, and null texts stay null."""
    ship_package(spark)
    return secret_scan.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources have their target weights.

    A null source is a source of its own; documents without words, null texts among them, are left out.
    """
    ship_package(spark)
    mixed = mixing.mix_sources(docs, Workspace(spark, "mixing"))
    times = F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))
    return mixed.where("__copies > 0").select(*docs.columns, times.alias("__copy")).drop("__copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences that mix the sources alike; repeated rows are packed each."""
    ship_package(spark)
    return packing.pack_by_mixture(docs, WORD_VOCABULARY, Workspace(spark, "packing"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    workspace = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = workspace.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
