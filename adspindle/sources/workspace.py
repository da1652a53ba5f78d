"""Intermediate tables in the cluster's shared folder.

Long jobs cut their lineage by writing a table and reading it back. The files live under
``spark.checkpoint.dir``, which every executor and a restarted driver can reach, so losing an
executor never loses a round of work.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def work_root(spark: SparkSession) -> str:
    """The shared folder named by the session.

    A local session that names none gets a private folder, which goes when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    private = tempfile.mkdtemp(prefix="adspindle-")
    atexit.register(shutil.rmtree, private, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(private)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def observed(seen: Observation) -> dict:
    """What was observed; nothing, with 0 rows, where the plan was found to be empty and never ran."""
    try:
        return dict(seen.get)
    except Exception as error:  # the JVM's assertion has no class of its own in Python
        if "assertion failed" not in str(error):
            raise
        return {"rows": 0}


class Workspace:
    """A folder of its own for the intermediate tables of one job run.

    Every saved table gets a folder of its own too, also under a name used before, so a frame that
    still reads an earlier table is never cut off from it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{work_root(spark)}/adspindle/{label}-{uuid.uuid4().hex}"
        self._latest: dict[str, str] = {}
        self._saved = 0

    def fresh_path(self, name: str) -> str:
        self._saved += 1
        self._latest[name] = f"{self.path}/{self._saved:03d}-{name}"
        return self._latest[name]

    def save(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """Write ``df`` and read it back; ``metrics`` are aggregates taken during the same write."""
        seen = Observation()
        watched = df.observe(
            seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]
        )
        path = self.fresh_path(name)
        watched.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), observed(seen)

    def drop(self, name: str) -> None:
        """Remove the table last saved under ``name``, which nothing reads any more."""
        self._delete(self._latest.pop(name))

    def remove(self) -> None:
        """Remove all tables, once the job's results are written elsewhere."""
        self._delete(self.path)

    def _delete(self, folder: str) -> None:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

