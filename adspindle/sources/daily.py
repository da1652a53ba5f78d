"""Daily tables: parquet tables per product and day, published a day at a time.

A day's tables are written beside what is there, checked, and then named by one small manifest per day,
``<root>/_days/<dt>.json``, whose replacement is a single rename. A reader sees all tables of one version or
all of another; a job that fails half way leaves the day as it was. The version that a day replaces stays
until the next one, for readers that have just begun. One job at a time writes a day.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from types import TracebackType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_days"


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def previous_date_key(day: Column) -> Column:
    return date_key(F.date_sub(day, 1))


def today_keys(spark: SparkSession) -> tuple[str, str]:
    """Today's and yesterday's key by the cluster's clock; jobs take the day as a parameter."""
    now = F.current_date()
    row = spark.range(1).select(date_key(now), previous_date_key(now)).first()
    return row[0], row[1]


class _Files:
    """The few file operations of a manifest, on whatever file system holds the root."""

    def __init__(self, spark: SparkSession, root: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.gateway = spark.sparkContext._gateway
        self.io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.path(root).getFileSystem(conf)
        self.context = self.hadoop.FileContext.getFileContext(self.system.getUri(), conf)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def read(self, name: str) -> str | None:
        if not self.system.exists(self.path(name)):
            return None
        stream = self.system.open(self.path(name))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """The file as a whole, or as it was."""
        fresh = f"{name}.{uuid.uuid4().hex}"
        stream = self.system.create(self.path(fresh))
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        rename = getattr(self.hadoop, "Options$Rename")
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self.context.rename(self.path(fresh), self.path(name), how)

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _manifest(root: str, dt: str) -> str:
    return f"{root}/{MANIFESTS}/{dt}.json"


def published(spark: SparkSession, root: str, dt: str) -> dict[str, dict]:
    """The day's tables by name: ``path`` below the root, ``schema``, and ``by`` and ``buckets`` if it is bucketed."""
    text = _Files(spark, root).read(_manifest(root, dt))
    return json.loads(text)["tables"] if text else {}


def default_buckets(spark: SparkSession) -> int:
    """As many as shuffles have partitions, so that what is joined to a bucketed table is dealt into its buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_buckets(df: DataFrame, by: str, n: int | None = None) -> DataFrame:
    """Rows dealt to one task per bucket, so that each bucket is one file."""
    return df.repartition(n or default_buckets(df.sparkSession), by)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _catalog_name(path: str) -> str:
    """The name under which the catalog knows a bucketed version's buckets; new for every version."""
    return "adspindle_" + path.rsplit("-", 1)[1]


def _delete(spark: SparkSession, root: str, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(path)}")
    _Files(spark, root).delete(f"{root}/{path}")


def _read(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    path = f"{root}/{entry['path']}"
    if not entry.get("by"):
        return spark.read.schema(entry["schema"]).parquet(path)
    # Only a table of the catalog tells the engine its buckets.
    name = _catalog_name(entry["path"])
    if not spark.catalog.tableExists(name):
        escaped = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({entry['schema']}) USING parquet "
            f"CLUSTERED BY ({entry['by']}) INTO {entry['buckets']} BUCKETS LOCATION '{escaped}'"
        )
    return spark.table(name)


def read_daily(spark: SparkSession, root: str, name: str, dt: str) -> DataFrame:
    """The rows of one day's published version; nothing of other days is listed or read."""
    tables = published(spark, root, dt)
    if name not in tables:
        raise ValueError(f"no table {name} of {dt} below {root}")
    return _read(spark, root, tables[name]).withColumn("dt", F.lit(dt))


class StagedDay:
    """A new version of some of a day's tables, which nobody sees before ``publish``.

    As a context it is published at the end, and discarded if an exception comes through. Tables of the
    day that it does not write stay as they are.
    """

    def __init__(self, spark: SparkSession, root: str, dt: str):
        self.spark, self.root, self.dt = spark, root, dt
        self.tables: dict[str, dict] = {}

    def write(
        self, df: DataFrame, name: str, keys: Sequence[str] = (), n: int | None = None, bucket_by: str | None = None
    ) -> DataFrame:
        """Writes a table into the new version, checks its key, and returns what was written, without ``dt``.

        With ``keys`` and ``n`` the rows go into ``n`` hash partitions of the keys. With ``keys`` alone
        the engine sizes the files and splits oversized groups of one key. Without keys nothing is
        shuffled: that is for the log itself, whose rows are already spread over the input splits and
        whose keys are not unique. With ``bucket_by`` each task files its rows into ``n`` buckets of
        that column, see ``in_buckets``; rows are not moved for it, so those that come from another bucketed
        table stay where they are.
        """
        out = df.drop("dt")
        entry = {"path": f"{name}/dt={self.dt}/v-{uuid.uuid4().hex}", "schema": _ddl(out)}
        path = f"{self.root}/{entry['path']}"
        if name in self.tables:
            self._drop(self.tables[name])
        # Named before it is there, so that also a write that fails is cleared away.
        self.tables[name] = entry
        if bucket_by:
            entry |= {"by": bucket_by, "buckets": n or default_buckets(self.spark)}
            out.write.bucketBy(entry["buckets"], bucket_by).option("path", path).saveAsTable(_catalog_name(path))
        else:
            if keys and n:
                out = out.repartition(n, *keys)
            elif keys:
                out = out.hint("rebalance", *keys)
            out.write.parquet(path)
        written = _read(self.spark, self.root, entry)
        return require_unique(written, keys) if keys else written

    def publish(self) -> None:
        """Names the new version in the day's manifest, and removes the version before the one it replaces."""
        files = _Files(self.spark, self.root)
        text = files.read(_manifest(self.root, self.dt))
        before = json.loads(text) if text else {"tables": {}, "replaced": []}
        replaced = [t["path"] for name, t in before["tables"].items() if name in self.tables]
        manifest = {"tables": before["tables"] | self.tables, "replaced": replaced}
        files.replace(_manifest(self.root, self.dt), json.dumps(manifest, indent=1))
        self.tables = {}
        for path in before["replaced"]:
            _delete(self.spark, self.root, path)

    def discard(self) -> None:
        """Removes what has been written."""
        for entry in self.tables.values():
            self._drop(entry)
        self.tables = {}

    def _drop(self, entry: dict) -> None:
        _delete(self.spark, self.root, entry["path"])

    def __enter__(self) -> StagedDay:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if kind is None:
            self.publish()
        else:
            self.discard()


def write_daily(
    df: DataFrame, root: str, name: str, dt: str, keys: Sequence[str] = (), n: int | None = None
) -> None:
    """Replace one day of a daily table; running a day again gives the same table, also an empty one.

    Rows that repeat the key raise an error, and the day stays as it was. See ``StagedDay.write`` for
    ``keys`` and ``n``.
    """
    with StagedDay(df.sparkSession, root, dt) as day:
        day.write(df, name, keys, n)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; empty when the key holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"rows repeat the key {list(keys)}")
    return df
