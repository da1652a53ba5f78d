"""Reading the raw ad log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspindle.schema import RAW_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def read_ad_log(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, keep_corrupt: bool = False
) -> DataFrame:
    """One day of JSON lines, with a declared schema instead of an inference pass.

    With ``keep_corrupt`` the text of lines that do not parse is kept in ``_corrupt_record``.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).json(path)


def readable_rows(log: DataFrame) -> DataFrame:
    """The rows of a log read with its unreadable lines, without these and their column."""
    return log.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def unreadable_lines(log: DataFrame) -> DataFrame:
    """``(line, in_part)``: the lines that did not parse, and whether an address was read before parsing failed."""
    bad = log.where(F.col(CORRUPT_COLUMN).isNotNull())
    # The second column is read as well because the engine refuses to read the text of such lines alone.
    return bad.select(F.col(CORRUPT_COLUMN).alias("line"), F.col("ip").isNotNull().alias("in_part"))


# The JVM never compiles a generated method of more bytes.
COMPILED_BYTES = 8000


def compile_wide_rows(spark: SparkSession) -> None:
    """Lets the session do without generated methods too large to be compiled, such as those over all columns of a log.

    Its operators then run one by one, on small methods that are compiled. A lower limit stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > COMPILED_BYTES:
        spark.conf.set(limit, COMPILED_BYTES)
