"""The same functions under SQL names, as temporary SQL functions.

A SQL function is expanded into the calling query, so the optimizer sees plain expressions and not
an opaque call, also inside a join condition.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from adspindle.functions.place import BASE32_DIGITS, GEOHASH_ALPHABET


def _cell(value: str, span: int) -> str:
    number = f"floor(CAST({value} AS DOUBLE) * 1048576 / {span}) + 524288"
    return f"CAST(conv(bin(least(greatest({number}, 0), 1048575)), 4, 10) AS BIGINT)"


# The names and argument lists, spelled as callers know them.
SQL_FUNCTIONS = {
    "geoHashCode(longitude FLOAT, latitude FLOAT) RETURNS STRING": f"""
        CASE WHEN longitude BETWEEN -180 AND 180 AND latitude BETWEEN -90 AND 90 THEN
          lpad(translate(conv(CAST({_cell('longitude', 360)} * 2 + {_cell('latitude', 180)} AS STRING), 10, 32),
                         '{BASE32_DIGITS}', '{GEOHASH_ALPHABET}'), 8, '0') END""",
    # Without a row key there is nothing to derive a salt from, so the one-argument form spreads by
    # the partition a row sits in; give a row key for an even spread inside a partition.
    "addPrifix(key STRING, row_key STRING DEFAULT '') RETURNS STRING": """
        concat(CAST(pmod(xxhash64(row_key, spark_partition_id()), 10L) AS STRING), '#', key)""",
    "unPrifix(key STRING) RETURNS STRING": "substring_index(key, '#', -1)",
    "prfiex(number INT, key STRING) RETURNS STRING": "concat(CAST(number AS STRING), '#', key)",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions callable from SQL text in this session; returns their names."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in SQL_FUNCTIONS]
