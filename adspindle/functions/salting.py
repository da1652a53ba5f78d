"""Salts for hot keys.

A random salt may change when a task is run again, and then rows can be lost or counted twice.
These salts depend only on the row's values and on the partition it sits in, both of which are the
same on every attempt. The partition number also spreads exact copies of one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "#"


def salt_number(n: int, *row_key: Column, by_partition: bool = False) -> Column:
    """A number from 0 to n-1."""
    parts = [*row_key, F.spark_partition_id()] if by_partition else list(row_key)
    return F.pmod(F.xxhash64(*parts), F.lit(n).cast("bigint")).cast("int")


def add_salt(key: Column, *row_key: Column, n: int = 10) -> Column:
    """``<salt>#<key>``"""
    return add_prefix(salt_number(n, *row_key), key)


def add_prefix(number: Column, key: Column) -> Column:
    return F.concat(number.cast("string"), F.lit(MARK), key)


def remove_salt(salted: Column) -> Column:
    """What follows the last mark; a key that itself holds the mark needs its salt in a column of its own."""
    return F.substring_index(salted, MARK, -1)
