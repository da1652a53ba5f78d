"""Tag rules: from one log row to a set of tag names.

A rule is a function that returns a column of ``array<string>``. All rules of a row are evaluated in
one projection and exploded once; a tag counts once per row, with weight 1.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.functions.text import not_blank, or_null_text
from adspindle.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join

Rule = Callable[[], Column]

APP_NAME, CLIENT_CODE, ISP_CODE, NETWORK_CODE = "app_name_found", "client_code", "isp_code", "network_code"


def dictionary_lookup(
    df: DataFrame,
    dictionary: DataFrame,
    key: Column,
    name: str,
    limit: int = BROADCAST_BYTES,
    small: bool | None = None,
    **options,
) -> DataFrame:
    """Add column ``name`` with the dictionary's value for ``key``, '' where there is none."""
    entries = dictionary.select(F.col("key").alias("__key"), F.col("value").alias(name))
    found = lookup_join(df.withColumn("__key", key), entries, "__key", "left", limit, small=small, **options)
    return found.withColumn(name, F.coalesce(name, F.lit(""))).drop("__key")


def with_dictionary_values(
    df: DataFrame,
    apps: DataFrame,
    devices: DataFrame,
    limit: int = BROADCAST_BYTES,
    small_apps: bool | None = None,
    **options,
) -> DataFrame:
    """Add the looked-up app name and the codes of client, carrier and network kind.

    ``small_apps`` tells whether the app dictionary, already measured, is within the limit.
    """
    df = dictionary_lookup(df, apps, F.col("appid"), APP_NAME, limit, small_apps, **options)
    return with_device_codes(df, devices, limit, **options)


def with_device_codes(df: DataFrame, devices: DataFrame, limit: int = BROADCAST_BYTES, **options) -> DataFrame:
    small = fits_broadcast(devices, limit)
    keys = {
        CLIENT_CODE: F.coalesce("client", F.lit(0)).cast("string"),
        ISP_CODE: F.col("ispname"),
        NETWORK_CODE: F.col("networkmannername"),
    }
    for name, key in keys.items():
        df = dictionary_lookup(df, devices, key, name, limit, small, **options)
    return df


def _tag(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)


def _tag_list(prefix: str, text: Column) -> Column:
    """One tag per piece of a comma list, by the rule of ``pieces``; the prefix goes in before splitting."""
    kept = F.regexp_replace(text, ",+$", "")
    prefixed = F.concat(F.lit(prefix), F.replace(kept, F.lit(","), F.lit(f",{prefix}")))
    return F.when(~((text != "") & (kept == "")), F.split(prefixed, ","))


def app_rule() -> Column:
    name = F.col("appname")
    return F.array(_tag("APP_", F.when(not_blank(name), name).otherwise(F.col(APP_NAME))))


def device_rule() -> Column:
    return F.array(
        _tag("DC_", or_null_text(F.col("device"))),
        _tag("DT_", F.col(CLIENT_CODE)),
        _tag("ISP_", F.col(ISP_CODE)),
        _tag("NT_", F.col(NETWORK_CODE)),
        _tag("DET_", F.coalesce("devicetype", F.lit(0)).cast("string")),
    )


def region_rule() -> Column:
    return F.array(
        _tag("RN_", or_null_text(F.col("provincename"))), _tag("CT_", or_null_text(F.col("cityname")))
    )


def keyword_rule() -> Column:
    return _tag_list("KW_", F.col("keywords"))


def channel_rule() -> Column:
    return F.array(_tag("CN_", or_null_text(F.col("channelid"))))


def age_rule() -> Column:
    return F.array(_tag("AGE_", or_null_text(F.col("age"))))


def sex_rule() -> Column:
    return F.array(_tag("SEX_", or_null_text(F.col("sex"))))


def business_area_rule() -> Column:
    areas = F.col("areas")
    return _tag_list("BA_", F.when(not_blank(areas), areas))


ALL_RULES: tuple[Rule, ...] = (
    app_rule,
    device_rule,
    region_rule,
    sex_rule,
    keyword_rule,
    channel_rule,
    age_rule,
    business_area_rule,
)


def tag_set(rules: Sequence[Rule] = ALL_RULES) -> Column:
    """The distinct tags that the rules give a row; a rule without an answer adds none."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(rule(), none) for rule in rules]))


def tag_rows(df: DataFrame, keep: Sequence[str], rules: Sequence[Rule] = ALL_RULES) -> DataFrame:
    """Long form: ``keep`` columns, ``tag`` and ``weight``.

    The outer form of explode keeps the optimizer from testing for empty sets with a second
    evaluation of all rules; rows without tags are dropped afterwards.
    """
    return set_rows(df.select(*keep, tag_set(rules).alias("tags")), keep)


def set_rows(sets: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The long form of rows that hold their tag set in ``tags``."""
    exploded = sets.select(*keep, F.explode_outer("tags").alias("tag"))
    return exploded.where("tag IS NOT NULL").withColumn("weight", F.lit(1.0))
