"""The seven daily reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspindle.functions.text import client_label
from adspindle.operators.funnel import REPORT_COLUMNS, ad_funnel, device_funnel, funnel_measures, with_ratios

# Table name and key of each funnel report.
FUNNEL_REPORTS = {
    "ad_region_analysis": ["provincename", "cityname"],
    "app_analysis": ["appid", "appname"],
    "ad_device_type_analysis": ["client", "device"],
    "ad_network_analysis": ["networkmannerid", "networkmannername"],
    "ad_operator_analysis": ["ispname"],
    "ad_channel_analysis": ["channelid"],
}
COUNT_REPORT = "province_city_analysis"
COUNT_KEY = FUNNEL_REPORTS["ad_region_analysis"]


def report_province_city(ods: DataFrame) -> DataFrame:
    return ods.groupBy(*COUNT_KEY).agg(F.count(F.lit(1)).alias("number"))


def report_ad_region(ods: DataFrame) -> DataFrame:
    return ad_funnel(ods, FUNNEL_REPORTS["ad_region_analysis"])


def report_ad_app(ods: DataFrame) -> DataFrame:
    return ad_funnel(ods, FUNNEL_REPORTS["app_analysis"])


def report_ad_device(ods: DataFrame, group_label: bool = False) -> DataFrame:
    return device_funnel(ods, group_label)


def report_ad_network(ods: DataFrame) -> DataFrame:
    return ad_funnel(ods, FUNNEL_REPORTS["ad_network_analysis"])


def report_ad_operator(ods: DataFrame) -> DataFrame:
    return ad_funnel(ods, FUNNEL_REPORTS["ad_operator_analysis"])


def report_ad_channel(ods: DataFrame) -> DataFrame:
    return ad_funnel(ods, FUNNEL_REPORTS["ad_channel_analysis"])


# Rows are brought down to tuples of dimensions first if there are so many times fewer of these.
TUPLE_GAIN = 4


def fewer_tuples(log: DataFrame, dims: Sequence[str], gain: float = TUPLE_GAIN) -> bool:
    """Whether the log has far fewer different tuples of dimensions than rows; reads the dimensions only."""
    seen = log.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*dims)).alias("tuples")).first()
    return seen["tuples"] * gain <= seen["rows"]


def report_bundle(ods: DataFrame, by_tuples: bool | None = None) -> DataFrame:
    """All reports from one scan of the log: every grouping in one aggregate, told apart by ``report``.

    Clients are grouped by label here, so that every report has its key. The province and city
    count is the ``number`` column of the region rows. A log with far fewer tuples of all dimensions than
    rows is brought down to these tuples, each with its measures, and only they are copied for every
    grouping; ``by_tuples`` tells whether to, otherwise it is found out.
    """
    dims = [d for key in FUNNEL_REPORTS.values() for d in key]
    labelled = ods.withColumn("client", client_label(F.col("client")))
    sets = [[F.col(d) for d in key] for key in FUNNEL_REPORTS.values()]
    measures = [F.count(F.lit(1)).alias("number"), *funnel_measures()]
    if fewer_tuples(labelled, dims) if by_tuples is None else by_tuples:
        labelled = labelled.groupBy(*dims).agg(*measures)
        measures = [F.sum(c).alias(c) for c in labelled.columns if c not in dims]
    grouped = labelled.groupingSets(sets, *dims).agg(F.grouping_id().alias("grouping"), *measures)
    name = F.lit(None).cast("string")
    for report, key in FUNNEL_REPORTS.items():
        # A dimension that is not part of the grouping sets its bit, the first dimension the highest.
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in key)
        name = F.when(F.col("grouping") == bits, report).otherwise(name)
    return with_ratios(grouped).select(name.alias("report"), *dims, "number", *REPORT_COLUMNS)


def report_of_bundle(bundle: DataFrame, report: str) -> DataFrame:
    if report == COUNT_REPORT:
        return report_of_rows(bundle, "ad_region_analysis").select(*COUNT_KEY, "number")
    return report_of_rows(bundle, report).select(*FUNNEL_REPORTS[report], *REPORT_COLUMNS)


def report_of_rows(bundle: DataFrame, report: str) -> DataFrame:
    return bundle.where(F.col("report") == report)
