"""The advertising funnel: eleven measures and two ratios for any set of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.functions.text import client_label, safe_ratio

REQUEST, SHOW, CLICK = 1, 2, 3


def funnel_measures() -> list[Column]:
    """Sums with a map-side partial, so one hot dimension value is a few numbers per task."""
    mode, node = F.col("requestmode"), F.col("processnode")
    effective = F.col("iseffective") == 1
    billed = effective & (F.col("isbilling") == 1)
    traded = (F.col("adplatformproviderid") >= 100000) & billed
    won = traded & (F.col("iswin") == 1)
    spent = won & (F.col("adorderid") > 200000) & (F.col("adcreativeid") > 200000)

    def rows(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    def thousandths(money: str, name: str) -> Column:
        return F.sum(F.when(spent, F.col(money) / 1000).otherwise(0.0)).alias(name)

    return [
        rows((mode == REQUEST) & (node >= 1), "org_request_num"),
        rows((mode == REQUEST) & (node >= 2), "valid_request_num"),
        rows((mode == REQUEST) & (node == 3), "ad_request_num"),
        rows(traded & (F.col("isbid") == 1) & (F.col("adorderid") != 0), "bid_num"),
        rows(won, "bid_success_num"),
        rows((mode == SHOW) & effective, "ad_person_show_num"),
        rows((mode == CLICK) & effective, "ad_person_click_num"),
        rows((mode == SHOW) & billed, "media_show_num"),
        rows((mode == CLICK) & billed, "media_click_num"),
        thousandths("winprice", "dsp_consumtion"),
        thousandths("adpayment", "dsp_cost"),
    ]


# The columns of every funnel report after its dimensions, in table order.
REPORT_COLUMNS = """
org_request_num valid_request_num ad_request_num bid_num bid_success_num bid_success_rat
ad_person_show_num ad_person_click_num media_show_num media_click_num media_click_rat
dsp_consumtion dsp_cost
""".split()


def with_ratios(measured: DataFrame) -> DataFrame:
    """A won bid need not have been a counted bid, so the first ratio may exceed one."""
    return measured.withColumns(
        {
            "bid_success_rat": safe_ratio(F.col("bid_success_num"), F.col("bid_num")),
            "media_click_rat": safe_ratio(F.col("media_click_num"), F.col("media_show_num")),
        }
    )


def ad_funnel(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    measured = df.groupBy(*dims).agg(*funnel_measures())
    return with_ratios(measured).select(*dims, *REPORT_COLUMNS)


def device_funnel(df: DataFrame, group_label: bool = False) -> DataFrame:
    """The funnel by client and device, the client shown by name.

    Grouping is by the raw client, so several unknown clients give several ``other`` rows; with
    ``group_label`` they are one row and (client, device) is a key.
    """
    label = client_label(F.col("client"))
    if group_label:
        return ad_funnel(df.withColumn("client", label), ["client", "device"])
    return ad_funnel(df, ["client", "device"]).withColumn("client", label)
