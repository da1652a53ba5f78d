"""An ad log, and the tables that go with it, derived from the driver's tables.

Every column is one expression in the SQL that Spark and DuckDB share, so that the queries and
their oracles start from the same rows. Divisors differ on purpose, or the measures would coincide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspindle.operators.history import format_ids
from adspindle.operators.identity import first_id, identity_ids
from adspindle.operators.joins import shuffle_partitions
from adspindle.operators.tags import tag_set
from adspindle.schema import ODS_COLUMNS, RAW_COLUMNS
from adspindle.sources.dictionary import SEPARATOR, device_dictionary, read_dictionary
from adspindle.sources.workspace import Workspace

# The day that separates history from today.
TODAY = "20240116"
# Three days in a row, and which of them a row of the log falls on for jobs over three days. Rows that share
# identifiers fall on different days.
THREE_DAYS = ("20240114", "20240115", "20240116")
DAY_OF_THREE = "(case when rid % 5 = 0 then 2 when rid % 3 = 0 then 1 else 0 end)"


def _div(n: int) -> str:
    return f"cast(floor(event_id / {n}) as bigint)"


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


_COORDINATE = "cast(cast(({key} * {step}) % {cells} as double) / 10 - {half} as float)"
_LONGITUDE = _COORDINATE.format(key="{key}", step=1234, cells=3600, half=180)
_LATITUDE = _COORDINATE.format(key="{key}", step=777, cells=1800, half=90)

COLUMNS = {
    "ip": "case when event_id % 211 <> 0 then '10.' || "
    f"{_text('user_id % 7')} || '.' || {_text('event_id % 50')} || '.' || {_text('user_id % 200')} end",
    "requestmode": "1 + event_id % 3",
    "processnode": f"1 + {_div(3)} % 3",
    "adplatformproviderid": "case when user_id % 10 = 9 then 99999 else 100000 + user_id end",
    "iseffective": f"cast(case when {_div(9)} % 4 = 0 then 0 else 1 end as bigint)",
    "isbilling": f"cast(case when {_div(5)} % 6 = 0 then 0 else 1 end as bigint)",
    "isbid": f"{_div(2)} % 2",
    "iswin": f"cast(case when {_div(7)} % 3 = 1 then 1 else 0 end as bigint)",
    "adorderid": f"case when {_div(4)} % 11 = 0 then 0 else 199990 + {_div(11)} % 500 end",
    "adcreativeid": "199500 + (event_id * 17) % 3000",
    "winprice": "value",
    "adpayment": "value * 0.5e0",
    "provincename": f"'P' || {_text('user_id % 5')}",
    "cityname": f"case when event_id % 41 <> 0 then 'C' || {_text('user_id % 17')} end",
    "client": "case when event_id % 37 <> 0 then 1 + user_id % 5 end",
    "device": f"'dev' || {_text('user_id % 9')}",
    "appid": f"'XRX' || {_text('user_id % 12')}",
    "appname": "case when event_id % 4 = 0 then '' when event_id % 27 = 0 then '  ' "
    f"when event_id % 33 = 0 then null else 'app' || {_text('user_id % 12')} end",
    "networkmannerid": "user_id % 4",
    "networkmannername": "case user_id % 4 when 0 then 'WIFI' when 1 then '4G' when 2 then '3G' else '2G' end",
    "ispname": "case when event_id % 13 = 0 then null when user_id % 3 = 0 then '移动' "
    "when user_id % 3 = 1 then '联通' else 'isp2' end",
    "devicetype": "case when event_id % 31 <> 0 then user_id % 3 end",
    "channelid": f"case when user_id % 10 = 9 then 'CH_none' else 'CH' || {_text('user_id % 10')} end",
    "keywords": "case when event_id % 23 = 0 then null when event_id % 19 = 0 then '' "
    "when event_id % 17 = 0 then ',,' when event_id % 11 = 0 then ',' || event_type "
    f"when event_id % 6 = 0 then event_type || ',k' || {_text('event_id % 3')} || ',,' "
    f"else event_type || ',k' || {_text('event_id % 3')} end",
    "age": f"case when event_id % 29 <> 0 then {_text('18 + user_id % 50')} end",
    "sex": _text("user_id % 2"),
    "longitude": f"case when event_id % 17 <> 0 then {_LONGITUDE.format(key='user_id')} end",
    "latitude": f"case when event_id % 43 <> 0 then {_LATITUDE.format(key='user_id')} end",
    # Identifiers link rows inside blocks of 16, 32 and 64 events, so components stay small.
    "imei": f"case when event_id % 5 = 0 then '' else 'imei' || {_text(_div(16) + ' * 4 + event_id % 4')} end",
    "mac": f"case when event_id % 3 = 0 then 'mac' || {_text(_div(16) + ' * 3 + event_id % 2')} end",
    "idfa": f"case when event_id % 7 = 0 then 'idfa' || {_text(_div(32) + ' * 2 + event_id % 2')} else ' ' end",
    "openudid": f"case when event_id % 40 = 0 then 'open' || {_text(_div(64))} end",
    "androidid": f"case when event_id % 20 = 9 then 'andr' || {_text(_div(32))} end",
}
for _name in RAW_COLUMNS:
    COLUMNS.setdefault(_name, f"'{_name}_' || {_text('event_id % 7')}")

# Row number, and the row's day, next to the columns of the log.
EXTRA = {
    "rid": "event_id",
    "dt": f"replace({_text('cast(ts as date)')}, '-', '')",
}


def select_list(names: list[str]) -> list[str]:
    known = {**COLUMNS, **EXTRA}
    return [f"{known[n]} as {n}" for n in names]


RANGES = f"""
select start as ip_start, start + 400 as ip_end, s_name || mark as country,
  case when k % 5 = 0 then ' CZ88.NET' else 'net' || {_text('k % 9')} end as area,
  cast((k * 1234) % 3600 as double) / 10 - 180 as longitude,
  cast((k * 777) % 1800 as double) / 10 - 90 as latitude
from (
  select s_suppkey as k, s_name,
    167772160 + cast(floor(s_suppkey / 1000) as bigint) * 16777216
      + ((s_suppkey % 1000) % 7) * 65536 + cast(floor((s_suppkey % 1000) / 7) as bigint) * 448 as start,
    case s_suppkey % 4 when 0 then '省CITY_' || s_name when 1 then '省' when 2 then '市' else '省a省b' end as mark
  from supplier
) ranged
"""

# Wide ranges that hold narrow ones, some over many blocks of addresses.
NESTED_RANGES = f"""
select 167772160 + (k % 7) * 65536 + cast(floor(k / 7) as bigint) * 97 as ip_start,
  167772160 + (k % 7) * 65536 + cast(floor(k / 7) as bigint) * 97
    + case when k % 11 = 0 then 300000 when k % 3 = 0 then 5000 else k % 60 end as ip_end,
  'n' || {_text('k')} as country, 'net' || {_text('k % 9')} as area,
  cast(k % 360 as double) - 180 as longitude, cast(k % 180 as double) - 90 as latitude
from (
  select s_suppkey as k
  from supplier
) numbered
"""

# A log column that no job reads; a query can number rows in it.
ROW_COLUMN = "sessionid"

_REPLY_OPEN, _REPLY_CLOSE = '{"regeocode":{"addressComponent":{"businessAreas":', "}}}"
REPLIES = f"""
select {_LONGITUDE.format(key='c_custkey')} as longitude, {_LATITUDE.format(key='c_custkey')} as latitude,
  case c_custkey % 5
    when 0 then '{_REPLY_OPEN}[[]]{_REPLY_CLOSE}'
    when 1 then 'garbage'
    when 2 then '{_REPLY_OPEN}[{{"location":"1,2","name":"' || c_mktsegment || '","id":"1"}}]{_REPLY_CLOSE}'
    when 3 then '{_REPLY_OPEN}[{{"name":"' || c_mktsegment || '"}},{{"name":"N' || {_text('c_custkey % 11')} || '"}}]{_REPLY_CLOSE}'
    else '{_REPLY_OPEN}[]{_REPLY_CLOSE}' end as response,
  c_custkey as rid
from customer
"""

# Country texts of every shape, one per customer.
COUNTRIES = """
select c_custkey as rid, case c_custkey % 8
  when 0 then c_name || '省' || c_mktsegment when 1 then c_name || '省' when 2 then c_name || '市'
  when 3 then c_name || '省a省b' when 4 then '省' || c_name when 5 then '' when 6 then null
  else c_name || '省省' end as country
from customer
"""

APP_ENTRIES = f"""
select 'XRX' || {_text('p_partkey')} as key,
  case when p_partkey % 10 = 0 then 'XRX' || {_text('p_partkey')} else p_name end as value
from part
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str, source: str) -> DataFrame:
    view = f"adlog_{source}"
    table(spark, sf_dir, source).createOrReplaceTempView(view)
    return spark.sql(text.replace(f"from {source}\n", f"from {view}\n"))


# The columns of the events that the log is derived from.
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, spread over all tasks before they become wide rows, if their file has too few splits for that.

    Rows are in a fixed order in each partition, since salts come from a row's place there.
    """
    found = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    if found.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism:
        return found
    n = max(shuffle_partitions(spark), 2 * spark.sparkContext.defaultParallelism)
    return found.repartition(n, "event_id").sortWithinPartitions(*EVENT_COLUMNS)


def ods(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    source = events(spark, sf_dir) if spread else table(spark, sf_dir, "events")
    return source.selectExpr(*select_list([*EXTRA, *ODS_COLUMNS]))


def raw_log(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    source = events(spark, sf_dir) if spread else table(spark, sf_dir, "events")
    return source.selectExpr(*select_list([*EXTRA, *RAW_COLUMNS]))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, RANGES, "supplier")


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, NESTED_RANGES, "supplier")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, REPLIES, "customer")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, COUNTRIES, "customer")


def app_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as dictionary text, with an outdated line before each entry, and read back."""
    entries = derived(spark, sf_dir, APP_ENTRIES, "part")
    outdated = F.concat("key", F.lit(SEPARATOR), F.lit("old"))
    line = F.when(F.col("key") == F.col("value"), F.col("key")).otherwise(
        F.concat("key", F.lit(SEPARATOR), "value", F.lit(SEPARATOR))
    )
    path = Workspace(spark, "apps").fresh_path("lines")
    entries.select(F.concat_ws("\n", outdated, line).alias("value")).write.text(path)
    return read_dictionary(spark, path)


def devices(spark: SparkSession) -> DataFrame:
    return device_dictionary(spark)


def history(tagged: DataFrame) -> DataFrame:
    """Stored profiles, one per usable row of a tagged log, every weight 1."""
    return tagged.select(
        first_id().alias("userid"),
        format_ids(identity_ids()).alias("allUserId"),
        F.concat(F.array_join(tag_set(), " -> 1.0,"), F.lit(" -> 1.0")).alias("tags"),
    ).where("userid is not null")
