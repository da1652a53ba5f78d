"""Column names and types of the ad log."""

from __future__ import annotations

from pyspark.sql import types as T

# The 89 columns of the enriched daily log table, in table order.
ODS_COLUMNS = """
ip sessionid advertisersid adorderid adcreativeid adplatformproviderid
sdkversion adplatformkey putinmodeltype requestmode adprice adppprice
requestdate appid appname uuid device client osversion density pw ph
longitude latitude provincename cityname
ispid ispname networkmannerid networkmannername iseffective isbilling
adspacetype adspacetypename devicetype processnode apptype district paymode
isbid bidprice winprice iswin cur rate cnywinprice
imei mac idfa openudid androidid
rtbprovince rtbcity rtbdistrict rtbstreet storeurl realip isqualityapp
bidfloor aw ah imeimd5 macmd5 idfamd5 openudidmd5 androididmd5
imeisha1 macsha1 idfasha1 openudidsha1 androididsha1 uuidunknow userid
iptype initbidprice adpayment agentrate lomarkrate adxrate title keywords
tagid callbackdate channelid mediatype email tel sex age
""".split()

# Columns added by the place lookup; everything else comes with the raw log.
PLACE_COLUMNS = ["longitude", "latitude", "provincename", "cityname"]
RAW_COLUMNS = [c for c in ODS_COLUMNS if c not in PLACE_COLUMNS]

ID_COLUMNS = ["imei", "mac", "idfa", "openudid", "androidid"]

# What the tag rules read of the log.
TAG_COLUMNS = (
    "longitude latitude appid appname device client ispname networkmannername devicetype "
    "provincename cityname keywords channelid age sex"
).split()

_BIGINT = set(
    "requestmode processnode adplatformproviderid iseffective isbilling isbid iswin "
    "adorderid adcreativeid client devicetype networkmannerid".split()
)
_DOUBLE = set("winprice adpayment".split())
_FLOAT = set("longitude latitude".split())


def column_type(name: str) -> T.DataType:
    if name in _BIGINT:
        return T.LongType()
    if name in _DOUBLE:
        return T.DoubleType()
    if name in _FLOAT:
        return T.FloatType()
    return T.StringType()


def _struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, column_type(n)) for n in names])


RAW_SCHEMA = _struct(RAW_COLUMNS)
ODS_SCHEMA = _struct(ODS_COLUMNS)
