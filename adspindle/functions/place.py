"""Scalar functions on addresses, places and coordinates, all JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROVINCE_MARK = "省"

# Texts for addresses no range covers, and for the marker of local networks.
UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_AREA = "未知地区"
LOCAL_MARK = "CZ88.NET"
LOCAL_AREA = "本机或本网络"
PRIVATE_PREFIX = "192.168."

GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# Digits that the base-32 number format of the engine uses for the same 32 values.
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

_IPV4 = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text as an unsigned 32-bit number; null when it is not one."""
    part = [F.split(ip, r"\.")[i].try_cast("bigint") for i in range(4)]
    valid = ip.rlike(_IPV4)
    for p in part:
        valid = valid & (p <= 255)
    return F.when(valid, part[0] * 16777216 + part[1] * 65536 + part[2] * 256 + part[3])


def long_to_ip(number: Column) -> Column:
    parts = [F.shiftright(number, bits).bitwiseAND(F.lit(255)).cast("string") for bits in (24, 16, 8, 0)]
    return F.when(number.between(0, 4294967295), F.concat_ws(".", *parts))


def public_ip(ip: Column) -> Column:
    """The address, or null for one of a private home network, which has no place."""
    return F.when(~ip.startswith(PRIVATE_PREFIX), ip)


def province(country: Column) -> Column:
    """Up to and with the first province mark, if any text follows the mark; else all of it."""
    kept = F.regexp_replace(country, f"{PROVINCE_MARK}+$", "")
    return F.when(
        F.instr(kept, PROVINCE_MARK) > 0,
        F.concat(F.substring_index(kept, PROVINCE_MARK, 1), F.lit(PROVINCE_MARK)),
    ).otherwise(country)


def city(country: Column) -> Column:
    """The text between the first and second province mark, under the same condition."""
    kept = F.regexp_replace(country, f"{PROVINCE_MARK}+$", "")
    return F.when(
        F.instr(kept, PROVINCE_MARK) > 0, F.split(kept, PROVINCE_MARK)[1]
    ).otherwise(country)


def clean_area(area: Column) -> Column:
    return F.when(F.trim(area) == LOCAL_MARK, LOCAL_AREA).otherwise(area)


def geohash8(longitude: Column, latitude: Column) -> Column:
    """Eight-character geohash; null for a missing or impossible coordinate.

    Each coordinate becomes a 20-bit cell number. Reading a number's binary digits as base 4 puts
    an empty bit between any two of its bits, so one shift and one sum interleave the two, and the
    40 bits are then written in base 32. Every step is a built-in with generated code.
    """
    lon, lat = longitude.cast("double"), latitude.cast("double")

    def cell(value: Column, span: int) -> Column:
        number = F.floor(value * 1048576 / span) + 524288
        return F.least(F.greatest(number, F.lit(0)), F.lit(1048575)).cast("bigint")

    def spread(value: Column) -> Column:
        return F.conv(F.bin(value), 4, 10).cast("bigint")

    bits = spread(cell(lon, 360)) * 2 + spread(cell(lat, 180))
    code = F.translate(F.conv(bits.cast("string"), 10, 32), BASE32_DIGITS, GEOHASH_ALPHABET)
    possible = lon.between(-180, 180) & lat.between(-90, 90)
    return F.when(possible, F.lpad(code, 8, "0"))


_REPLY = (
    "regeocode struct<addressComponent: struct<businessAreas: "
    "array<struct<location: string, name: string, id: string>>>>"
)


def districts_of_reply(reply: Column) -> Column:
    """District names of a geocoder reply, joined by commas; '' when there is none or it is broken.

    A district without a name shows as null; one that is not an object spoils the whole reply.
    """
    areas = F.from_json(reply, _REPLY)["regeocode"]["addressComponent"]["businessAreas"]
    names = F.array_join(areas["name"], ",", "null")
    return F.coalesce(F.when(~F.exists(areas, F.isnull), names), F.lit(""))
