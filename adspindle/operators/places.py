"""From addresses to places, and from coordinates to business districts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspindle.functions.place import (
    UNKNOWN_AREA,
    UNKNOWN_COUNTRY,
    city,
    districts_of_reply,
    geohash8,
    ip_to_long,
    province,
)
from adspindle.functions.text import pieces
from adspindle.operators.filters import nonempty, with_location
from adspindle.operators.joins import (
    BROADCAST_BYTES,
    HOT_ROWS,
    content_bytes,
    hot_keys,
    lookup_join,
    measured,
    skew_join,
)
from adspindle.sources.workspace import Workspace

# Addresses are matched inside blocks of 2^16, dense blocks inside cells of 2^8. Ranges that don't
# overlap are cut at these borders, which adds at most one row per block or cell, however wide they are.
BLOCK_BITS, CELL_BITS = 16, 8
# A block with more ranges is dense, so no address is compared with more ranges than this.
DENSE_RANGES = 256
WHOLE_BLOCK = -1
# The log is so much wider than anything else that is joined that its ranges are broadcast up to this size.
RANGES_BYTES = 128 * 1024 * 1024

PLACE_FIELDS = ["country", "area", "longitude", "latitude"]


def _block(number: Column) -> Column:
    return F.shiftright(number, BLOCK_BITS)


def _cell(number: Column) -> Column:
    return F.shiftright(number, CELL_BITS).bitwiseAND(2 ** (BLOCK_BITS - CELL_BITS) - 1)


def separate_ranges(ranges: DataFrame) -> DataFrame:
    """The ranges without overlaps, as ``(low, high, ...)``: each ends before the next one starts.

    An address belongs to the range with the greatest start at or below it, if that reaches so far.
    Repeated ranges are one range, and of several with one start the widest stays. The next start is
    looked for within a block of addresses, and for a block's last range among the first starts of the
    later blocks, of which there are 65,536 at most.
    """
    start, end = F.col("ip_start"), F.col("ip_end")
    widest = F.max(F.struct(end.alias("high"), *PLACE_FIELDS)).alias("place")
    single = ranges.where(start <= end).groupBy(start.alias("low")).agg(widest)
    single = single.withColumn("block", _block(F.col("low")))
    firsts = single.groupBy("block").agg(F.min("low").alias("first"))
    later = firsts.select("block", F.lead("first").over(Window.orderBy("block")).alias("first_later"))
    inside = F.lead("low").over(Window.partitionBy("block").orderBy("low"))
    known = single.withColumn("next", inside).join(later, "block")
    last = F.least("place.high", F.coalesce("next", "first_later") - 1)
    return known.select("low", last.alias("high"), *[f"place.{f}" for f in PLACE_FIELDS])


def _cut(ranges: DataFrame, number, bits: int, name: str) -> DataFrame:
    """Ranges cut at multiples of ``2^bits``, with the number of their part in ``name``."""
    part = F.explode(F.sequence(F.shiftright("low", bits), F.shiftright("high", bits))).alias("__part")
    cut = ranges.select("*", part)
    first = F.shiftleft("__part", bits)
    return cut.withColumns(
        {
            "low": F.greatest("low", first),
            "high": F.least("high", first + (2**bits - 1)),
            name: number(F.shiftleft("__part", bits)),
        }
    ).drop("__part")


def block_ranges(ranges: DataFrame) -> DataFrame:
    """The separated ranges cut at block borders, and in dense blocks at cell borders.

    ``(block, cell, low, high, ...)``; the cell is -1 in a block that is not cut further.
    """
    blocks = _cut(separate_ranges(ranges), _block, BLOCK_BITS, "block")
    dense = blocks.groupBy("block").agg((F.count(F.lit(1)) > DENSE_RANGES).alias("__dense"))
    blocks = blocks.join(dense, "block")
    whole = blocks.where("NOT __dense").withColumn("cell", F.lit(WHOLE_BLOCK).cast("bigint"))
    cells = _cut(blocks.where("__dense"), _cell, CELL_BITS, "cell")
    columns = ["block", "cell", "low", "high", *PLACE_FIELDS]
    return whole.select(*columns).unionByName(cells.select(*columns))


def _places_by_merge(numbers: DataFrame, blocks: DataFrame) -> DataFrame:
    """One place per distinct address, by sorting addresses and range starts together per block.

    A block holds at most 65,536 addresses and as many starts, so no group grows with the log.
    """
    place = F.struct("high", *PLACE_FIELDS)
    # Cells need no place in the order: they only cut ranges of the same block further.
    starts = blocks.select("block", F.col("low").alias("at"), place.alias("place"))
    asked = numbers.select(_block(F.col("__ip")).alias("block"), F.col("__ip").alias("at"))
    events = starts.withColumn("asked", F.lit(False)).unionByName(
        asked.withColumn("asked", F.lit(True)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy("block")
        .orderBy("at", "asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.last("place", ignorenulls=True).over(so_far)
    found = events.withColumn("found", last).where("asked AND at <= found.high")
    return found.select(F.col("at").alias("__ip"), *[f"found.{f}" for f in PLACE_FIELDS])


def ip_range_join(
    df: DataFrame,
    ranges: DataFrame,
    ip: str = "ip",
    limit: int = RANGES_BYTES,
    min_rows: int = HOT_ROWS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Left join to the range that holds each address; every row of ``df`` is kept once.

    A valid address outside all ranges gets the texts for unknown places; a missing or malformed
    one gets nulls. The cut range table is written once. While it is within the size limit the log is
    not shuffled at all, and a row is compared with the ranges of its block or, in a dense block, of
    its cell: 256 at most. Beyond the limit only the distinct addresses are shuffled, and the answer
    is joined back with the hot addresses spread.
    """
    workspace = workspace or Workspace(df.sparkSession, "ranges")
    cut = block_ranges(ranges)
    in_cells = F.count_if(F.col("cell") != WHOLE_BLOCK)
    blocks, seen = workspace.save(cut, "blocks", content=F.sum(content_bytes(cut)), in_cells=in_cells)
    asked = df.withColumn("__ip", ip_to_long(F.col(ip)))
    if (seen.get("content") or 0) <= limit:
        cell = F.lit(WHOLE_BLOCK)
        if seen.get("in_cells"):
            # 65,536 blocks at most.
            dense = blocks.where(F.col("cell") != WHOLE_BLOCK).select(F.col("block").alias("__dense")).distinct()
            asked = asked.join(F.broadcast(dense), _block(F.col("__ip")) == F.col("__dense"), "left")
            cell = F.when(F.col("__dense").isNull(), cell).otherwise(_cell(F.col("__ip")))
        asked = asked.withColumn("__cell", cell.cast("bigint")).drop("__dense")
        inside = (_block(F.col("__ip")) == F.col("block")) & (F.col("__cell") == F.col("cell"))
        inside = inside & F.col("__ip").between(F.col("low"), F.col("high"))
        joined = asked.join(F.broadcast(blocks), inside, "left").drop("block", "cell", "low", "high", "__cell")
    else:
        numbers = asked.select("__ip").where("__ip is not null").distinct()
        places = _places_by_merge(numbers, blocks)
        joined = skew_join(asked, places, "__ip", hot_keys(asked, "__ip", min_rows))
    valid = F.col("__ip").isNotNull()
    return joined.withColumns(
        {
            "country": F.coalesce("country", F.when(valid, UNKNOWN_COUNTRY)),
            "area": F.coalesce("area", F.when(valid, UNKNOWN_AREA)),
        }
    ).drop("__ip")


def ip_geo_enrich(
    log: DataFrame, ranges: DataFrame, limit: int = RANGES_BYTES, workspace: Workspace | None = None
) -> DataFrame:
    """The log with ``longitude, latitude, region, city`` looked up, one row out per row in."""
    placed = ip_range_join(log, ranges, "ip", limit, workspace=workspace)
    return placed.withColumns(
        {
            "longitude": F.col("longitude").cast("float"),
            "latitude": F.col("latitude").cast("float"),
            "region": province(F.col("country")),
            "city": city(F.col("country")),
        }
    ).drop("country", "area")


def distinct_locations(ods: DataFrame) -> DataFrame:
    return with_location(ods.select("longitude", "latitude")).distinct()


def one_row_per_geohash(districts: DataFrame) -> DataFrame:
    """All district names of a geohash cell in one comma list, each once, in order."""
    names = districts.select("geohash", F.explode_outer(pieces(F.col("areas"))).alias("name"))
    names = names.where("name IS NOT NULL").distinct()
    listed = F.array_join(F.array_sort(F.collect_list("name")), ",")
    return names.groupBy("geohash").agg(listed.alias("areas"))


def distinct_districts(replies: DataFrame) -> DataFrame:
    """Distinct ``(geohash, areas)`` of a table of geocoder replies, empty answers dropped.

    The generator keeps the optimizer from reading replies out once more in a filter next to the scan, before
    they are distinct and dealt to all tasks.
    """
    named = replies.select(
        geohash8(F.col("longitude"), F.col("latitude")).alias("geohash"),
        F.explode_outer(F.array(districts_of_reply(F.col("response")))).alias("areas"),
    )
    return nonempty(named, "areas").where("geohash is not null").distinct()


def build_district_dictionary(ods: DataFrame, replies: DataFrame) -> DataFrame:
    """``(geohash, areas)`` for the places in the log, from a table ``(longitude, latitude, response)``."""
    asked = replies.select(
        F.col("longitude").cast("float"), F.col("latitude").cast("float"), "response"
    ).distinct()
    answered = asked.join(distinct_locations(ods), ["longitude", "latitude"], "left_semi")
    return one_row_per_geohash(distinct_districts(answered))


@dataclass(frozen=True)
class Districts:
    """A dictionary ``(geohash, areas)``, and the locations ``(longitude, latitude)`` whose replies are in it."""

    dictionary: DataFrame
    locations: DataFrame


def extend_district_dictionary(
    stored: Districts | None, ods: DataFrame, replies: DataFrame, workspace: Workspace, limit: int = BROADCAST_BYTES
) -> Districts:
    """The stored dictionary and what the replies say about locations of the log that it doesn't know yet.

    Only replies of new locations are read out, and only cells that these lie in are put together anew. After any
    number of days this is the dictionary of all their locations. A location whose reply names nothing, or that has
    none, stays unknown and is asked about again.
    """
    locations = distinct_locations(ods)
    if stored is not None:
        locations = locations.join(stored.locations, ["longitude", "latitude"], "left_anti")
    fresh, size = measured(locations, workspace, "new-locations")
    asked = replies.select(F.col("longitude").cast("float"), F.col("latitude").cast("float"), "response")
    asked = asked.join(F.broadcast(fresh) if size <= limit else fresh, ["longitude", "latitude"], "left_semi")
    named = asked.distinct().select(
        "longitude", "latitude",
        geohash8(F.col("longitude"), F.col("latitude")).alias("geohash"),
        districts_of_reply(F.col("response")).alias("areas"),
    )
    named, size = measured(nonempty(named, "areas").where("geohash is not null"), workspace, "new-districts")
    known = named.select("longitude", "latitude").distinct()
    if stored is None:
        return Districts(one_row_per_geohash(named), known)
    cells = named.select("geohash").distinct()
    cells = F.broadcast(cells) if size <= limit else cells
    met = stored.dictionary.join(cells, "geohash", "left_semi")
    changed = one_row_per_geohash(met.select("geohash", "areas").unionByName(named.select("geohash", "areas")))
    kept = stored.dictionary.join(cells, "geohash", "left_anti").select("geohash", "areas")
    return Districts(kept.unionByName(changed), stored.locations.unionByName(known))


def geohash_district_join(
    df: DataFrame, districts: DataFrame, limit: int = BROADCAST_BYTES, **options
) -> DataFrame:
    """Add ``areas`` for the cell of each row's coordinates; ``districts`` has one row per cell."""
    celled = df.withColumn("geohash", geohash8(F.col("longitude"), F.col("latitude")))
    found = lookup_join(celled, districts.select("geohash", "areas"), "geohash", "left", limit, **options)
    return found.drop("geohash")
