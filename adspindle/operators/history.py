"""Yesterday's tags: their text form, and their decay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.functions.text import not_blank, pieces

ARROW = " -> "
DECAY = 0.9


def _weight_of(piece: Column) -> Column:
    return F.substring_index(piece, ARROW, -1).try_cast("double")


def _read_pieces(text: Column) -> Column:
    def entry(piece: Column, position: Column) -> Column:
        return F.struct(
            F.substring_index(piece, ARROW, 1).alias("tag"),
            position.alias("position"),
            _weight_of(piece).alias("weight"),
        )

    return F.transform(pieces(text), entry)


def parse_tag_string(text: Column) -> Column:
    """``'a -> 1.0,b -> 2.0'`` as an array of ``(tag, weight)``, sorted by tag, each tag once.

    The last of a repeated tag wins. Pieces whose weight is not a number are left out; see
    ``bad_pieces``.
    """

    def last_of_each(entries: Column) -> Column:
        end = F.size(entries) - 1

        def is_last(entry: Column, i: Column) -> Column:
            return (i == end) | (entries[F.least(i + 1, end)]["tag"] != entry["tag"])

        return F.filter(entries, is_last)

    readable = F.filter(_read_pieces(text), lambda e: e["weight"].isNotNull())
    # Binding the sorted array to a lambda variable evaluates the sort once per row.
    kept = F.transform(F.array(F.array_sort(readable)), last_of_each)[0]
    return F.transform(
        kept, lambda e: F.struct(e["tag"].alias("tag"), e["weight"].alias("weight"))
    )


def parse_tag_map(text: Column) -> Column:
    return F.map_from_entries(parse_tag_string(text))


def bad_pieces(text: Column) -> Column:
    """How many pieces of the text hold no readable weight."""
    return F.size(F.filter(pieces(text), lambda piece: _weight_of(piece).isNull()))


def weight_text(weight: Column, digits: int | None = None) -> Column:
    return (weight if digits is None else F.round(weight, digits)).cast("string")


def format_tag_string(entries: Column, digits: int | None = None) -> Column:
    """An array of ``(tag, weight)`` as text, sorted by tag."""
    return F.array_join(
        F.transform(
            F.sort_array(entries),
            lambda e: F.concat(e["tag"], F.lit(ARROW), weight_text(e["weight"], digits)),
        ),
        ",",
    )


def format_tag_map(tags: Column, digits: int | None = None) -> Column:
    entries = F.transform(
        F.map_entries(tags), lambda e: F.struct(e["key"].alias("tag"), e["value"].alias("weight"))
    )
    return format_tag_string(entries, digits)


def format_ids(ids: Column) -> Column:
    return F.array_join(ids, ",")


def read_ids(text: Column) -> Column:
    """The identifiers of a comma list that are not blank."""
    listed = F.filter(pieces(text), not_blank)
    return F.coalesce(listed, F.array().cast("array<string>"))


def import_profiles(profiles: DataFrame, allow_bad: bool = False) -> tuple[DataFrame, DataFrame]:
    """Profiles in text form, ``(userid, allUserId, tags)``, as ``(userid, tag, weight)`` and ``(userid, id)``.

    Fails if a text holds a piece that cannot be read, unless the caller allows such pieces to be left
    out. The stored user is one of its own identifiers.
    """
    known = profiles.where(not_blank(F.col("userid")))
    if not allow_bad and not known.where(bad_pieces(F.col("tags")) > 0).isEmpty():
        raise ValueError("some profile texts hold pieces without a readable weight")
    tags = text_rows(known)
    ids = known.select("userid", F.explode(F.array_union(F.array("userid"), read_ids(F.col("allUserId")))).alias("id"))
    return tags, ids


def text_rows(profiles: DataFrame) -> DataFrame:
    """``(userid, tag, weight)`` of profiles whose ``tags`` are texts."""
    return profiles.select("userid", F.inline_outer(parse_tag_string(F.col("tags")))).where("tag IS NOT NULL")


AS_OF = "as_of"


def weights_on(tags: DataFrame, day: Column, factor: float = DECAY) -> DataFrame:
    """Tag rows whose weights belong to the day ``as_of``, as they are on ``day``: decayed once for each day since."""
    days = F.datediff(day, F.col(AS_OF))
    return tags.withColumn("weight", F.col("weight") * F.pow(F.lit(factor), days)).drop(AS_OF)


def decay_tags(tags: DataFrame, factor: float = DECAY) -> DataFrame:
    return tags.withColumn("weight", F.col("weight") * F.lit(factor))
