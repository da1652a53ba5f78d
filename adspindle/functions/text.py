"""Text rules shared by tags, places and history."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the log's producers understand it: the ASCII kinds and the Unicode spaces,
# but not the three no-break spaces.
NON_BLANK = r"[^\s\x1c-\x1f\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]"


def not_blank(text: Column) -> Column:
    """True when the text holds something other than white space; false for null."""
    return F.coalesce(text.rlike(NON_BLANK), F.lit(False))


def pieces(text: Column, comma: str = ",") -> Column:
    """Split on a single character; empty pieces at the end do not count.

    ``'a,,b,,'`` gives a, '', b; ``''`` gives one empty piece; only commas give none.
    """
    kept = F.regexp_replace(text, f"{comma}+$", "")
    none = F.array().cast("array<string>")
    return F.when((text != "") & (kept == ""), none).otherwise(F.split(kept, comma))


def client_label(client: Column) -> Column:
    return (
        F.when(client == 1, "IOS").when(client == 2, "android").when(client == 3, "wp").otherwise("other")
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def or_null_text(value: Column) -> Column:
    """A missing value shows as the word null inside a tag name."""
    return F.coalesce(value.cast("string"), F.lit("null"))
