"""Scalar helpers for codes, terms, dates and member ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A map target holds a code and its term code side by side.
CODE_LENGTH = 5
TERM_CODE_LENGTH = 2


def strip_cr(text: Column) -> Column:
    """Remove carriage returns."""
    return F.replace(text, F.lit("\r"), F.lit(""))


def code_part(map_target: Column) -> Column:
    return F.substring(map_target, 1, CODE_LENGTH)


def term_code_part(map_target: Column) -> Column:
    return F.substring(map_target, CODE_LENGTH + 1, TERM_CODE_LENGTH)


def join_code(code: Column, term_code: Column) -> Column:
    """Map target from its parts; null where either part is null."""
    return F.concat(code, term_code)


def cast_code(number: Column) -> Column:
    """A numeric code in its text form."""
    return number.cast("string")


def first_non_empty(*texts: Column) -> Column:
    """The first text that is neither null nor blank, else the empty string.

    Trailing blanks do not make a text non-empty, yet the text that is chosen
    keeps them. The last text is the fallback as it stands.
    """
    *preferred, fallback = texts
    chosen = F.coalesce(fallback, F.lit(""))
    for text in reversed(preferred):
        chosen = F.when(F.rtrim(F.coalesce(text, F.lit(""))) != "", text).otherwise(chosen)
    return chosen


def rf2_date(day: Column) -> Column:
    """Dates as release files print them."""
    return F.date_format(day, "yyyyMMdd")


def member_uuid(*key: Column) -> Column:
    """A UUID that depends on the key alone.

    A digest of the key gives a recomputed task the id its first attempt gave,
    which a random id would not. The version and variant digits mark it as a
    name-based UUID.
    """
    texts = [F.coalesce(part.cast("string"), F.raise_error(F.lit("a member key has a null part"))) for part in key]
    # each part's length before it, so that no two keys read alike
    digest = F.md5(F.concat(*[x for text in texts for x in (F.length(text).cast("string"), F.lit(":"), text)]))
    # The 13th digit becomes the version, the 17th the variant.
    layout = "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$"
    return F.regexp_replace(digest, layout, "$1-$2-3$3-8$4-$5")
