"""Blank tests, splitting and number text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space, U+0000 to U+0020.
BLANKS = "".join(map(chr, range(0x21)))


def strip_blanks(text: Column) -> Column:
    """``text`` without leading and trailing characters up to U+0020."""
    return F.trim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for null and for text made of white space only; never null."""
    return F.coalesce(strip_blanks(text), F.lit("")) == ""


def not_blank(text: Column) -> Column:
    return ~is_blank(text)


def split_ids(text: Column) -> Column:
    """The ids of a ``|`` separated list, blank ones included."""
    return F.split(text, r"\|")


def split_line(line: Column, separator: str) -> Column:
    """Fields of a delimited line; trailing empty fields do not exist."""
    return F.split(F.rtrim(line, F.lit(separator)), re.escape(separator))


def split_words(line: Column) -> Column:
    """Words of a stripped line, split at spaces, each without surrounding white space.

    Control characters separate words only where they touch a space. Lines
    without two separators in a row, the usual ones, take the quick way.
    """
    irregular = line.rlike(r"[\x00-\x20][\x00-\x20]")
    return F.when(irregular, F.split(line, r"[\x00-\x1F]* [\x00-\x20]*")).otherwise(
        F.split(line, " ")
    )


def required_number(text: Column, kind: str) -> Column:
    """``text`` as an integer type; anything else fails the query."""
    digits = F.when(text.rlike("^[+-]?[0-9]+$"), text)
    return F.coalesce(
        digits.try_cast(kind),
        F.raise_error(F.concat(F.lit(f"not a {kind}: "), F.coalesce(text, F.lit("null")))).cast(kind),
    )


def plain_number(number: Column) -> Column:
    """A number as text, at most three decimals, without grouping or exponent."""
    rounded = F.bround(number.cast("decimal(38,9)"), 3).cast("decimal(38,3)").cast("string")
    return F.regexp_replace(rounded, r"\.?0+$", "")


def or_null_text(value: Column) -> Column:
    """The value as text, with nulls spelled out."""
    return F.coalesce(value.cast("string"), F.lit("null"))
