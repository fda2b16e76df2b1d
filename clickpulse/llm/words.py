"""Words between white space, as columns.

White space is the six characters space, tab, line feed, vertical tab, form feed and
carriage return, whatever the platform's own idea of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One character of a word, as a pattern.
WORD_CHAR = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    plain = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def word_count(text: Column) -> Column:
    """The number of words as a long; 0 for null."""
    return F.size(words(text)).cast("long")
