"""String helpers with the white-space rules of the logged data (Unicode aware)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space as str.strip() knows it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Line boundaries as str.splitlines() knows them.
LINE_BREAK = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def filled(value: Column) -> Column:
    """Missing becomes the empty string; any type becomes text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def clean(value: Column) -> Column:
    """Stripped text, never NULL."""
    return strip(filled(value))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def lines(value: Column) -> Column:
    return F.split(value, LINE_BREAK)


def joined_names(names: Column) -> Column:
    """Non-blank names, each once, in first-seen order."""
    return F.array_join(F.array_distinct(F.filter(names, lambda name: name != "")), "; ")
