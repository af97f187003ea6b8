"""String expressions: trimming, comma lists, prefixes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """Trim every kind of whitespace; Spark's plain ``trim`` removes spaces only."""
    return F.btrim(column, F.lit(WHITESPACE))


def non_blank(column: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(strip(column), F.lit(""))


def parse_list(column: Column) -> Column:
    """Comma list to array: items trimmed, blanks dropped, NULL gives an empty array."""
    items = F.transform(F.split(F.coalesce(column, F.lit("")), ","), strip)
    return F.filter(items, lambda item: item != "")


def unknown_items(column: Column, allowed: Iterable[str]) -> Column:
    """Distinct items of a comma list that are not allowed, sorted."""
    allowed_array = F.array(*[F.lit(value) for value in sorted(allowed)])
    return F.array_sort(F.array_except(parse_list(column), allowed_array))


def has_repeated_items(column: Column) -> Column:
    items = parse_list(column)
    return F.size(items) != F.size(F.array_distinct(items))


def normalize_list(column: Column) -> Column:
    """Comma list with trimmed items in sorted order. Check it first with
    ``unknown_items`` and ``has_repeated_items``."""
    return F.array_join(F.array_sort(parse_list(column)), ",")


def starts_with_any(column: Column, prefixes: Iterable[str]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | F.startswith(column, F.lit(prefix))
    return found
