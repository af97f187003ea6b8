"""Month strings to dates and back. A bad value becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanweft.functions.text import strip

MONTH_FORMAT = "MMM-yyyy"
# Formats tried after the month form, in this order.
FALLBACK_FORMATS = ("yyyy-MM-dd", "yyyy-MM", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss")


# Texts that a format can match at all, each as long as its format. The test is
# cheap, while the parser raises and catches an error for every text it cannot read.
SHAPES = {
    "MMM-yyyy": "^[A-Za-z]{3}-[0-9]{4}$",
    "yyyy-MM-dd": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "yyyy-MM": "^[0-9]{4}-[0-9]{2}$",
    "MM/dd/yyyy": "^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "yyyy-MM-dd HH:mm:ss": "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
}


def _parsed(column: Column, fmt: str) -> Column:
    # month names may come in any letter case
    text = F.initcap(column) if fmt == MONTH_FORMAT else column
    value = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
    if fmt not in SHAPES:
        return value
    return F.when((F.octet_length(column) == len(fmt)) & F.rlike(column, F.lit(SHAPES[fmt])), value)


def parse_month(column: Column, formats: Sequence[str] = (MONTH_FORMAT,)) -> Column:
    """First format that fits, as a date."""
    return F.coalesce(*[_parsed(column, fmt) for fmt in formats])


def parse_month_or_fallback(column: Column) -> Column:
    return parse_month(strip(column), (MONTH_FORMAT, *FALLBACK_FORMATS))


def month_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM")
