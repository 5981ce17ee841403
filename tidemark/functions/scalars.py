"""Small scalar expressions used by reports, the publisher and the log views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column) -> Column:
    """``first + ' ' + last``; null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def trimmed_length(text: Column) -> Column:
    """Length that ignores trailing blanks."""
    return F.length(F.rtrim(text))


def short_id(text: Column, n: int = 8) -> Column:
    """First ``n`` characters of an id."""
    return F.substring(text, 1, n)


def numbered(prefix: str, number: Column, width: int = 3) -> Column:
    """``PREFIX-007`` style labels."""
    return F.format_string(f"{prefix}-%0{width}d", number)


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def preview(text: Column, n: int = 100) -> Column:
    """First ``n`` characters followed by ``...`` when there is more."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def signed_delta(quantity: Column, adjustment_type: Column) -> Column:
    """Negated for ``subtract`` exactly, else the raw quantity; null when the negation overflows."""
    return F.when(adjustment_type == "subtract", F.try_subtract(F.lit(0).cast("bigint"), quantity)).otherwise(quantity)
