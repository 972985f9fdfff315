"""Column-level scalar helpers.

Every helper returns a built-in Spark ``Column`` expression, so it stays inside
whole-stage codegen; there is no Python UDF anywhere in the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zip-code prefixes are five characters wide.
ZIP_WIDTH = 5


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col: Column | str) -> Column:
    """``lower(trim(x))``: case-folded label with outer spaces removed.

    Like Spark's ``trim``, only space characters are stripped; tabs and
    newlines stay.
    """
    return F.lower(F.trim(_c(col)))


def strip_spaces(col: Column | str) -> Column:
    """``trim(x)``: outer spaces removed, case kept (free text)."""
    return F.trim(_c(col))


def to_double(col: Column | str) -> Column:
    """Strict numeric cast: under ANSI mode malformed text raises."""
    return _c(col).cast("double")


def safe_int(col: Column | str) -> Column:
    """Null-on-failure integer cast: ``' 7 '`` -> 7, ``'1.5'`` / ``'abc'`` -> NULL."""
    return _c(col).try_cast("int")


def wall_clock_ts(col: Column | str) -> Column:
    """Timestamp without time zone.

    Source files carry local wall-clock times with no zone, so they are kept as
    ``TIMESTAMP_NTZ``: dates derived from them do not move with the session time
    zone. Text input is parsed with the default formats and raises on malformed
    values under ANSI mode; timestamp input passes through.
    """
    return F.to_timestamp_ntz(_c(col))


def calendar_day(col: Column | str) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_c(col))


def delivery_days(delivered: Column | str, created: Column | str) -> Column:
    """Whole calendar days from ``created`` to ``delivered``.

    23:59 -> 00:01 next day counts as 1; NULL while undelivered; negative when
    the delivery precedes the purchase.
    """
    return F.datediff(_c(delivered), _c(created))


def equals_flag(col: Column | str, value: str) -> Column:
    """Never-NULL boolean ``col == value`` (a NULL input gives False)."""
    return F.when(_c(col) == F.lit(value), F.lit(True)).otherwise(F.lit(False))


def line_total(price: Column | str, freight: Column | str) -> Column:
    """Item price plus freight (NULL when either part is NULL)."""
    return _c(price) + _c(freight)


def zip_key(col: Column | str) -> Column:
    """Join key for zip-code prefixes.

    Digits are trimmed, and left-padded with zeros to ``ZIP_WIDTH`` so that a
    file that lost its leading zeros (``1151``) meets one that kept them
    (``01151``). Longer numbers are left as they are rather than cut; a blank or
    anything but digits stays as it is, so a blank meets only an equal blank.
    """
    raw = _c(col).cast("string")
    text = F.trim(raw)
    return F.when(text.rlike(r"^[0-9]+\z"), F.lpad(text, F.greatest(F.length(text), F.lit(ZIP_WIDTH)), F.lit("0"))).otherwise(raw)


__all__ = [
    "ZIP_WIDTH",
    "clean_text",
    "strip_spaces",
    "to_double",
    "safe_int",
    "wall_clock_ts",
    "calendar_day",
    "delivery_days",
    "equals_flag",
    "line_total",
    "zip_key",
]
