"""Timestamp parsing that yields NULL for malformed text, under ANSI mode as well."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats found in the raw layer.
ISO_MILLIS_LENGTH = len("2017-10-02T10:56:33.000Z")
SPACED_LENGTH = len("2017-10-02 01:00:00 +0000")
SPACED_SUFFIX = " UTC"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso_millis(c: str | Column) -> Column:
    """``2017-10-02T10:56:33.000Z`` -> timestamp; any other shape -> NULL.

    The shape test lets the fast built-in cast do the parsing instead of a formatter.
    """
    c = _col(c)
    well_formed = (
        (F.length(c) == ISO_MILLIS_LENGTH)
        & (F.substring(c, 11, 1) == "T")
        & (F.substring(c, 20, 1) == ".")
        & c.endswith("Z")
    )
    return F.when(well_formed, c.try_cast("timestamp"))


def parse_weather_time(text: str | Column, epoch: str | Column | None = None) -> Column:
    """Parse the weather feed's date text; fall back to its epoch seconds if given.

    Accepts ``2017-10-02 01:00:00 +0000``, the same with a trailing `` UTC``, and ISO-8601.
    """
    text = _col(text)
    is_spaced = (F.substring(text, 20, 1) == " ") & (
        (F.length(text) == SPACED_LENGTH)
        | ((F.length(text) == SPACED_LENGTH + len(SPACED_SUFFIX)) & text.endswith(SPACED_SUFFIX))
    )
    # The offset as the cast expects it: +0000 -> +00:00.
    spaced = F.concat(
        F.substring(text, 1, 19),
        F.substring(text, 21, 3),
        F.lit(":"),
        F.substring(text, 24, 2),
    )
    is_iso = (F.substring(text, 11, 1) == "T") & text.endswith("Z")
    parsed = F.when(is_spaced, spaced.try_cast("timestamp")).when(
        is_iso, text.try_cast("timestamp")
    )
    if epoch is None:
        return parsed
    return F.coalesce(parsed, F.timestamp_seconds(_col(epoch)))


def date_key(c: str | Column) -> Column:
    """Calendar day as ``yyyyMMdd`` text."""
    return F.date_format(_col(c), "yyyyMMdd")
