"""Small column helpers on ids and event-time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The producer writes event time as ``YYYY-MM-DD HH:MM:SS[.ffffff]``.
EVENT_TS_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss")


def short_label(c: Column, n: int = 8) -> Column:
    """H9: the first ``n`` characters of an id, for display only."""
    return F.substring(c, 1, n)


def event_ts(c: Column) -> Column:
    """Event-time text parsed to a timestamp; null when it does not
    parse (instead of an ANSI error)."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in EVENT_TS_FORMATS]).cast("timestamp_ntz")


def ts_text(c: Column) -> Column:
    """A timestamp as event-time text."""
    return c.cast("string")
