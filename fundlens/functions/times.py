"""Time expressions; the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_ts(c) -> Column:
    """ISO-8601 text to timestamp; malformed text raises."""
    return F.to_timestamp(c)


def epoch_ms_ts(c) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds, cut toward zero."""
    ms = c.cast("bigint")
    return F.timestamp_millis(ms - ms % 1000)


def lenient_ts(c, *formats: str) -> Column:
    """Timestamp from ISO text or the first of ``formats`` that fits, else NULL."""
    return F.coalesce(F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def strict_ts(c, *formats: str) -> Column:
    """Like :func:`lenient_ts`, but text that fits nothing raises."""
    ts = lenient_ts(c, *formats)
    bad = c.isNotNull() & ts.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a timestamp: "), c)).cast("timestamp")).otherwise(ts)


def version_of(c, prefix: str = "chain_data_") -> Column:
    """Number after ``prefix``; NULL unless it has two or three digits."""
    name = F.when(c.like(prefix + "__") | c.like(prefix + "___"), c)
    return F.substring(name, len(prefix) + 1, 3).cast("int")


def now() -> Column:
    return F.current_timestamp()
