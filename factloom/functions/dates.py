"""Column functions on dates.

All parsing uses ``try_*`` forms: ANSI mode is on, and untrusted text must
give null, never fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seendate_to_date(text) -> Column:
    """``yyyyMMddTHHmmssZ`` text to a DATE (null when malformed)."""
    return F.to_date(F.try_to_timestamp(_c(text), F.lit("yyyyMMdd'T'HHmmss'Z'")))


def iso_offset_wall_time(text) -> Column:
    """ISO time with offset; the offset is dropped without shifting.

    ``2024-03-01T10:00:00+03:00`` gives the local wall time 10:00.
    """
    t = _c(text)
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([+-]\d{2}:?\d{2}|Z)$")
    return F.when(ok, F.try_to_timestamp(F.substring(t, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def iso_offset_instant(text) -> Column:
    """D2 (compare form): the same text as a UTC instant, offset applied."""
    t = _c(text)
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                      F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")))


def lenient_timestamp(text) -> Column:
    """D3: parse a date/time text; on failure strip ``+00:00`` and retry; else null."""
    t = _c(text)
    stripped = F.replace(t, F.lit("+00:00"), F.lit(""))
    return F.coalesce(F.try_to_timestamp(t), F.try_to_timestamp(stripped))


def year_of(ts) -> Column:
    """D4."""
    return F.year(_c(ts))


def format_day(text) -> Column:
    """``M/d/yy`` first, else an ISO date/time, else null -> ``yyyy-MM-dd``.

    Two-digit years follow the POSIX rule (69-99 -> 19xx, 00-68 -> 20xx).
    """
    t = _c(text)
    mdy = t.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$")
    yy = F.split_part(t, F.lit("/"), F.lit(3)).try_cast("int")
    year = F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    from_mdy = F.try_to_date(
        F.concat_ws("-", year.cast("string"),
                    F.lpad(F.split_part(t, F.lit("/"), F.lit(1)), 2, "0"),
                    F.lpad(F.split_part(t, F.lit("/"), F.lit(2)), 2, "0")),
        "yyyy-MM-dd")
    iso_ok = t.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?([+-]\d{2}:?\d{2}|Z)?)?$")
    from_iso = F.when(iso_ok, F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))
    parsed = F.when(mdy, from_mdy).otherwise(from_iso)
    return F.date_format(parsed, "yyyy-MM-dd")


def format_key(ts, pattern: str) -> Column:
    """Format a timestamp as a key (``yyyyMMddHHmmss``, ``MMddyy`` ...)."""
    return F.date_format(_c(ts), pattern)


def parse_start(text) -> Column:
    """``yyyy-MM-dd`` start parameter to a UTC timestamp (null if bad)."""
    return F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd"))
