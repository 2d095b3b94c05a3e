"""Date and time text to timestamps.

All results are ``timestamp_ntz`` (wall clock, no zone) so they do not move
with the session zone or on clock-change days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{1,6}$"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def hhmmss_text(time_col: Column | str) -> Column:
    """``HHMMSS`` text with lost leading zeros restored: '500' -> '000500',
    '143200.0' -> '143200'. Anything but 1-6 digits gives null."""
    t = F.regexp_replace(F.trim(_text(time_col)), r"\.0+$", "")
    return F.when(t.rlike(_TIME), F.lpad(t, 6, "0"))


def clock_text(time_col: Column | str) -> Column:
    """'HH:mm:ss' from ``HHMMSS`` text (null when not 1-6 digits)."""
    return F.regexp_replace(hhmmss_text(time_col), r"^(\d{2})(\d{2})(\d{2})$", "$1:$2:$3")


def date_time_to_timestamp(date_col: Column | str, time_col: Column | str) -> Column:
    """``YYYY-MM-DD`` + ``HHMMSS`` -> timestamp_ntz; invalid -> null."""
    d = F.trim(_text(date_col))
    text = F.when(d.rlike(_DATE), F.concat(d, F.lit(" "), clock_text(time_col)))
    return text.try_cast("timestamp_ntz")


def hhmmss_epoch(time_col: Column | str, on_day) -> Column:
    """Seconds since the epoch of ``HHMMSS`` on ``on_day``, reading the
    wall clock as UTC whatever the session zone (no zone conversion)."""
    day = on_day.isoformat() if isinstance(on_day, (_dt.date, _dt.datetime)) else str(on_day)
    ts = date_time_to_timestamp(F.lit(day[:10]), time_col)
    return (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600
            + F.minute(ts) * 60 + F.second(ts))


def iso_wallclock(text: Column | str) -> Column:
    """ISO-8601 text with offset -> its wall clock as timestamp_ntz.

    The fraction is removed and the offset dropped, not applied; junk -> null.
    """
    t = F.regexp_replace(F.trim(_text(text)), r"\.\d+", "")
    return t.try_cast("timestamp_ntz")
