"""Timestamp text <-> epoch milliseconds, and time bounds given by a user."""

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievelog.functions.text import strip_blank
from sievelog.schema import DAY_MS, TIMESTAMP_PATTERN

_FIRST_DAY = (dt.date.min - dt.date(1970, 1, 1)).days
_LAST_DAY = (dt.date.max - dt.date(1970, 1, 1)).days


def parse_epoch_or_null(text: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds, NULL where the text is not ``yyyy-MM-dd HH:mm:ss``.

    The text is read at offset zero and then placed in ``zone``: the zone of the session
    has no say.
    """
    stamp = F.concat(strip_blank(text), F.lit(" +0000"))
    parsed = F.try_to_timestamp(stamp, F.lit(f"{TIMESTAMP_PATTERN} xx"))
    return F.unix_millis(parsed if zone == "UTC" else F.to_utc_timestamp(parsed, zone))


def parse_timestamp(text: Column, zone: str = "UTC") -> Column:
    """:func:`parse_epoch_or_null` as TIMESTAMP."""
    return F.timestamp_millis(parse_epoch_or_null(text, zone))


def parse_epoch(text: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds, 0 where the text does not parse."""
    return F.coalesce(parse_epoch_or_null(text, zone), F.lit(0).cast("bigint"))


def format_epoch(epoch_ms: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds as text in ``zone``, whatever the session's; the milliseconds are dropped."""
    local = epoch_ms
    if zone != "UTC":
        local = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(epoch_ms), zone))
    day = F.date_from_unix_date(F.floor(local / F.lit(DAY_MS)).cast("int"))
    second = F.floor(F.pmod(local, F.lit(DAY_MS)) / F.lit(1000))
    parts = (F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
    clock = F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])
    return F.when(epoch_ms.isNotNull(), F.concat(day.cast("string"), F.lit(" "), clock))


def log_date(epoch_ms: Column) -> Column:
    """UTC day of a row, the partition column; out-of-calendar values go to the edge days."""
    day = F.floor(epoch_ms / F.lit(DAY_MS))
    clamped = F.greatest(F.least(day, F.lit(_LAST_DAY)), F.lit(_FIRST_DAY))
    return F.date_from_unix_date(clamped.cast("int"))


def day_of(epoch_ms: int) -> Column:
    """:func:`log_date` of a given time, as a constant."""
    day = max(_FIRST_DAY, min(_LAST_DAY, epoch_ms // DAY_MS))
    return day_literal((dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoformat())


def day_literal(day: str) -> Column:
    # Python dates before 1582 would pass through another calendar on their way.
    return F.lit(day).cast("date")


def bound_ms(text: str | int | None, zone: str = "UTC") -> int | None:
    """One user-given bound: a number, a timestamp text in ``zone``, or None if blank or unreadable."""
    if text is None or isinstance(text, int):
        return text
    text = text.strip()
    if re.fullmatch(r"[+-]?[0-9]+", text):
        value = int(text)
        if -(2**63) <= value < 2**63:
            return value
        return None
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}", text):
        return None
    try:
        parsed = dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=ZoneInfo(zone))
    except ValueError:
        return None
    # A parsed value of 0 counts as "could not parse", as it does for rows.
    return int(parsed.timestamp()) * 1000 or None


def resolve_bounds(start, end, default_start=None, default_end=None, zone: str = "UTC"):
    """Both bounds as milliseconds, falling back to the defaults, swapped if reversed."""
    lo, hi = bound_ms(start, zone), bound_ms(end, zone)
    lo = default_start if lo is None else lo
    hi = default_end if hi is None else hi
    if lo is not None and hi is not None and lo > hi:
        lo, hi = hi, lo
    return lo, hi
