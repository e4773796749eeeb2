"""Column helpers: text, checked numbers, and temporal derivations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U32 = (1 << 32) - 1

# The zone abbreviations that controller logs may hold.
EASTERN = {"EDT": "-0400", "EST": "-0500"}


def trim_ws(c: Column) -> Column:
    """Without white space, of any script, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def to_int(c: Column, most: int | None = None) -> Column:
    """A whole number from digits (a sign may lead), or null: other text, or beyond ``most`` or 64 bits."""
    n = F.when(c.rlike(r"^[+-]?[0-9]+$"), c).try_cast("bigint")
    return n if most is None else F.when(n.between(0, most), n)


def to_float(c: Column) -> Column:
    """A number, or null where the text is none."""
    return F.when(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), c).try_cast("double")


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def strip_suffix(c: Column, suffix: str) -> Column:
    return F.when(c.endswith(suffix), F.left(c, F.length(c) - len(suffix))).otherwise(c)


def zero_hex(c: Column, width: int = 16) -> Column:
    """Upper-case hexadecimal digits, filled up with zeros."""
    return F.lpad(F.hex(c), width, "0")


def truncated(c: Column) -> Column:
    """The whole part of a double."""
    return c.cast("double").try_cast("bigint")


def parse_iso(c: Column) -> Column:
    """The instant of an ISO time with milliseconds and an offset such as -0400; null where it is none."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSxx"))


def parse_sadf(c: Column) -> Column:
    """The first date and time in the text, as UTC; null where there is none, which fails a load export."""
    found = F.regexp_extract(c, r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", 0)
    return F.concat(F.nullif(found, F.lit("")), F.lit("Z")).try_cast("timestamp")


def zone_offset(zone: Column, zones: dict[str, str] | None = None) -> Column:
    """The offset of a known abbreviation, null for any other; the zone database isn't asked."""
    known = F.lit(None).cast("string")
    for name, offset in (zones or EASTERN).items():
        known = F.when(zone == name, F.lit(offset)).otherwise(known)
    return known


def parse_offset(month: Column, day: Column, time: Column, offset: Column, year: Column, weekday: Column | None = None) -> Column:
    """The instant of a log's parts; null for a time that isn't one, and for a weekday that the date doesn't have."""
    parsed = F.try_to_timestamp(F.concat_ws(" ", month, F.lpad(day, 2, "0"), time, offset, year), F.lit("MMM dd HH:mm:ss xx yyyy"))
    if weekday is not None:
        date = F.try_to_timestamp(F.concat_ws(" ", month, F.lpad(day, 2, "0"), year), F.lit("MMM dd yyyy"))
        parsed = F.when(F.date_format(date, "EEE") == weekday, parsed)
    return F.when(offset.isNotNull(), parsed)


def parse_zoned(month: Column, day: Column, time: Column, zone: Column, year: Column, weekday: Column | None = None) -> Column:
    """As ``parse_offset`` with a zone's abbreviation; null for an unknown zone."""
    return parse_offset(month, day, time, zone_offset(zone), year, weekday)


def from_epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c)


def from_epoch_ns(c: Column) -> Column:
    """The instant to the microsecond; keep the number itself beside it."""
    return F.timestamp_micros(F.floor(c / F.lit(1000).cast("decimal(20,0)")).cast("bigint"))


def minus_ms(ts: Column, ms: Column) -> Column:
    """``ts`` to the millisecond, less the whole milliseconds of ``ms``."""
    return F.timestamp_millis(F.unix_millis(ts) - truncated(ms))


def to_micros(c: Column, scale: float) -> Column:
    """A number of milliseconds (scale 1e3) or seconds (1e6) as whole microseconds."""
    return truncated(c * F.lit(float(scale)))


def unsigned_diff(a: Column, b: Column) -> Column:
    """a - b, null where it is below zero."""
    return F.when(a >= b, a - b)
