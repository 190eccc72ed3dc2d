"""Timestamps from text (E6a-c, E7).

Texts come in ISO and day-first shapes. Bad text gives null, also under ANSI
mode; the result is a wall-clock ``timestamp_ntz`` built from the text's own
fields, so that it does not depend on the session time zone, not even for a
time that the zone skips. A text with a zone or offset of its own names an
instant: its wall-clock time is that of ``zone`` (UTC by default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ``None`` is Spark's default parser (ISO date and time, any fraction).
DEFAULT = None

# The format lists of the three consent sources. ISO formats all read as the
# default parser does (any fraction).
LAW_A_FORMATS = (DEFAULT, "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss.SSSSSS",
                 "yyyy-MM-dd HH:mm:ss", "dd/MM/yy hh:mm:ss a")
FORM_FORMATS = (DEFAULT, "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "dd/MM/yy hh:mm:ss a")
DAY_FIRST_FORMATS = ("dd/MM/yy hh:mm:ss,SSSSSSSSS a", "dd/MM/yy hh:mm:ss a", "yyyy-MM-dd HH:mm:ss", DEFAULT)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What Spark's own reader takes for these formats: the half-day mark in either case, one to nine
# digits where nine S stand, no second 60, nothing after the mark (``$`` would let a line end pass).
DAY_FIRST = r"^(\d{2})/(\d{2})/(\d{2}) (0[1-9]|1[0-2]):(\d{2}):([0-5]\d) ([AaPp])[Mm]\z"
DAY_FIRST_FRACTION = r"^(\d{2})/(\d{2})/(\d{2}) (0[1-9]|1[0-2]):(\d{2}):([0-5]\d),(\d{1,9}) ([AaPp])[Mm]\z"


def _day_first(text: Column, pattern: str, fraction: bool) -> Column:
    """Wall-clock time of a ``dd/MM/yy hh:mm:ss`` text; null for a day or time that isn't there."""
    def part(i: int) -> Column:
        return F.regexp_extract(text, pattern, i).try_cast("int")

    seconds = F.regexp_extract(text, pattern, 6)
    if fraction:
        seconds = F.concat(seconds, F.lit("."), F.left(F.regexp_extract(text, pattern, 7), F.lit(6)))
    half = F.upper(F.regexp_extract(text, pattern, 8 if fraction else 7))
    hour = part(4) % 12 + F.when(half == "P", 12).otherwise(0)
    return F.try_make_timestamp_ntz(F.lit(2000) + part(3), part(2), part(1), hour, part(5),
                                    seconds.try_cast("decimal(8,6)"))


# An ISO date and time with something after it that begins a zone: a letter or a sign.
ZONED = r"^\s*[+-]?\d{4,6}-\d{1,2}-\d{1,2}[ T]\d{1,2}(:\d{1,2}){0,2}(\.\d*)?\s*[A-Za-z+-]"
UTC = "UTC"


def _iso(text: Column, zone: str = UTC) -> Column:
    """What Spark's default parser reads; an instant becomes the wall-clock time of ``zone``."""
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(10,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=micros.cast("decimal(18,6)"))
    local = utc if zone == UTC else F.convert_timezone(F.lit(UTC), F.lit(zone), utc)
    return F.when(text.rlike(ZONED), local).otherwise(text.try_cast("timestamp_ntz"))


def parse_any(c, formats=LAW_A_FORMATS, zone: str = UTC) -> Column:
    """Wall-clock time of a text in one of the formats; null for any other text.

    No two kinds of format fit the same text (ISO texts begin with the year,
    the others with the day), so the text's shape picks the one parser to run:
    whatever is not day-first goes to the default parser. None of them passes
    through an instant of the session's time zone.
    """
    text = _c(c).cast("string")
    out = _iso(text, zone)
    if "dd/MM/yy hh:mm:ss a" in formats:
        out = F.when(text.rlike(DAY_FIRST), _day_first(text, DAY_FIRST, False)).otherwise(out)
    if any(f and "SSSSSSSSS" in f for f in formats):
        out = F.when(text.rlike(DAY_FIRST_FRACTION), _day_first(text, DAY_FIRST_FRACTION, True)).otherwise(out)
    return out


def as_timestamp(c, zone: str = UTC) -> Column:
    """Spark's default parser alone; null instead of an error for bad text."""
    return _iso(_c(c).cast("string"), zone)
