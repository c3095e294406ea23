"""Event times: lenient parsing, day formatting, tumbling buckets."""

from datetime import timedelta

from pyspark.sql import functions as F

from clicksieve.record import DAY_PATTERN

# What counts as a readable time at the start of the text: year, month, day, hour, minute, second.
PLAIN_TIME = r"^(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})(?!\d)"
TIME_PREFIX = r"^[ \t]*(\d{4})-[ \t]*(\d{1,4})-[ \t]*(\d{1,4}) [ \t]*(\d{1,6}):[ \t]*(\d{1,6}):[ \t]*(\d{1,6})"

_UNITS = {
    "microsecond": timedelta(microseconds=1),
    "millisecond": timedelta(milliseconds=1),
    "second": timedelta(seconds=1),
    "minute": timedelta(minutes=1),
    "hour": timedelta(hours=1),
    "day": timedelta(days=1),
    "week": timedelta(weeks=1),
}


def duration_micros(duration):
    """Microseconds in a duration such as ``"30 seconds"``."""
    number, unit = duration.split()
    micros = int(number) * (_UNITS[unit.lower().removesuffix("s")] // timedelta(microseconds=1))
    if micros <= 0:
        raise ValueError(f"not a positive duration: {duration!r}")
    return micros


def readable_time(text, source_tz="UTC"):
    """The time a text starts with, to the second; NULL if it starts with none.

    The fraction and any offset after the seconds are ignored, the rest is
    wall-clock time in ``source_tz``. Parts out of range roll over: month 13 is
    the next January, 30 February is in March, 24:00 is the next day. Blanks
    before a part do not matter. Expects a UTC session.
    """
    # regexp_extract gives '' without a match, and try_cast turns that into NULL. Nearly all times are in range.
    plain = F.regexp_extract(text, PLAIN_TIME, 1).try_cast("timestamp")
    year, month, day_, hour, minute, second = [
        F.regexp_extract(text, TIME_PREFIX, part).try_cast("int") for part in range(1, 7)
    ]
    # The month is counted from the start of the year, so that the day of the month is kept for what follows.
    midnight = F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day_ - 1)
    seconds = F.unix_seconds(midnight.cast("timestamp")) + (hour * 60 + minute).cast("long") * 60 + second
    parsed = F.coalesce(plain, F.timestamp_seconds(seconds))
    return parsed if source_tz == "UTC" else F.to_utc_timestamp(parsed, source_tz)


def lenient_timestamp(text, source_tz="UTC"):
    """As :func:`readable_time`, with the epoch for text that holds no time."""
    return F.coalesce(readable_time(text, source_tz), F.timestamp_seconds(F.lit(0)))


def day(ts, pattern=DAY_PATTERN, tz="UTC"):
    """A timestamp formatted as a day (or other bucket) in a named zone."""
    return F.date_format(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz), pattern)


def day_of_millis(millis, pattern=DAY_PATTERN, tz="UTC"):
    """The same from epoch milliseconds."""
    return day(F.timestamp_millis(millis), pattern, tz)


def bucket_start(ts, width):
    """Start, in epoch microseconds, of the tumbling bucket that holds ``ts``."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(duration_micros(width)))


def window_start(ts, width):
    """Start of the tumbling event-time window that holds ``ts``.

    Rows without a time are in no window, so the start is never NULL. It is
    declared so: a later join then adds no filter for it, which would keep
    two uses of one aggregate from sharing its shuffle.
    """
    return F.coalesce(F.window(ts, width)["start"], F.timestamp_seconds(F.lit(0)))
