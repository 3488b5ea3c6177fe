"""Periods of the week, weeks, and normalised times; all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Times below this count as seconds. As a time in milliseconds it lies in January
#: 1970, so modern times in seconds pass only if they precede May 2000.
SECONDS_LIMIT = 957139200


_DAY = 86_400_000


def to_ms(ts: str) -> Column:
    """Milliseconds of a column that holds wall-clock times in UTC (timestamp without zone)."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({ts} AS TIMESTAMP_NTZ))")


def wall_clock(time_ms: Column) -> Column:
    """The UTC wall clock, as a timestamp without zone; independent of the session's zone."""
    return F.timestamp_add("MILLISECOND", time_ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def parse_ms(text: Column) -> Column:
    """Milliseconds of an ISO 8601 time; UTC where it names no zone; null where it is none."""
    zoned = text.rlike(r"(Z|[+-]\d\d:?\d\d)$") & text.rlike(":")
    return F.unix_millis(F.try_to_timestamp(F.when(zoned, text).otherwise(F.concat(F.when(text.rlike(":"), text).otherwise(F.concat(text, F.lit(" 00:00:00"))), F.lit("Z")))))


def seconds_to_ms(time: Column) -> Column:
    return F.when(time < SECONDS_LIMIT, time.cast("long") * 1000).otherwise(time.cast("long"))


def robust_ms(time: Column) -> Column:
    """Seconds become milliseconds by magnitude: below 1e11 no trace is in milliseconds."""
    return F.when(time < 100_000_000_000, time.cast("long") * 1000).otherwise(time.cast("long"))


def _days(time_ms: Column) -> Column:
    return F.floor(time_ms / _DAY).cast("long")


def _weekday(time_ms: Column) -> Column:
    """0 for Monday; day 0 was a Thursday."""
    return F.pmod(_days(time_ms) + 3, F.lit(7))


def hour_of_week(time_ms: Column) -> Column:
    """0 for Monday 00:00 to 167 for Sunday 23:00."""
    return (_weekday(time_ms) * 24 + F.pmod(epoch_hour(time_ms), F.lit(24))).cast("int")


def day_of_month(time_ms: Column) -> Column:
    return F.dayofmonth(F.date_from_unix_date(_days(time_ms).cast("int")))


def week_start(time_ms: Column) -> Column:
    """The Monday of the week, as a date."""
    return F.date_from_unix_date((_days(time_ms) - _weekday(time_ms)).cast("int"))


def week_text(time_ms: Column) -> Column:
    return week_start(time_ms).cast("string")


def epoch_hour(time_ms: Column) -> Column:
    return F.floor(time_ms / 3_600_000).cast("long")
