"""Local times with the zone spelled out, so the session zone never matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONDON = "Europe/London"
# A leading day, month and year; then nothing, an hour, or an hour, a minute and
# whatever text. Anything but letters and digits may stand between the numbers.
_GAP = r"[^\p{L}\p{N}]"
EVENT_PATTERN = (
    rf"(?s)^([0-9]{{1,2}}){_GAP}+([0-9]{{1,2}}){_GAP}+([0-9]{{4}})"
    rf"(?:{_GAP}*|{_GAP}+([0-9]{{1,2}})(?:{_GAP}*|{_GAP}+([0-9]{{1,2}}).*))$"
)

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_MICROSECOND = "interval '0.000001' second"


def utc_clock(ts: Column) -> Column:
    """The UTC reading of an instant, as a timestamp without zone."""
    return F.expr(_EPOCH) + F.expr(_MICROSECOND) * F.unix_micros(ts)


def utc_date(ts: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def read_wall(text: Column) -> Column:
    """Event text as if it were UTC; NULL when it does not begin with a real date, or goes on
    with something that is no time of day. Without a time it is midnight."""
    usual = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit("d/M/yyyy H:mm X"))
    rest = F.regexp_replace(text, EVENT_PATTERN, "$1/$2/$3 0$4:0$5 Z")
    return F.coalesce(usual, F.try_to_timestamp(rest, F.lit("d/M/yyyy H:m X")))


def with_instant(df: DataFrame, wall: str, name: str, tz: str = LONDON) -> DataFrame:
    """Add the instant at which a clock in tz shows `wall` (as given by read_wall).

    An hour that occurs twice in autumn means its second, standard-time pass. The
    first pass is a column of its own so that each row is converted only twice.
    """
    first, wall_time = F.col("_first"), F.col(wall)
    second = first + F.expr("interval 1 hour")
    is_repeated = F.from_utc_timestamp(second, tz) == wall_time
    return (
        df.withColumn("_first", F.to_utc_timestamp(wall_time, tz))
        .withColumn(name, F.when(is_repeated, second).otherwise(first))
        .drop("_first")
    )


def stamp_text(ts: Column, local: Column) -> Column:
    """An instant as local text, e.g. 2023-10-10 08:00:00+01.

    `local` is from_utc_timestamp(ts, tz); best a column, as it is used repeatedly.
    """
    offset = F.unix_seconds(local) - F.unix_seconds(ts)
    minutes = (F.abs(offset) / 60).cast("int")
    hh = F.lpad((minutes / 60).cast("int").cast("string"), 2, "0")
    mm = F.when(minutes % 60 != 0, F.format_string(":%02d", minutes % 60)).otherwise("")
    sign = F.when(offset < 0, "-").otherwise("+")
    return F.concat(utc_clock(local).cast("string"), sign, hh, mm)
