"""Zone-less UTC times, local times and ingestion stamps."""

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# Fixed values.
LOCAL_ZONE = "Europe/Vienna"
DISPLAY_FORMAT = "yyyy-MM-dd HH:mm"


def _epoch():
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def utc_wall_clock(df, column):
    """The column as a zone-less UTC time, right under any session zone."""
    value = df[column]
    if isinstance(df.schema[column].dataType, TimestampType):
        seconds = (F.unix_micros(value).cast("decimal(18, 0)") / 1_000_000).cast("decimal(18, 6)")
        return _epoch() + F.make_dt_interval(secs=seconds)
    return value.cast("timestamp_ntz")


def utc_instant(df, column):
    """The column as an instant; a zone-less time is taken as UTC under any session zone."""
    value = df[column]
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        seconds = (value - _epoch()).cast("interval second").cast("decimal(20, 6)")
        return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))
    return value.cast("timestamp")


def utc_date(instant):
    """The UTC date of an instant under any session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def local_time(utc, zone=LOCAL_ZONE):
    """A zone-less UTC time as zone-less local time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_time_text(utc, zone=LOCAL_ZONE, pattern=DISPLAY_FORMAT):
    """Local time as text. Patterns other than the default are formatted in the session's
    zone, which should be UTC: elsewhere a local time may not exist."""
    local = local_time(utc, zone)
    if pattern == DISPLAY_FORMAT:
        return F.substring(local.cast("string"), 1, len(DISPLAY_FORMAT))
    return F.date_format(local, pattern)


def stamp(fetched_at, sequence):
    """Ingestion time of a row: its fetch time plus one microsecond per preceding row.

    Later rows of a fetch get later stamps, and a fetch read twice gives the same stamps,
    so a replayed row is recognisable. ``fetched_at`` may be ``current_timestamp()``.
    """
    return F.timestamp_micros(F.unix_micros(fetched_at) + sequence)
