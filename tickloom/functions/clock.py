"""Instants, wall clocks and zones. The zone is always an argument or the session's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms that consumers of the tables rely on.
ISO_WITH_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"
PLAIN_SECONDS = "yyyy-MM-dd HH:mm:ss"


def iso_text(moment: Column) -> Column:
    """ISO text with the session zone's offset."""
    return F.date_format(moment, ISO_WITH_OFFSET)


def wall_clock(instant: Column, zone: str) -> Column:
    """The zone's wall clock (without zone) at an instant, whatever the session zone is."""
    return F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz"))


def instant_of(wall: Column, zone: str) -> Column:
    """The instant at which the zone's wall clock shows ``wall``."""
    return F.convert_timezone(F.lit(zone), F.current_timezone(), wall).cast("timestamp")


def local_text(instant: Column, zone: str) -> Column:
    return F.date_format(wall_clock(instant, zone), PLAIN_SECONDS)


def local_day(instant: Column, zone: str) -> Column:
    return wall_clock(instant, zone).cast("date")


def start_of_local_day(instant: Column, zone: str) -> Column:
    return instant_of(local_day(instant, zone).cast("timestamp_ntz"), zone)


def seconds_between(earlier: Column, later: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1_000_000)


def trade_instant(day: Column, clock: Column, zone: str) -> Column:
    """Instant of a trade from its own ``yyyyMMdd`` day and ``HHmmss`` clock; NULL if malformed."""
    joined = F.concat(day, clock)
    text = F.regexp_replace(joined, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6")
    return instant_of(text.try_cast("timestamp_ntz"), zone)
