"""Time of day keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_second_of_day(time: Column, zone: str) -> Column:
    """Wall-clock second of day in ``zone``, whatever the session's time zone is."""
    micros = F.unix_micros(F.from_utc_timestamp(time, zone))
    return F.pmod(F.floor(micros / F.lit(1_000_000)), F.lit(86_400)).cast("int")


def second_bucket(second: Column, minutes: int | Column) -> Column:
    size = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return F.floor(second / (size * 60)).cast("int")


def bucket(time: Column, zone: str, minutes: int | Column) -> Column:
    """Number of the ``minutes``-long bucket of the local day."""
    return second_bucket(local_second_of_day(time, zone), minutes)
