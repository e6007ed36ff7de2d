"""(seconds, nanoseconds) records to timestamps and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from slabwise.functions.coords import integer_div


def to_timestamp(seconds: Column, nanoseconds: Column) -> Column:
    """Instant of a (seconds, nanoseconds) record, in microseconds."""
    micros = seconds.cast("bigint") * 1_000_000 + integer_div(nanoseconds.cast("bigint"), 1000)
    return F.timestamp_micros(micros)


def to_wall_clock(seconds: Column, nanoseconds: Column) -> Column:
    """The same as a zone-less timestamp, whatever the session time zone."""
    days = integer_div(seconds.cast("bigint") - F.pmod(seconds.cast("bigint"), F.lit(86400)), 86400)
    of_day = F.pmod(seconds.cast("bigint"), F.lit(86400)).cast("int")
    micros = integer_div(nanoseconds.cast("bigint"), 1000)
    second = (of_day % 60).cast("decimal(8,6)") + (micros.cast("decimal(16,6)") / 1_000_000)
    midnight = F.date_from_unix_date(days.cast("int")).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(
        F.lit(0),
        integer_div(of_day, 3600).cast("int"),
        integer_div(of_day % 3600, 60).cast("int"),
        second.cast("decimal(18,6)"),
    )


def from_timestamp(ts: Column) -> tuple[Column, Column]:
    """Seconds and nanoseconds of an instant; nanoseconds are never negative."""
    return _split(F.unix_micros(ts))


def from_wall_clock(ts: Column) -> tuple[Column, Column]:
    """The same for a zone-less timestamp, whatever the session time zone."""
    of_day = F.hour(ts) * 3600 + F.minute(ts) * 60
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return _split((days * 86400 + of_day) * 1_000_000 + micros)


def _split(micros: Column) -> tuple[Column, Column]:
    fraction = F.pmod(micros, F.lit(1_000_000).cast("bigint"))
    return integer_div(micros - fraction, 1_000_000), fraction * 1000
