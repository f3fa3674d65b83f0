"""Column expressions: zero-filled measures, time differences, payload size, rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MILLI = 1_000.0


def or_zero(value: Column) -> Column:
    """``COALESCE(value, 0)``."""
    return F.coalesce(value, F.lit(0))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; zone-less timestamps are read in the session zone."""
    return F.unix_micros(ts.cast("timestamp"))


def to_micros(seconds: float) -> int:
    return round(seconds * MICROS_PER_SECOND)


def slot_of(us: Column, width_us: int) -> Column:
    """Number of the ``width_us`` wide slot holding ``us``; exact, also before 1970."""
    width = F.lit(width_us).cast("bigint")
    return F.call_function("div", us - F.pmod(us, width), width)


def micros_to_ms(us: Column) -> Column:
    return us.cast("double") / F.lit(MICROS_PER_MILLI)


def payload_bytes(payload: Column) -> Column:
    """UTF-8 length of a payload as received."""
    return F.octet_length(payload)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 when ``whole`` is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole) * F.lit(100.0), F.lit(0.0))
