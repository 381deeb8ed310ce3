"""Epoch numbers, timestamps and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewflow.spec import UNIT_NANOS, SpecError


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _floor_div(value: Column, size: int) -> Column:
    """Integer division rounding down, without a detour through double."""
    return F.call_function("div", value - F.pmod(value, F.lit(size)), F.lit(size)) if size > 1 else value


def epoch_to_ts(value: Column | str, unit: str) -> Column:
    """Epoch number in ``unit`` to a timestamp; nanoseconds lose what is below a microsecond."""
    value = _col(value).cast("long")
    if unit == "NANOSECONDS":
        return F.timestamp_micros(_floor_div(value, 1_000))
    if unit == "MICROSECONDS":
        return F.timestamp_micros(value)
    if unit == "MILLISECONDS":
        return F.timestamp_millis(value)
    if unit not in UNIT_NANOS:
        raise SpecError(f"unknown time unit {unit!r}")
    return F.timestamp_seconds(value * F.lit(UNIT_NANOS[unit] // UNIT_NANOS["SECONDS"]))


def ts_to_epoch(value: Column | str, unit: str) -> Column:
    """Timestamp to an epoch number in ``unit``, rounding down."""
    value = _col(value)
    if unit == "NANOSECONDS":
        return F.unix_micros(value) * F.lit(1_000)
    if unit == "MICROSECONDS":
        return F.unix_micros(value)
    if unit == "MILLISECONDS":
        return F.unix_millis(value)
    if unit not in UNIT_NANOS:
        raise SpecError(f"unknown time unit {unit!r}")
    return _floor_div(F.unix_seconds(value), UNIT_NANOS[unit] // UNIT_NANOS["SECONDS"])


def ntz_to_epoch(value: Column | str, unit: str = "MILLISECONDS") -> Column:
    """Timestamp without zone, read as UTC, to an epoch number; the session zone plays no part."""
    # The difference of two zoneless timestamps is exact; timestampdiff would cast both to the session zone.
    since = _col(value) - F.expr("timestamp_ntz'1970-01-01'")
    micros = (since.cast("interval second").cast("decimal(18,6)") * F.lit(1_000_000)).cast("long")
    if unit == "NANOSECONDS":
        return micros * F.lit(1_000)
    return _floor_div(micros, UNIT_NANOS[unit] // UNIT_NANOS["MICROSECONDS"])


def time_bucket(value: Column | str, width: int) -> Column:
    """Cut an epoch number down to a multiple of ``width``, towards zero."""
    value = _col(value)
    return value - value % F.lit(width)


def bucket_floor(value: Column | str, width: int) -> Column:
    """Start of the half-open bucket holding ``value``; all buckets, also before 1970, are equally wide."""
    value = _col(value)
    return value - F.pmod(value, F.lit(width))
