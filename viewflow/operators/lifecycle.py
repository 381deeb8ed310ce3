"""Retention, age tiers, the move from realtime to offline, and reading both as one.

``as_of`` is always given (epoch number in the table's unit, datetime or ISO text), never the clock.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewflow.functions.epoch import bucket_floor
from viewflow.operators.layout import BUCKET
from viewflow.spec import UNIT_NANOS, SpecError, TableSpec, Tier

Moment = datetime | str | int


def retention_start(spec: TableSpec, as_of: Moment) -> int:
    return spec.epoch(as_of) - spec.period(spec.retention)


def _moment(df: DataFrame, source: str, spec: TableSpec, epoch: int) -> Column:
    """An epoch number as a literal of a timestamp column's own type: a comparison with it reaches the scan."""
    nanos = epoch * UNIT_NANOS[spec.time_unit]
    at = (datetime(1970, 1, 1) + timedelta(microseconds=-(-nanos // 1000))).isoformat(" ")
    kind = df.schema[source].dataType.simpleString()
    return F.expr(f"timestamp_ntz'{at}'" if kind == "timestamp_ntz" else f"timestamp'{at}+00:00'")


def _since(df: DataFrame, spec: TableSpec, start: int, source: str | None = None) -> DataFrame:
    """Rows from ``start`` on: a comparison that reaches the scan, and on a stored table its folders.

    ``source`` names the timestamp that the time column was computed from, if it was: cut by that too.
    """
    kept = df.where(F.col(source) >= _moment(df, source, spec, start)) if source else df
    kept = kept.where(F.col(spec.time_column) >= F.lit(start))
    if BUCKET in df.columns:
        kept = kept.where(F.col(BUCKET) > F.lit(start - spec.period(spec.bucket_period)))
    return kept


def _before(df: DataFrame, spec: TableSpec, end: int, source: str | None = None) -> DataFrame:
    kept = df.where(F.col(source) < _moment(df, source, spec, end)) if source else df
    kept = kept.where(F.col(spec.time_column) < F.lit(end))
    return kept.where(F.col(BUCKET) < F.lit(end)) if BUCKET in df.columns else kept


def apply_retention(df: DataFrame, spec: TableSpec, as_of: Moment, source: str | None = None) -> DataFrame:
    """Rows not older than the retention."""
    return _since(df, spec, retention_start(spec, as_of), source)


def tier_of(time: Column, spec: TableSpec, tiers: Iterable[Tier], as_of: Moment, default: str | None) -> Column:
    age = F.lit(spec.epoch(as_of)) - time
    oldest_first = sorted(tiers, key=lambda tier: spec.period(tier.age), reverse=True)
    tier: Column = F.lit(default).cast("string")
    for candidate in reversed(oldest_first):
        tier = F.when(age >= spec.period(candidate.age), F.lit(candidate.name)).otherwise(tier)
    return tier


def assign_tier(
    df: DataFrame, spec: TableSpec, as_of: Moment, default: str | None = None, name: str = "tier"
) -> DataFrame:
    """Add the tier: of those whose age the row has reached, the oldest."""
    return df.withColumn(name, tier_of(F.col(spec.time_column), spec, spec.tiers, as_of, default))


def in_tier(df: DataFrame, spec: TableSpec, name: str, as_of: Moment) -> DataFrame:
    """Rows of one age tier: two bounds on the time, which reach the scan and the folders."""
    ages = sorted((spec.period(tier.age), tier.name) for tier in spec.tiers)
    own = [age for age, tier in ages if tier == name]
    if not own:
        raise SpecError(f"table {spec.table_name}: unknown tier {name!r}")
    now = spec.epoch(as_of)
    older = [age for age, _ in ages if age > own[0]]
    kept = _before(df, spec, now - own[0] + 1)
    return _since(kept, spec, now - older[0] + 1) if older else kept


def complete_until(spec: TableSpec, as_of: Moment) -> int:
    """End of the last bucket that lies wholly before ``as_of`` less the buffer."""
    latest = spec.epoch(as_of) - spec.period(spec.buffer_period)
    return latest - latest % spec.period(spec.bucket_period)


def complete_rows(df: DataFrame, spec: TableSpec, as_of: Moment, source: str | None = None) -> DataFrame:
    """Rows of complete buckets, with ``bucket_start``."""
    done = _before(df, spec, complete_until(spec, as_of), source)
    return done.withColumn(BUCKET, bucket_floor(spec.time_column, spec.period(spec.bucket_period)))


def hybrid_rows(
    offline: DataFrame, realtime: DataFrame, spec: TableSpec, boundary: Moment, source: str | None = None
) -> DataFrame:
    """Offline rows before the boundary and realtime rows from it on: none twice.

    Times must not be null; a row without one is in neither half.
    """
    edge = spec.epoch(boundary)
    return _before(offline, spec, edge, source).unionByName(_since(realtime, spec, edge, source))
