"""Steps before rows reach a table: filter, derived columns, rollup."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewflow.functions.epoch import epoch_to_ts
from viewflow.operators.shape import DATE_TIME, DIMENSION, METRIC, TIME, columns_by_role, shape, table_schema
from viewflow.spec import SpecError, TableSpec


_COMPARED = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}

#: A column, a comparison and a literal that is not null.
Comparison = tuple[str, str, Any]


def _not_all(comparisons: Sequence[Comparison]) -> Column:
    """Whether one of the comparisons is false or null, in a form that a scan takes."""
    kept = F.lit(False)
    for name, sign, literal in comparisons:
        if sign not in _COMPARED or literal is None:
            raise SpecError(f"not a comparison with a literal: {name} {sign} {literal!r}")
        kept = kept | ~_COMPARED[sign](F.col(name), F.lit(literal)) | F.col(name).isNull()
    return kept


def ingest_filter(
    df: DataFrame,
    drop_when: Column | str | Sequence[Comparison] | None = None,
    keep_when: Column | str | None = None,
) -> DataFrame:
    """Drop the rows for which ``drop_when`` is true, or keep those for which ``keep_when`` is.

    A predicate that is null neither drops nor keeps. ``keep_when`` reaches the scan as a filter; so does ``drop_when``
    as a list of comparisons (column, sign, literal), which drops the rows for which all of them hold.
    """
    if isinstance(drop_when, (list, tuple)):
        df = df.where(_not_all(drop_when)) if drop_when else df
    elif drop_when is not None:
        condition = F.expr(drop_when) if isinstance(drop_when, str) else drop_when
        df = df.where(~condition | condition.isNull())
    if keep_when is not None:
        df = df.where(keep_when)
    return df


def ingest_transform(df: DataFrame, transforms: Iterable[tuple[str, Column | str]]) -> DataFrame:
    """Add columns in list order; a later expression may use an earlier column."""
    for name, expression in transforms:
        df = df.withColumn(name, F.expr(expression) if isinstance(expression, str) else expression)
    return df


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Filter, derive, shape: everything before the rollup. Narrow, so it works on any DataFrame."""
    df = ingest_filter(df, spec.drop_when, spec.keep_when)
    df = ingest_transform(df, spec.transforms)
    return shape(df, spec)


def ingest_rollup(df: DataFrame, spec: TableSpec, watermark: str | None = None) -> DataFrame:
    """Sum the metrics over equal dimensions and times.

    ``df`` holds shaped rows, fresh or read back from a table. A stream that keeps every row is rolled up by
    ``write_rollup_stream``. With a ``watermark``, which says how late rows may come, this gives final groups only:
    Spark drops rows behind the watermark, and the last groups come out when later rows do.
    """
    groups, metrics = _group_and_metric_columns(df, spec)
    sums = [F.sum(f"`{m}`").alias(m) for m in metrics]
    if not sums:
        raise SpecError(f"table {spec.table_name} has no metric to roll up")
    if not df.isStreaming:
        return df.groupBy(*groups).agg(*sums)
    if watermark is None:
        raise SpecError("a rollup of a stream needs a watermark")
    timed = df.withColumn("__ts", epoch_to_ts(f"`{spec.time_column}`", spec.time_unit))
    rolled = timed.withWatermark("__ts", watermark).groupBy("__ts", *groups).agg(*sums)
    return rolled.select(*groups, *metrics)


def _group_and_metric_columns(df: DataFrame, spec: TableSpec) -> tuple[list[str], list[str]]:
    if any(f.metadata.get("role") for f in df.schema.fields):
        schema = df.schema
        return columns_by_role(schema, DIMENSION, DATE_TIME, TIME), columns_by_role(schema, METRIC)
    # Rows read back carry no roles; those of the view's columns and the lists of the spec tell them.
    schema = table_schema(spec)
    listed = {*columns_by_role(schema, DIMENSION, DATE_TIME, TIME), *spec.dimensions, *spec.date_times}
    metrics = {*columns_by_role(schema, METRIC), *spec.metrics} - listed
    return [c for c in df.columns if c in listed], [c for c in df.columns if c in metrics]
