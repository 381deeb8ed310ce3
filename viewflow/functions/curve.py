"""A space-filling curve over several columns, for files that are narrow in each of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each column is cut into two to the power of this many parts of about as many rows each.
BITS = 6
# So many columns fit a place of 63 bits; more would be cut too coarsely to gain anything.
MOST_COLUMNS = 10

_CUT_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def curve_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The first of the columns that a curve can run over: numbers and times."""
    fit = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, _CUT_TYPES)]
    return fit[:MOST_COLUMNS]


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[Any]]:
    """The values that cut each column into parts of about as many rows each: one pass, a fixed number of values."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(
        *[F.percentile_approx(F.col(f"`{c}`"), shares, 100 << bits).alias(f"cut_{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: sorted(set(found[i] or [])) for i, c in enumerate(columns)}


def _part(column: Column, data_type: T.DataType, points: Sequence[Any]) -> Column:
    """How many of the points a value has reached; none for null."""
    array = F.array(*[F.lit(p).cast(data_type) for p in points]).cast(T.ArrayType(data_type))
    reached = F.size(F.filter(array, lambda point: point <= column))
    return F.when(column.isNull(), 0).otherwise(reached).cast("long")


def z_order(df: DataFrame, cuts: Mapping[str, Sequence[Any]], bits: int = BITS) -> Column:
    """The place on the curve: the bits of the columns' parts by turns, the highest first. Nulls are in the first part."""
    place, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    for turn, (name, points) in enumerate(cuts.items()):
        part = _part(F.col(f"`{name}`"), df.schema[name].dataType, points)
        for bit in range(bits):
            moved = F.shiftleft(F.shiftright(part, bit).bitwiseAND(one), bit * len(cuts) + len(cuts) - 1 - turn)
            place = place.bitwiseOR(moved)
    return place
