"""Pre-aggregated cubes, and queries answered from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.spec import SpecError, StarTree

# Functions a pair may name.
FUNCTIONS = ("COUNT", "SUM", "MIN", "MAX", "AVG", "DISTINCTCOUNTHLL")


def split_pair(pair: str) -> tuple[str, str]:
    """``FUNC__column`` into its two parts, at the first double underscore."""
    function, found, column = pair.partition("__")
    if not found or function not in FUNCTIONS:
        raise SpecError(f"not a function and column pair: {pair!r}")
    return function, column


# Types whose values a sketch takes as they are.
_SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _sketchable(value: Column, data_type: T.DataType) -> Column:
    """A value as one that a sketch takes: equal values alike, different ones differently."""
    if isinstance(data_type, _SKETCHED):
        return value
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        value = F.when(value == 0, F.lit(0.0)).otherwise(value)  # one zero
    if isinstance(data_type, T.MapType):
        value = F.array_sort(F.map_entries(value))
    if isinstance(data_type, (T.MapType, T.ArrayType, T.StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return value.cast("string")


def _stored(pair: str, schema: T.StructType) -> dict[str, Column]:
    """Columns a cube keeps for a pair, as aggregates of the rows; all can be merged further."""
    function, column = split_pair(pair)
    value = F.col(f"`{column}`")
    if function == "COUNT":
        return {pair: F.count(F.lit(1))}
    if function == "AVG":
        return {f"{pair}__sum": F.sum(value), f"{pair}__count": F.count(value)}
    if function == "DISTINCTCOUNTHLL":
        return {pair: F.hll_sketch_agg(_sketchable(value, schema[column].dataType))}
    return {pair: {"SUM": F.sum, "MIN": F.min, "MAX": F.max}[function](value)}


def _merged(pair: str) -> dict[str, Column]:
    """The same columns, merged from finer groups."""
    function, _ = split_pair(pair)
    if function == "AVG":
        return {name: F.sum(f"`{name}`") for name in (f"{pair}__sum", f"{pair}__count")}
    merge = {
        "COUNT": F.sum,
        "SUM": F.sum,
        "MIN": F.min,
        "MAX": F.max,
        "DISTINCTCOUNTHLL": F.hll_union_agg,
    }[function]
    return {pair: merge(f"`{pair}`")}


def _answer(pair: str) -> Column:
    function, _ = split_pair(pair)
    if function == "AVG":
        return F.try_divide(F.col(f"`{pair}__sum`"), F.col(f"`{pair}__count`")).alias(pair)
    if function == "DISTINCTCOUNTHLL":
        return F.hll_sketch_estimate(f"`{pair}`").alias(pair)
    return F.col(f"`{pair}`").alias(pair)


def starred(dim: str) -> str:
    """Name of the flag that is 1 where ``dim`` was aggregated away."""
    return f"{dim}__starred"


def _subsets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [c for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def _aggregates(columns: Mapping[str, Column]) -> list[Column]:
    return [aggregate.alias(name) for name, aggregate in columns.items()]


def star_rollup(df: DataFrame, tree: StarTree, dims_per_step: int = 4) -> DataFrame:
    """Aggregate over every subset of the dimensions that keeps the unstarred ones.

    The rows are first aggregated by all dimensions, so the copies that the grouping sets make are
    of groups, not of rows, and no value of a dimension is heavy any more after that. Many
    dimensions are starred a few at a time, each step from what the step before has aggregated:
    a group is copied 2^dims_per_step times, not 2^dims.
    """
    stored: dict[str, Column] = {}
    merged: dict[str, Column] = {}
    for pair in tree.pairs:
        stored.update(_stored(pair, df.schema))
        merged.update(_merged(pair))
    dims = list(tree.dims)
    free = [d for d in dims if d not in tree.no_star]
    cube = df.groupBy(*dims).agg(*_aggregates(stored))
    done: list[str] = []
    for start in range(0, len(free), dims_per_step):
        step = free[start : start + dims_per_step]
        always = [d for d in dims if d not in step] + done
        sets = [[*always, *some] for some in _subsets(step)]
        flags = [F.grouping(d).cast("int").alias(starred(d)) for d in step]
        cube = cube.groupingSets(sets, *dims, *done).agg(*_aggregates(merged), *flags)
        done += [starred(d) for d in step]
    flags = [F.col(starred(d)) if d in free else F.lit(0).alias(starred(d)) for d in dims]
    return cube.select(*dims, *flags, *stored)


def iceberg_rollup(df: DataFrame, tree: StarTree) -> DataFrame:
    """The cube without starred groups of at most ``tree.leaf_records`` rows.

    ``query_leaves`` answers those from the groups of all dimensions, which are always kept, as is the group of
    everything.
    """
    records = next((pair for pair in tree.pairs if split_pair(pair)[0] == "COUNT"), None)
    counted = tree if records else replace(tree, pairs=(*tree.pairs, _RECORDS))
    cube = star_rollup(df, counted)
    stars = sum((F.col(f"`{starred(d)}`") for d in tree.dims), F.lit(0))
    kept = (stars == 0) | (stars == len(tree.dims)) | (F.col(f"`{records or _RECORDS}`") > tree.leaf_records)
    cube = cube.where(kept)
    return cube if records else cube.drop(_RECORDS)


_RECORDS = "COUNT__records"


def write_rollup(df: DataFrame, tree: StarTree, path: str) -> None:
    """Store the cube with one folder per grouping set, so that a query reads only its own.

    With a leaf limit, small starred groups are not stored: read such a cube with ``query_leaves``.
    """
    flags = [starred(d) for d in tree.dims]
    cube = iceberg_rollup(df, tree) if tree.leaf_records else star_rollup(df, tree)
    cube.write.mode("overwrite").partitionBy(*flags).parquet(path)


def query_leaves(
    cube: DataFrame,
    tree: StarTree,
    group_by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
) -> DataFrame:
    """``query_rollup`` of a cube with a leaf limit: two grouping sets are read, the one of the asked dimensions and
    the one of all. Groups that the first lacks are made from the second."""
    values = _values(where)
    kept = [d for d in tree.dims if d in _checked(tree, group_by, values)]
    own = grouping_set(cube, tree, kept, values)
    if kept and len(kept) < len(tree.dims):
        base = merged_columns(grouping_set(cube, tree, tree.dims, values), tree, kept)
        # Stored groups of these dimensions are above the limit: far fewer than the base's.
        there = own.select(*[F.col(f"`{d}`").alias(f"__{d}") for d in kept])
        same = reduce(lambda a, b: a & b, [F.col(f"`{d}`").eqNullSafe(F.col(f"`__{d}`")) for d in kept])
        own = own.unionByName(base.join(there, same, "left_anti"))
    return merged_groups(own, tree, group_by)


def _values(where: Mapping[str, Any] | None) -> dict[str, list]:
    return {d: list(v) if isinstance(v, (list, tuple, set)) else [v] for d, v in (where or {}).items()}


def _allowed(df: DataFrame, where: Mapping[str, list]) -> DataFrame:
    for dim, values in where.items():
        df = df.where(F.col(f"`{dim}`").isin(values))
    return df


def _checked(tree: StarTree, group_by: Sequence[str], where: Mapping[str, list]) -> set[str]:
    unknown = (set(group_by) | set(where)) - set(tree.dims)
    if unknown:
        raise SpecError(f"not dimensions of the cube: {sorted(unknown)}")
    return set(group_by) | set(where) | set(tree.no_star)


def grouping_set(
    cube: DataFrame, tree: StarTree, group_by: Sequence[str] = (), where: Mapping[str, Any] | None = None
) -> DataFrame:
    """The stored groups of the one grouping set that holds the asked dimensions."""
    values = _values(where)
    kept = _checked(tree, group_by, values)
    for d in tree.dims:
        cube = cube.where(F.col(f"`{starred(d)}`") == (0 if d in kept else 1))
    names = [name for pair in tree.pairs for name in _merged(pair)]
    return _allowed(cube, values).select(*group_by, *[F.col(f"`{name}`") for name in names])


def base_groups(
    df: DataFrame, tree: StarTree, group_by: Sequence[str] = (), where: Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows aggregated to what a cube would store for the asked dimensions."""
    values = _values(where)
    _checked(tree, group_by, values)
    stored: dict[str, Column] = {}
    for pair in tree.pairs:
        stored.update(_stored(pair, df.schema))
    return _allowed(df, values).groupBy(*group_by).agg(*_aggregates(stored))


def merged_columns(groups: DataFrame, tree: StarTree, group_by: Sequence[str]) -> DataFrame:
    """Stored groups, finer ones or ones from several places, merged to one a group, with the stored columns."""
    merged: dict[str, Column] = {}
    for pair in tree.pairs:
        merged.update(_merged(pair))
    return groups.groupBy(*group_by).agg(*_aggregates(merged))


def merged_groups(
    groups: DataFrame, tree: StarTree, group_by: Sequence[str] = (), pairs: Sequence[str] | None = None
) -> DataFrame:
    """The same with the answers of the pairs (all of them)."""
    rows = merged_columns(groups, tree, group_by)
    return rows.select(*group_by, *[_answer(pair) for pair in pairs or tree.pairs])


def query_rollup(
    cube: DataFrame,
    tree: StarTree,
    group_by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Answer ``GROUP BY group_by`` from the cube; ``where`` gives allowed values per dimension.

    Reads the one grouping set that holds the asked dimensions; of a stored cube, its folder alone.
    SUM, COUNT, MIN, MAX and AVG are exact.
    """
    rows = grouping_set(cube, tree, group_by, where)
    if set(group_by) | set(where or {}) | set(tree.no_star) != set(group_by):
        return merged_groups(rows, tree, group_by)
    return rows.select(*group_by, *[_answer(pair) for pair in tree.pairs])
