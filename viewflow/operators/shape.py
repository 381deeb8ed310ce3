"""From view rows to table rows: column roles, map splitting, defaults, lengths, time columns."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.spec import SpecError, TableSpec, field_default

log = logging.getLogger("viewflow")

# Suffixes of the two columns of a split map, and the defaults of map values by type.
KEYS_SUFFIX = "__KEYS"
VALUES_SUFFIX = "__VALUES"
MAP_VALUE_DEFAULTS = {
    T.StringType: "",
    T.IntegerType: 0,
    T.LongType: 0,
    T.FloatType: 0.0,
    T.DoubleType: 0.0,
}

DIMENSION, METRIC, DATE_TIME, TIME = "dimension", "metric", "date_time", "time"


def map_value_default(data_type: T.MapType) -> Any:
    if type(data_type.valueType) not in MAP_VALUE_DEFAULTS:
        raise SpecError(f"unsupported type for map values: {data_type.valueType.simpleString()}")
    if not isinstance(data_type.keyType, T.StringType):
        raise SpecError(f"unsupported type for map keys: {data_type.keyType.simpleString()}")
    return MAP_VALUE_DEFAULTS[type(data_type.valueType)]


def _needed_columns(spec: TableSpec) -> set[str]:
    """Columns that sorting, partitioning or a pre-aggregation of the table relies on."""
    needed = set(spec.partitions)
    if spec.sorted_column:
        needed.add(spec.sorted_column)
    for tree in spec.star_trees:
        needed.update(tree.dims)
        needed.update(pair.split("__", 1)[1] for pair in tree.pairs if not pair.startswith("COUNT__"))
    return needed


def table_schema(spec: TableSpec, input_schema: T.StructType | None = None) -> T.StructType:
    """The table's columns, in schema order, with role, default and length as field metadata.

    The first that holds decides: a map is split into two dimensions even if listed nowhere; then
    the time column, the other time columns, dimensions, metrics. A field in no list is dropped,
    unless sorting, partitioning or a pre-aggregation needs it.
    """
    fields: list[T.StructField] = []

    def add(name: str, data_type: T.DataType, role: str, default: Any, **more: Any) -> None:
        meta = {"role": role, **more}
        if isinstance(data_type, T.StringType) and role == DIMENSION and default is None:
            default = spec.string_default
        elif isinstance(data_type, T.ArrayType) and default is None:
            if isinstance(data_type.elementType, T.StringType):
                default = spec.string_default
        if default is not None:
            meta["default"] = default
        if name in spec.max_lengths:
            meta["max_length"] = spec.max_lengths[name]
        fields.append(T.StructField(name, data_type, True, meta))

    needed = _needed_columns(spec)
    defaults = {f.name: field_default(f) for f in spec.schema.fields}
    # Derived columns come after the view's own and take part in the roles.
    for field in (input_schema or spec.schema).fields:
        name, data_type, default = field.name, field.dataType, defaults.get(field.name)
        if isinstance(data_type, T.MapType):
            value_default = map_value_default(data_type)
            add(name + KEYS_SUFFIX, T.ArrayType(T.StringType()), DIMENSION, "")
            add(name + VALUES_SUFFIX, T.ArrayType(data_type.valueType), DIMENSION, value_default)
        elif name == spec.time_column or name in spec.date_times:
            if not isinstance(data_type, T.LongType):
                raise SpecError(f"time column {name} must be bigint, it is {data_type.simpleString()}")
            primary = name == spec.time_column
            unit = spec.time_unit if primary else "MILLISECONDS"
            role = TIME if primary else DATE_TIME
            add(name, data_type, role, default, format=f"1:{unit}:EPOCH", granularity=f"1:{unit}")
        elif name in spec.dimensions:
            add(name, data_type, DIMENSION, default)
        elif name in spec.metrics:
            add(name, data_type, METRIC, default)
        elif name in needed:
            log.warning("table %s: %s has no role but the layout needs it; kept", spec.table_name, name)
            add(name, data_type, DIMENSION, default)
    return T.StructType(fields)


def columns_by_role(schema: T.StructType, *roles: str) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("role") in roles]


def split_map(df: DataFrame, *names: str) -> DataFrame:
    """Replace each map by two arrays, ``<name>__KEYS`` and ``<name>__VALUES``, both in key order."""
    entries: dict[str, Column] = {}
    for name in names:
        # Keys are unique within a map, so sorting the entries sorts by key.
        pairs = F.sort_array(F.map_entries(F.col(f"`{name}`")))
        entries[name + KEYS_SUFFIX] = pairs.getField("key")
        entries[name + VALUES_SUFFIX] = pairs.getField("value")
    return df.withColumns(entries).drop(*names) if names else df


def with_default(value: Column, data_type: T.DataType, default: Any, empty_as_null: bool = False) -> Column:
    """``value`` with nulls replaced; an array gets one element, the default, unless that is a list."""
    if default is None:
        return value
    if isinstance(data_type, T.ArrayType):
        items = default if isinstance(default, list) else [default]
        stand_in = F.array(*[F.lit(item).cast(data_type.elementType) for item in items])
        if empty_as_null:
            return F.when(F.size(value) > 0, value).otherwise(stand_in)
        return F.coalesce(value, stand_in)
    return F.coalesce(value, F.lit(default).cast(data_type))


def fill_defaults(df: DataFrame, schema: T.StructType, empty_as_null: bool = False) -> DataFrame:
    """Replace nulls by the defaults in the field metadata of ``schema``."""
    filled = {
        f.name: with_default(F.col(f"`{f.name}`"), f.dataType, field_default(f), empty_as_null)
        for f in schema.fields
        if f.name in df.columns and field_default(f) is not None
    }
    return df.withColumns(filled) if filled else df


def truncated(value: Column, data_type: T.DataType, length: int) -> Column:
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: F.substring(item, 1, length))
    return F.substring(value, 1, length)


def truncate(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Cut strings, byte strings and the elements of arrays of them to a length per column."""

    def takes_length(data_type: T.DataType) -> bool:
        item = data_type.elementType if isinstance(data_type, T.ArrayType) else data_type
        return isinstance(item, (T.StringType, T.BinaryType))

    cut = {
        f.name: truncated(F.col(f"`{f.name}`"), f.dataType, lengths[f.name])
        for f in df.schema.fields
        if f.name in lengths and takes_length(f.dataType)
    }
    return df.withColumns(cut) if cut else df


def project_roles(df: DataFrame, schema: T.StructType, extra: Iterable[str] = ()) -> DataFrame:
    """The table's columns only, each carrying its role as metadata."""
    columns = [F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema.fields]
    return df.select(*columns, *extra)


def shape(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Split maps, fill defaults, cut lengths, keep the columns with a role; no shuffle."""
    schema = table_schema(spec, df.schema)
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    df = split_map(df, *maps)
    df = fill_defaults(df, schema, spec.empty_as_null)
    df = truncate(df, spec.max_lengths)
    return project_roles(df, schema)
