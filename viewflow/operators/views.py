"""View functions: record values in, zero or more rows out, under the key they came with."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.operators.enrich import Context
from viewflow.spec import SpecError

# The record key travels through a view in this column.
KEY = "__key"

Transform = Callable[[DataFrame, Context], DataFrame]


@dataclass(frozen=True)
class View:
    """A named view. ``transform`` gets the value's fields as columns and must pass ``__key`` on.

    ``partition_expr`` is an integer SQL expression over the output columns, or None.
    """

    name: str
    schema: T.StructType
    transform: Transform
    partition_expr: str | None = None
    strict: bool = True


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def projection_view(
    name: str,
    schema: T.StructType,
    columns: Mapping[str, Column | str],
    where: Column | str | None = None,
    **settings: Any,
) -> View:
    """One row out for each row in (or none, if ``where`` is not true for it)."""

    def transform(df: DataFrame, _: Context) -> DataFrame:
        kept = df if where is None else df.where(_expr(where))
        return kept.select(KEY, *[_expr(e).alias(out) for out, e in columns.items()])

    return View(name, schema, transform, **settings)


def explode_view(name: str, schema: T.StructType, rows: Column | str, **settings: Any) -> View:
    """``rows`` gives an array of structs for each row in; a null or empty array gives nothing out."""

    def transform(df: DataFrame, _: Context) -> DataFrame:
        return df.select(KEY, F.inline(_expr(rows)))

    return View(name, schema, transform, **settings)


def row_view(
    name: str,
    schema: T.StructType,
    function: Callable[[dict], Iterable[dict] | None],
    inputs: Iterable[str],
    max_batch: int = 10_000,
    **settings: Any,
) -> View:
    """A Python function from a record to its output rows, for what no expression can say.

    Only ``inputs`` reach Python. ``function`` may be a generator; its output is passed on in
    batches of ``max_batch``, so a record with very many rows never has to fit in memory at once.
    """
    inputs = list(inputs)
    out_schema = T.StructType([T.StructField(KEY, T.StringType()), *schema.fields])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_schema)
        for batch in batches:
            rows: list[dict] = []
            for record in batch.to_pylist():
                key = record.pop(KEY)
                for out in function(record) or ():
                    rows.append({**out, KEY: key})
                    if len(rows) >= max_batch:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    def transform(df: DataFrame, _: Context) -> DataFrame:
        return df.select(KEY, *inputs).mapInArrow(run, out_schema)

    return View(name, schema, transform, **settings)


def _all_nullable(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _all_nullable(f.dataType), True) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_all_nullable(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(data_type.keyType, _all_nullable(data_type.valueType), True)
    return data_type


def conform(df: DataFrame, schema: T.StructType, strict: bool = True, extra: Iterable[str] = ()) -> DataFrame:
    """Reorder to ``schema``, drop other columns, cast where safe, keep ``extra`` columns in front.

    A missing column raises in strict mode, else is null. A null in a field declared not null fails
    the job when the row is met, since whether a column is nullable is seldom known beforehand.
    """
    extra = list(extra)
    missing = [f.name for f in schema.fields if f.name not in df.columns and (strict or not f.nullable)]
    if missing:
        raise SpecError(f"columns missing from the output: {', '.join(missing)}")
    fields = [T.StructField(f.name, _all_nullable(f.dataType), True) for f in schema.fields]
    fitted = df.to(T.StructType([df.schema[name] for name in extra] + fields))

    def checked(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if not field.nullable:
            message = F.lit(f"null in the not-null column {field.name}")
            value = F.when(value.isNull(), F.raise_error(message)).otherwise(value).alias(field.name)
        return value

    return fitted.select(*extra, *[checked(f) for f in schema.fields])


def apply_view(records: DataFrame, view: View, context: Context | None = None) -> DataFrame:
    """Run a view over decoded records: ``key, value STRUCT, emit_time`` and, if asked for, ``partition``.

    Every row out has its input's key, null included, and a fresh time stamp; Spark takes one stamp
    per (micro-)batch.
    """
    flat = records.select(F.col("key").alias(KEY), "value.*")
    out = view.transform(flat, context or Context())
    if KEY not in out.columns:
        raise SpecError(f"view {view.name!r} lost the record key")
    out = conform(out, view.schema, view.strict, extra=[KEY])
    columns = [
        F.col(KEY).alias("key"),
        F.struct(*[F.col(f"`{f.name}`") for f in view.schema.fields]).alias("value"),
        F.current_timestamp().alias("emit_time"),
    ]
    if view.partition_expr is not None:
        columns.append(F.expr(view.partition_expr).cast("int").alias("partition"))
    return out.select(*columns)


def view_rows(records: DataFrame, view: View, context: Context | None = None) -> DataFrame:
    """A view's output as flat columns: the key, then the schema."""
    return apply_view(records, view, context).select("key", "value.*")
