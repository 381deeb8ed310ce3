"""Physical layout of table files: partition columns, order, parquet options."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.functions.curve import curve_columns, cut_points, z_order
from viewflow.functions.epoch import bucket_floor
from viewflow.functions.partitioning import partition_id, spread_salt
from viewflow.spec import TableSpec

BUCKET = "bucket_start"


def partition_column(name: str) -> str:
    return f"part_{name}"


def add_partitions(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add ``part_<column>`` for each partitioned column and ``bucket_start``, the roll-over bucket."""
    columns = {
        partition_column(name): partition_id(name, function, n) for name, (function, n) in spec.partitions.items()
    }
    columns[BUCKET] = bucket_floor(spec.time_column, spec.period(spec.bucket_period))
    return df.withColumns(columns)


def partition_columns(spec: TableSpec) -> list[str]:
    return [BUCKET, *[partition_column(name) for name in spec.partitions]]


def part_filter(df: DataFrame, spec: TableSpec, name: str, value: object) -> DataFrame:
    """Rows with ``name`` equal to ``value``; the partition number is compared too, so files are pruned."""
    function, n = spec.partitions[name]
    number = partition_id(F.lit(value).cast(df.schema[name].dataType), function, n)
    return df.where((F.col(partition_column(name)) == number) & (F.col(name) == F.lit(value)))


def order_columns(spec: TableSpec) -> list[str]:
    """The sorted column first, then the range columns."""
    first = [spec.sorted_column] if spec.sorted_column else []
    return list(dict.fromkeys(first + spec.range_columns))


def arrange(
    df: DataFrame,
    partition_by: Iterable[str],
    order_by: Iterable[str],
    files: int | None = None,
    by_range: bool = False,
    curve: Iterable[str] = (),
) -> DataFrame:
    """Bring rows of a partition together and sort them within each task, for few and sorted files.

    Normally adaptive execution sizes the tasks in one pass: small partitions share one, a partition
    with a great share of the rows is cut over many. ``by_range`` cuts along the order instead, so
    that files hold narrow ranges of it; that takes a sample of the rows first, a second read of
    them. The last range key is a salt, by which a single heavy value is cut too. ``files`` asks for
    so many ranges; without adaptive execution the way is always by range.

    Two or more columns of ``curve`` that are numbers or times are not ordered one after another by range, but along
    a curve through all of them, whose place comes where the first of them would: files are narrow in each. That takes
    one more pass, for the values that cut the columns.
    """
    partition_by = list(partition_by)
    order = list(dict.fromkeys([*partition_by, *order_by]))
    if not order:
        return df
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if partition_by and adaptive and not (by_range or files):
        placed = df.hint("rebalance", *partition_by)
    else:
        salted = df.withColumn("__salt", spread_salt(df))
        curved = curve_columns(df, [c for c in curve if c in order and c not in partition_by])
        if len(curved) > 1:
            salted = salted.withColumn("__place", z_order(df, cut_points(df, curved)))
            order.insert(min(order.index(c) for c in curved), "__place")
        ranges = [*[F.col(f"`{c}`") for c in order], F.col("__salt")]
        placed = salted.repartitionByRange(files, *ranges) if files else salted.repartitionByRange(*ranges)
        ordered = placed.sortWithinPartitions(*[F.col(f"`{c}`") for c in order])
        return ordered.drop("__salt", "__place")
    return placed.sortWithinPartitions(*[F.col(f"`{c}`") for c in order])


def _parquet_path(name: str, data_type: T.DataType) -> str:
    return f"{name}.list.element" if isinstance(data_type, T.ArrayType) else name


def parquet_options(
    spec: TableSpec, schema: T.StructType, distinct_values: int | None = None
) -> dict[str, str]:
    """Writer options for bloom filters and columns without a dictionary.

    Parquet writes no bloom filter for a column chunk that is wholly dictionary-encoded, so the
    dictionary is off for these columns. The filter's size follows the data of the file, or
    ``distinct_values`` if given.
    """
    types = {f.name: f.dataType for f in schema.fields}
    options: dict[str, str] = {}
    for name in spec.no_dictionary_columns:
        if name in types:
            options[f"parquet.enable.dictionary#{_parquet_path(name, types[name])}"] = "false"
    for name in spec.bloom_columns:
        if name in types:
            path = _parquet_path(name, types[name])
            options[f"parquet.enable.dictionary#{path}"] = "false"
            options[f"parquet.bloom.filter.enabled#{path}"] = "true"
            if distinct_values:
                options[f"parquet.bloom.filter.expected.ndv#{path}"] = str(distinct_values)
            else:
                options["parquet.bloom.filter.adaptive.enabled"] = "true"
    return options


def write_layout(
    df: DataFrame, spec: TableSpec, path: str, files: int | None = None, by_range: bool = False
) -> None:
    """Write shaped rows as a partitioned folder in the table's layout, replacing the partitions it holds."""
    df = add_partitions(df, spec)
    parts = partition_columns(spec)
    arrange(df, parts, order_columns(spec), files, by_range, spec.range_columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).options(**parquet_options(spec, df.schema)).partitionBy(*parts).parquet(path)
