"""Partition numbers from column values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.spec import SpecError


def java_hash(value: Column | str) -> Column:
    """The 32-bit signed ``String.hashCode`` of Java, for every string.

    Java hashes UTF-16 units, so a character above U+FFFF counts as its two surrogates. Text of
    one byte per character takes a shorter way.
    """
    value = F.col(value) if isinstance(value, str) else value
    low_32 = F.lit((1 << 32) - 1)

    def plain(acc: Column, char: Column) -> Column:
        return (acc * 31 + F.ascii(char)).bitwiseAND(low_32)

    def wide(acc: Column, char: Column) -> Column:
        code = F.ascii(char)
        over = code - F.lit(0x10000)
        high = F.lit(0xD800) + F.shiftright(over, 10)
        low = F.lit(0xDC00) + over % F.lit(0x400)
        return F.when(code < 0x10000, plain(acc, char)).otherwise(
            ((acc * 31 + high).bitwiseAND(low_32) * 31 + low).bitwiseAND(low_32)
        )

    # An empty string splits into one empty string, whose code is 0: the hash stays 0.
    chars, zero = F.split(value, ""), F.lit(0).cast("long")
    unsigned = F.when(
        F.octet_length(value) == F.char_length(value), F.aggregate(chars, zero, plain)
    ).otherwise(F.aggregate(chars, zero, wide))
    # Into the signed range without computing the hash twice.
    half = F.lit(1 << 31)
    return ((unsigned + half).bitwiseAND(low_32) - half).cast("int")


def partition_id(value: Column | str, function: str, partitions: int) -> Column:
    """Partition number in [0, partitions) by a named function: HashCode, Modulo or Murmur3 (Spark's hash)."""
    value = F.col(value) if isinstance(value, str) else value
    if partitions < 1:
        raise SpecError("a partition count must be positive")
    if function == "HashCode":
        number = java_hash(value.cast("string"))
    elif function == "Modulo":
        number = value.cast("long")
    elif function == "Murmur3":
        number = F.hash(value)
    else:
        raise SpecError(f"unknown partition function {function!r}")
    return F.pmod(number, F.lit(partitions)).cast("int")


def partition_by_fields(
    df: DataFrame,
    fields: Iterable[str],
    partitions: int,
    topic: str,
    enabled_topics: str | None,
    name: str = "partition",
) -> DataFrame:
    """Add a partition number from the values of ``fields``, only for topics in the comma-separated list.

    For any other topic the column is null, which leaves the choice to the sink.
    """
    listed = [part.strip() for part in (enabled_topics or "").split(",")]
    if enabled_topics is None or topic not in listed:
        return df.withColumn(name, F.lit(None).cast("int"))
    return df.withColumn(name, F.pmod(F.hash(*[F.col(f) for f in fields]), F.lit(partitions)).cast("int"))


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    return True


def spread_salt(df: DataFrame) -> Column:
    """A number that spreads rows evenly, even rows with one key; exact copies spread by the tasks they are read in.

    It depends on the row and the task's partition number only, never on row order or chance, so a
    task run again after a lost executor gives its rows the same salt.
    """
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.xxhash64(*columns, F.spark_partition_id())
