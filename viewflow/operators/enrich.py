"""Reference data for views: lookups measured when they change, joined by the way their size allows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewflow.functions.partitioning import spread_salt
from viewflow.spec import SpecError

# A lookup may be broadcast up to these sizes, both measured.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20

# Skewed joins: a key is spread over several tasks if it has more rows than this and more than this part of a
# task's even share. Both bound the list of such keys: it has at most HOT_SHARE keys for each shuffle partition.
HOT_ROWS = 1_000_000
HOT_SHARE = 4
# A sketch tracks so many items for each key that may be hot, at most so many (Spark's own bound) in all; sketches
# are merged in so many groups first.
TRACKED_PER_SHARE = 5.25
MAX_TRACKED = 1_000_000
SKETCH_GROUPS = 64


@dataclass(frozen=True)
class Lookup:
    """Reference rows with unique keys; ``small`` says whether they were measured to fit a broadcast.

    ``files`` are those the rows were read from when measured, ``bounds`` the sizes they were held against.
    """

    df: DataFrame
    keys: tuple[str, ...]
    small: bool
    files: frozenset[str] = frozenset()
    bounds: tuple[int, int] = (MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES)


def measure_lookup(
    df: DataFrame,
    keys: Sequence[str],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> Lookup:
    """Check the keys for duplicates and the size against the broadcast bounds."""
    keys, files, bounds = tuple(keys), frozenset(df.inputFiles()), (max_rows, max_bytes)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    found = per_key.agg(F.max("__rows").alias("most"), F.sum("__rows").alias("rows")).first()
    if (found["most"] or 0) > 1:
        raise SpecError(f"lookup rows are not unique by {', '.join(keys)}")
    if (found["rows"] or 0) > max_rows:
        return Lookup(df, keys, False, files, bounds)
    # The row's text, plus what the fields take in memory whatever they hold.
    text = F.octet_length(F.to_json(F.struct("*"))) + F.lit(16 * len(df.columns))
    size = df.agg(F.sum(text).alias("bytes")).first()["bytes"] or 0
    return Lookup(df, keys, size <= max_bytes, files, bounds)


def measure_again(lookup: Lookup) -> Lookup:
    """The lookup as it is now: measured anew if its files are others, or if it isn't read from files."""
    files = frozenset(lookup.df.inputFiles())
    return lookup if files and files == lookup.files else measure_lookup(lookup.df, lookup.keys, *lookup.bounds)


@dataclass(frozen=True)
class Context:
    """What a view may use besides its record: its settings and named lookups."""

    config: Mapping[str, Any] = field(default_factory=dict)
    lookups: Mapping[str, Lookup] = field(default_factory=dict)

    def lookup(self, name: str) -> Lookup:
        if name not in self.lookups:
            raise SpecError(f"unknown lookup {name!r}")
        return self.lookups[name]

    def measured(self) -> Context:
        """The same with lookups as they are now."""
        return replace(self, lookups={name: measure_again(lookup) for name, lookup in self.lookups.items()})


def enrich(df: DataFrame, lookup: Lookup, hot_rows: int = HOT_ROWS, hot_share: int = HOT_SHARE) -> DataFrame:
    """Left join to a lookup: every row stays, once, with nulls where the key is unknown.

    A lookup too large to broadcast is joined with hot keys spread. That takes a sketch of the keys
    first, which a stream has only batch by batch: ``run_views`` and ``write_view`` hand views such batches.
    """
    keys = list(lookup.keys)
    columns = [*df.columns, *[c for c in lookup.df.columns if c not in keys]]
    if lookup.small:
        joined = df.join(F.broadcast(lookup.df), keys, "left")
    elif df.isStreaming:
        raise SpecError("a lookup too large to broadcast is joined batch by batch: give the view to write_view")
    else:
        joined = _salted_join(df, lookup, hot_rows, hot_share)
    return joined.select(*columns)


def _join_keys(df: DataFrame, lookup: Lookup) -> list[Column]:
    """The keys in types that both sides have in common, so that equal keys have equal hashes."""
    keys = list(lookup.keys)
    common = df.select(*keys).unionByName(lookup.df.select(*keys)).schema
    return [F.col(f"`{f.name}`").cast(f.dataType).alias(f"__key{i}") for i, f in enumerate(common.fields)]


def _hot_salts(df: DataFrame, keys: Sequence[Column], hot_rows: int, hot_share: int) -> DataFrame:
    """The hashes of keys whose rows are too many for one task, with the number of salts each gets.

    One pass, with a frequent-items sketch for each task in place of a count of every key. With ``share`` times 5.25 items
    a sketch of N rows is out by N / (2 share) at most, and returns each key with twice that: no key with more than
    N / share rows is missed, and a bounded number can have so many. Keys with one hash share their salts. Both sides of
    the join must see the very same list, so it is taken once.
    """
    spark = df.sparkSession
    share = min(hot_share * int(spark.conf.get("spark.sql.shuffle.partitions")), int(MAX_TRACKED / TRACKED_PER_SHARE))
    tracked = max(int(share * TRACKED_PER_SHARE), 64)
    # Merged in two steps, so that no task merges the sketches of all others. Without rows there is no sketch.
    merged = (
        df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group"))
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.call_function("approx_top_k_accumulate", F.xxhash64(*keys), F.lit(tracked)).alias("__sketch"),
        )
        .groupBy(F.lit("all"))
        .agg(
            F.sum("__rows").alias("__rows"),
            F.call_function("approx_top_k_combine", F.col("__sketch"), F.lit(tracked)).alias("__sketch"),
        )
    )
    least = F.greatest(F.lit(hot_rows), F.floor(F.col("__rows") / share))
    found = F.call_function("approx_top_k_estimate", F.col("__sketch"), F.lit(tracked))
    hot = (
        merged.select(least.alias("__least"), F.explode(found).alias("__found"))
        .where(F.col("__found.count") > F.col("__least"))
        .select(
            F.col("__found.item").alias("__hash"),
            F.ceil(F.col("__found.count") / F.col("__least")).cast("long").alias("__salts"),
        )
    )
    return spark.createDataFrame(hot.toArrow(), hot.schema)


def _salted_join(df: DataFrame, lookup: Lookup, hot_rows: int, hot_share: int) -> DataFrame:
    """Shuffle join in which a key with many rows takes as many partitions as its rows need.

    The lookup's row of such a key is repeated once per salt. Rows with a null key match nothing;
    they are spread out instead of meeting in one partition. The large side is read twice, for the sketch and for
    the join.
    """
    keys = list(lookup.keys)
    cast = _join_keys(df, lookup)
    names = [f"__key{i}" for i in range(len(keys))]
    no_null = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    hot = F.broadcast(_hot_salts(df.where(no_null), cast, hot_rows, hot_share))
    salts = F.coalesce(F.col("__salts"), F.lit(1).cast("long"))
    left = (
        df.select("*", *cast, spread_salt(df).alias("__spread"))
        .withColumn("__hash", F.xxhash64(*names))
        .join(hot, "__hash", "left")
        .withColumn("__salt", F.when(F.expr(no_null), F.pmod("__spread", salts)).otherwise(F.col("__spread")))
        .drop("__spread", "__salts", "__hash")
    )
    right = (
        lookup.df.select(*cast, *[F.col(f"`{c}`") for c in lookup.df.columns if c not in keys])
        .withColumn("__hash", F.xxhash64(*names))
        .join(hot, "__hash", "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        .drop("__salts", "__hash")
    )
    return left.join(right, [*names, "__salt"], "left")
