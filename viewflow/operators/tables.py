"""The realtime and offline tables of a view: creation, roll-over, expiry, reading both as one."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.functions.text import register_sql_functions
from viewflow.operators.cubes import answered, cheapest_cube, create_cubes, cube_table, write_cubes
from viewflow.operators.ingest import ingest_rollup, prepare
from viewflow.operators.layout import (
    BUCKET,
    add_partitions,
    arrange,
    order_columns,
    parquet_options,
    partition_column,
    partition_columns,
)
from viewflow.operators.lifecycle import Moment, apply_retention, complete_until, in_tier, retention_start
from viewflow.sources.topics import flush_rows, newest_file
from viewflow.spec import SpecError, TableSpec, ViewSpec

BATCH, RUN = "batch_id", "run_id"
_STATE, _LAST_BATCH, _LAYOUT = "viewflow.rollover", "viewflow.batch", "viewflow.layout"


@dataclass(frozen=True)
class TablePair:
    """Names and specs of the two tables of one view."""

    realtime: str
    offline: str
    realtime_spec: TableSpec
    offline_spec: TableSpec


def table_pair(view: ViewSpec, database: str | None = None) -> TablePair:
    realtime, offline = view.realtime(), view.offline()
    place = f"{database}." if database else ""
    names = f"{place}{realtime.table_name}_realtime", f"{place}{offline.table_name}_offline"
    return TablePair(*names, realtime, offline)


def row_schema(spark: SparkSession, spec: TableSpec) -> T.StructType:
    """Columns of the shaped rows, derived columns included."""
    return prepare(spark.createDataFrame([], spec.schema), spec).schema


def _typed(columns: T.StructType) -> str:
    parts = []
    for f in columns.fields:
        role = f.metadata.get("role")
        comment = f" COMMENT '{role}'" if role else ""
        parts.append(f"`{f.name}` {f.dataType.simpleString()}{comment}")
    return ", ".join(parts)


def _layout(spec: TableSpec) -> str:
    """What decides a row's folder and may not change once there are rows."""
    return json.dumps({"bucket": spec.period(spec.bucket_period), "partitions": spec.partitions}, sort_keys=True)


def _ensure_table(
    spark: SparkSession,
    name: str,
    columns: T.StructType,
    partitions: T.StructType,
    spec: TableSpec,
    own: str,
) -> None:
    """Create the table, or add to an existing one the columns it lacks."""
    if not spark.catalog.tableExists(name):
        # An overwrite replaces all of a batch or run, whatever the session's own setting is.
        options = {"partitionOverwriteMode": "static", **parquet_options(spec, columns)}
        if own == BATCH and flush_rows(spec):
            options["maxRecordsPerFile"] = str(flush_rows(spec))
        settings = ", ".join(f"'{key}' = '{value}'" for key, value in options.items())
        layout = f"TBLPROPERTIES ('{_LAYOUT}' = '{_layout(spec)}')"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_typed(columns)}, {_typed(partitions)}) "
            f"USING parquet OPTIONS ({settings}) "
            f"PARTITIONED BY ({', '.join(f'`{f.name}`' for f in partitions.fields)}) {layout}"
        )
        return
    written = _properties(spark, name).get(_LAYOUT)
    if written != _layout(spec):
        # Rows already stored lie in folders by the old numbers.
        raise SpecError(f"table {name}: stored by {written}, the spec has {_layout(spec)}")
    present = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields}
    for f in [*columns.fields, *partitions.fields]:
        wanted = f.dataType.simpleString()
        if present.get(f.name, wanted) != wanted:
            raise SpecError(f"table {name}: column {f.name} is {present[f.name]}, the view has {wanted}")
    gone = [f.name for f in partitions.fields if f.name not in present]
    if gone:
        raise SpecError(f"table {name}: partition columns cannot be added: {gone}")
    new = [f for f in columns.fields if f.name not in present]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_typed(T.StructType(new))})")


def create_tables(
    spark: SparkSession, view: ViewSpec, database: str | None = None, location: str | None = None
) -> TablePair:
    """Check the schema, then create or widen the realtime and the offline table. Safe to repeat.

    The tables are the catalog's own, so that dropping a partition deletes its files. A ``database``
    that does not exist is created, at ``location`` if given. Each pre-aggregation of the offline settings
    gets a cube table. Bloom filters and dictionaries are as
    the spec had them when the table was created.
    """
    register_sql_functions(spark)
    pair = table_pair(view, database)
    if database:
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, spec, own in (
        (pair.realtime, pair.realtime_spec, BATCH),
        (pair.offline, pair.offline_spec, RUN),
    ):
        # Both tables hold the same columns: what the realtime settings derive comes along.
        columns = row_schema(spark, pair.realtime_spec)
        parts = [T.StructField(own, T.LongType()), T.StructField(BUCKET, T.LongType())]
        parts += [T.StructField(partition_column(c), T.IntegerType()) for c in spec.partitions]
        clash = {f.name for f in parts} & set(columns.names)
        if clash:
            raise SpecError(f"table {name}: columns used for partitioning: {sorted(clash)}")
        _ensure_table(spark, name, columns, T.StructType(parts), spec, own)
    create_cubes(spark, pair.offline, pair.offline_spec.star_trees, RUN)
    return pair


def create_all(spark: SparkSession, views: Iterable[ViewSpec], database: str | None = None) -> list[TablePair]:
    """Tables of several views, in order; the first error stops, earlier tables stay."""
    return [create_tables(spark, view, database) for view in views]


def _replace(
    rows: DataFrame, table: str, spec: TableSpec, own: str, number: int, files: int | None, by_range: bool
) -> None:
    """Write shaped rows in the table's layout as one batch or run, in place of what it had written."""
    spark = rows.sparkSession
    parts = partition_columns(spec)
    rows = arrange(add_partitions(rows, spec), parts, order_columns(spec), files, by_range, spec.range_columns)
    known = set(rows.columns)
    # A column the table had before this spec is filled with nulls.
    fields = [f for f in spark.table(table).schema.fields if f.name not in {own, *parts}]
    columns = [
        F.col(f"`{f.name}`") if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in fields
    ]
    # The fixed partition value makes the overwrite clear all that batch or run, and nothing else.
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({own} = {number}, {', '.join(f'`{p}`' for p in parts)}) "
        "SELECT * FROM {rows}",
        rows=rows.select(*columns, *parts),
    )


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{value}')")


def last_batch(spark: SparkSession, pair: TablePair) -> int:
    """Number of the last batch written whole, -1 before the first."""
    return int(_properties(spark, pair.realtime).get(_LAST_BATCH, -1))


def first_batch(spark: SparkSession, pair: TablePair, checkpoint: str) -> int:
    """Number the table gives to batch 0 of a stream.

    A restarted stream keeps its numbers; one with a new checkpoint, which counts from 0 again,
    goes on after the batches the table has. One stream at a time writes a table.
    """
    path = checkpoint.rstrip("/")
    name = f"viewflow.first.{hashlib.sha256(path.encode()).hexdigest()}"
    known = _properties(spark, pair.realtime)
    if name not in known:
        known[name] = json.dumps({"first": last_batch(spark, pair) + 1, "path": path})
        _set_property(spark, pair.realtime, name, known[name])
    found = json.loads(known[name])
    if found["path"] != path:
        raise SpecError(f"table {pair.realtime}: {path} and {found['path']} have one name")
    return int(found["first"])


def first_file(spark: SparkSession, pair: TablePair, checkpoint: str, topic: str) -> int:
    """After which moment a stream with this checkpoint reads the files of a topic folder it began at the end of.

    The moment is that of the newest file there when it is asked for first; a restarted stream keeps it.
    """
    name = f"viewflow.start.{hashlib.sha256(json.dumps([checkpoint.rstrip('/'), topic]).encode()).hexdigest()}"
    known = _properties(spark, pair.realtime)
    if name not in known:
        known[name] = str(newest_file(spark, topic))
        _set_property(spark, pair.realtime, name, known[name])
    return int(known[name])


def append_batch(rows: DataFrame, pair: TablePair, batch_id: int, files: int | None = None) -> None:
    """Write one batch of shaped rows to the realtime table; written again, it replaces itself.

    A file of the table is a segment: it has no more rows than the stream settings' threshold at its creation.
    """
    _replace(rows, pair.realtime, pair.realtime_spec, BATCH, batch_id, files, by_range=False)
    # Counted only now: a roll-over at the same time must not take a batch half written for whole.
    last = max(batch_id, last_batch(rows.sparkSession, pair))
    _set_property(rows.sparkSession, pair.realtime, _LAST_BATCH, str(last))


@dataclass(frozen=True)
class RollState:
    """What has been moved: the rows of batches up to ``batch`` in buckets ended by ``boundary``."""

    run: int = 0
    boundary: int | None = None
    batch: int = -1


def roll_state(spark: SparkSession, pair: TablePair) -> RollState:
    found = _properties(spark, pair.offline)
    return RollState(**json.loads(found[_STATE])) if _STATE in found else RollState()


def _ended(pair: TablePair, boundary: int) -> Column:
    """Whether a realtime row's bucket has ended: a bare comparison, which a catalog can take."""
    spec = pair.realtime_spec
    return F.col(BUCKET) <= F.lit(boundary - spec.period(spec.bucket_period))


def _fresh(rows: DataFrame, pair: TablePair, state: RollState, boundary: int, batch: int) -> DataFrame:
    """Realtime rows that the next roll-over moves: of buckets newly ended, and late ones of earlier buckets.

    A row without a bucket is never moved.
    """
    rows = rows.where(F.col(BATCH) <= F.lit(batch)).where(_ended(pair, boundary))
    if state.boundary is None:
        return rows
    spec = pair.realtime_spec
    later = rows.where(F.col(BUCKET) > F.lit(state.boundary - spec.period(spec.bucket_period)))
    late = rows.where(_ended(pair, state.boundary)).where(F.col(BATCH) > F.lit(state.batch))
    return later.unionByName(late)


def _unmoved(rows: DataFrame, pair: TablePair, state: RollState) -> DataFrame:
    """Realtime rows that no roll-over has moved: open buckets, late rows, rows without a bucket."""
    if state.boundary is None:
        return rows
    spec = pair.realtime_spec
    still_open = rows.where(F.col(BUCKET) > F.lit(state.boundary - spec.period(spec.bucket_period)))
    late = rows.where(_ended(pair, state.boundary)).where(F.col(BATCH) > F.lit(state.batch))
    return still_open.unionByName(late).unionByName(rows.where(F.col(BUCKET).isNull()))


def _refreshed(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now: streams write in a session of their own, whose file lists ours does not see."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _row_columns(spark: SparkSession, pair: TablePair) -> list[str]:
    hidden = {BUCKET, BATCH, *partition_columns(pair.realtime_spec)}
    return [c for c in spark.table(pair.realtime).columns if c not in hidden]


def roll_over(spark: SparkSession, pair: TablePair, as_of: Moment, files: int | None = None) -> RollState:
    """Move the rows of complete buckets to the offline table, in larger files cut along its order.

    Only what earlier runs have not moved is read, rows that came late into a moved bucket
    included. The cubes of the pair get what the run has moved. A run counts once the table property is set after
    all of it; one that broke off before is simply repeated under the same number and replaces what it had written.
    """
    state = roll_state(spark, pair)
    batch = last_batch(spark, pair)
    if batch < 0:
        return state
    earlier = state.boundary if state.boundary is not None else -(1 << 62)
    boundary = max(complete_until(pair.realtime_spec, as_of), earlier)
    if (boundary, batch) == (state.boundary, state.batch):
        return state
    fresh = _fresh(_refreshed(spark, pair.realtime), pair, state, boundary, batch)
    done = RollState(state.run + 1, boundary, batch)
    fresh = fresh.select(*_row_columns(spark, pair))
    if pair.realtime_spec.aggregate_metrics:
        # Batches were rolled up each: their groups become one here.
        fresh = _rolled(fresh, pair)
    # Written once and read often: worth a sample of the rows.
    _replace(fresh, pair.offline, pair.offline_spec, RUN, done.run, files, by_range=True)
    write_cubes(spark, pair.offline, pair.offline_spec.star_trees, RUN, done.run)
    _set_property(spark, pair.offline, _STATE, json.dumps(vars(done)))
    return done


def _rolled(rows: DataFrame, pair: TablePair) -> DataFrame:
    return ingest_rollup(rows, pair.realtime_spec).select(*rows.columns)


def read_hybrid(spark: SparkSession, pair: TablePair, as_of: Moment | None = None, tier: str | None = None) -> DataFrame:
    """All rows of both tables, each once. Which half a row is read from follows from partition
    columns alone, so only the needed folders are listed and read.

    With ``as_of``, rows older than their table's retention are left out, dropped yet or not. With a ``tier``
    too, only rows of that age are read; a bucket that lies wholly outside is not listed.
    """
    state = roll_state(spark, pair)
    columns = _row_columns(spark, pair)
    offline = _refreshed(spark, pair.offline).where(F.col(RUN) <= F.lit(state.run))
    realtime = _unmoved(_refreshed(spark, pair.realtime), pair, state)
    if tier is not None and as_of is None:
        raise SpecError("a tier follows from the age at a moment: give as_of")
    if as_of is not None:
        offline = apply_retention(offline, pair.offline_spec, as_of)
        realtime = apply_retention(realtime, pair.realtime_spec, as_of)
    if tier is not None:
        offline, realtime = (in_tier(half, pair.realtime_spec, tier, as_of) for half in (offline, realtime))
    return offline.select(*columns).unionByName(realtime.select(*columns))


def query_pair(
    spark: SparkSession,
    pair: TablePair,
    group_by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
    pairs: Sequence[str] | None = None,
    as_of: Moment | None = None,
) -> DataFrame:
    """Answer ``GROUP BY group_by`` over both tables from the pair's cubes and the rows that were not moved yet.

    Of the cubes that have the dimensions and pairs, the one with the fewest stored groups is read; offline rows are
    not. With ``as_of``, rows past their table's retention are left out: then the one offline bucket that the
    retention cuts through is read too. Raises where no cube covers the query.
    """
    trees = pair.offline_spec.star_trees
    number = cheapest_cube(spark, pair.offline, trees, set(group_by) | set(where or {}), pairs)
    state = roll_state(spark, pair)
    cube = _refreshed(spark, cube_table(pair.offline, number)).where(F.col(RUN) <= F.lit(state.run))
    realtime = _unmoved(_refreshed(spark, pair.realtime), pair, state)
    rows = []
    if as_of is not None:
        spec = pair.offline_spec
        start = retention_start(spec, as_of)
        width = spec.period(spec.bucket_period)
        cube = cube.where(F.col(BUCKET) >= F.lit(start))
        cut = _refreshed(spark, pair.offline).where(F.col(RUN) <= F.lit(state.run))
        cut = cut.where((F.col(BUCKET) < F.lit(start)) & (F.col(BUCKET) > F.lit(start - width)))
        rows.append(apply_retention(cut, spec, as_of).select(*_row_columns(spark, pair)))
        realtime = apply_retention(realtime, pair.realtime_spec, as_of)
    rows.append(realtime.select(*_row_columns(spark, pair)))
    return answered([cube], rows, trees[number], group_by, where, pairs)


def _drop_partitions(spark: SparkSession, table: str, expired: Column) -> None:
    """Drop whole partitions by a condition on ``bucket`` (and the partition text)."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").withColumn(
        "bucket", F.regexp_extract("partition", rf"(?:^|/){BUCKET}=(-?\d+)", 1).try_cast("long")
    )
    # Partition names are catalog metadata: their number is that of folders, not of rows.
    names = (row["partition"] for row in listed.where(expired).toLocalIterator())
    while some := list(islice(names, 100)):
        parts = []
        for name in some:
            fields = ", ".join(f"`{k}`='{v}'" for k, v in (part.split("=", 1) for part in name.split("/")))
            parts.append(f"PARTITION ({fields})")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(parts)}")


def drop_expired(spark: SparkSession, pair: TablePair, as_of: Moment) -> None:
    """Drop the partitions of both tables that lie wholly before the retention.

    Realtime rows not yet rolled over stay until they are, however old. A bucket the retention cuts
    through stays too; ``apply_retention`` hides its expired rows.
    """
    state = roll_state(spark, pair)
    for table, spec in ((pair.realtime, pair.realtime_spec), (pair.offline, pair.offline_spec)):
        width = spec.period(spec.bucket_period)
        expired = F.col("bucket") + F.lit(width) <= F.lit(retention_start(spec, as_of))
        if table == pair.realtime:
            if state.boundary is None:
                continue
            batch = F.regexp_extract("partition", rf"(?:^|/){BATCH}=(\d+)", 1).try_cast("long")
            ended = F.col("bucket") + F.lit(width) <= F.lit(state.boundary)
            expired = expired & ended & (batch <= F.lit(state.batch))
        _drop_partitions(spark, table, expired)
        for number in range(len(spec.star_trees) if table == pair.offline else 0):
            _drop_partitions(spark, cube_table(table, number), expired)
