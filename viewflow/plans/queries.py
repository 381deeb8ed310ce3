"""The registered queries. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.functions import (
    epoch_to_ts,
    ntz_to_epoch,
    partition_by_fields,
    partition_id,
    register_sql_functions,
    strcmp,
    time_bucket,
    ts_to_epoch,
)
from viewflow.operators.enrich import Context, enrich, measure_lookup
from viewflow.operators.ingest import ingest_filter, ingest_rollup, ingest_transform, prepare
from viewflow.operators.layout import arrange, part_filter, write_layout
from viewflow.operators.lifecycle import apply_retention, assign_tier, complete_rows, complete_until, hybrid_rows
from viewflow.operators.merge import merge_streams
from viewflow.operators.rollup import query_leaves, query_rollup, star_rollup, write_rollup
from viewflow.operators.shape import fill_defaults, shape, split_map, table_schema, truncate
from viewflow.operators.tables import create_tables, drop_expired, query_pair, read_hybrid, roll_over
from viewflow.operators.views import View, apply_view, conform, explode_view, projection_view, row_view, view_rows
from viewflow.plans.tables import (
    AS_OF,
    EVENT_COLUMNS,
    HOUR,
    SPAN_COLUMNS,
    SPAN_SCHEMA,
    event_records,
    span_rows,
    span_view_spec,
    stream_table,
    table,
    with_millis,
)
from viewflow.sources.codecs import decode_value, encode_value
from viewflow.sources.topics import SourceSet, Topic, ingest_source, keyed, publish
from viewflow.spec import StarTree, TableSpec, column
from viewflow.streaming.jobs import AVAILABLE_NOW, ViewJob, ingest_realtime, jobs_from_settings, run_views, work_dir
from viewflow.streaming.sinks import FileTarget, read_rollup, write_rollup_stream, write_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; a closing underscore tells it from an operator's."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


SPAN_VIEW = projection_view("span-view", SPAN_SCHEMA, SPAN_COLUMNS)


# Views


@query
def span_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span per event, under the event's key."""
    return view_rows(event_records(spark, sf_dir), SPAN_VIEW)


@query
def span_view_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output rows carry a processing time of their own, not the event's."""
    out = apply_view(event_records(spark, sf_dir), SPAN_VIEW)
    fresh = F.unix_millis("emit_time") > F.col("value.start_time_millis")
    return out.select("key", "value.span_id", fresh.alias("stamped"))


@query
def merge_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two whole inputs in one: orders and events by who made them; an event read twice comes twice."""
    events = table(spark, sf_dir, "events").selectExpr("event_id AS id", "event_type AS kind", "user_id AS maker")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS kind", "o_custkey AS maker")
    return merge_streams([events, orders, events])


@query
def flat_map_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per character of a document's source."""
    schema = T.StructType([column("pos", T.IntegerType()), column("letter", T.StringType())])
    rows = F.transform(
        F.split("source", ""), lambda c, i: F.struct((i + 1).alias("pos"), c.alias("letter"))
    )
    records = keyed(table(spark, sf_dir, "documents"), "doc_id", ["source"])
    return view_rows(records, explode_view("letters", schema, rows)).withColumn("pos", F.col("pos").cast("long"))


@query
def flat_map_zero_to_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No, one or two rows per event."""
    schema = T.StructType([column("event_id", T.LongType()), column("copy", T.LongType())])
    rows = (
        "CASE WHEN user_id % 3 > 0 THEN transform(sequence(1L, user_id % 3), "
        "i -> struct(event_id, i AS copy)) END"
    )
    return view_rows(event_records(spark, sf_dir), explode_view("copies", schema, rows))


@query
def row_function_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python row function: one row per line of a document's whole text."""

    def lines(record: dict) -> list[dict] | None:
        if not record["text"]:
            return None
        return [{"line_no": n, "n_chars": len(line)} for n, line in enumerate(record["text"].split("\n"), 1)]

    schema = T.StructType([column("line_no", T.LongType()), column("n_chars", T.LongType())])
    records = keyed(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return view_rows(records, row_view("lines", schema, lines, ["text"]))


@query
def row_drop_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the view's condition does not hold for give nothing out."""
    schema = T.StructType([column("event_id", T.LongType()), column("kind", T.StringType())])
    view = projection_view("purchases", schema, {"event_id": "event_id", "kind": "event_type"}, where="value >= 250")
    return view_rows(event_records(spark, sf_dir), view)


@query
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reorder, widen, drop what the schema does not name, add a missing column as null."""
    schema = T.StructType(
        [
            column("event_type", T.StringType()),
            column("value", T.DoubleType()),
            column("event_id", T.LongType()),
            column("region", T.StringType()),
        ]
    )
    return conform(table(spark, sf_dir, "events"), schema, strict=False)


ENRICHED = T.StructType(
    [
        column("o_orderkey", T.LongType()),
        column("c_name", T.StringType()),
        column("c_mktsegment", T.StringType()),
        column("n_name", T.StringType()),
    ]
)


def _enriched_orders(spark: SparkSession, sf_dir: str, max_rows: int, hot_rows: int, share: int) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    customers = customers.withColumnsRenamed({"c_custkey": "o_custkey", "c_nationkey": "n_nationkey"})
    context = Context(
        lookups={
            "customer": measure_lookup(customers, ["o_custkey"], max_rows),
            "nation": measure_lookup(
                table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), ["n_nationkey"]
            ),
        }
    )

    def transform(df: DataFrame, ctx: Context) -> DataFrame:
        return enrich(enrich(df, ctx.lookup("customer"), hot_rows, share), ctx.lookup("nation"))

    records = keyed(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey", "o_custkey"])
    return view_rows(records, View("orders", ENRICHED, transform), context)


@query
def enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and nation; both lookups are measured and fit a broadcast."""
    return _enriched_orders(spark, sf_dir, 1_000_000, 1_000_000, 4)


@query
def enrich_orders_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the customers taken as too many to broadcast: a join salted where keys are hot."""
    return _enriched_orders(spark, sf_dir, 0, 5, 1_000)


# Codecs and partitioners


@query
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON values to structs by a fixed schema."""
    records = encode_value(event_records(spark, sf_dir), "json")
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, millis BIGINT"
    return decode_value(records, schema, "json").select("key", "value.*")


@query
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Span values as JSON text."""
    return encode_value(apply_view(event_records(spark, sf_dir), SPAN_VIEW), "json").select("key", "value")


@query
def output_partitioner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view that says which output partition a row goes to."""
    view = projection_view(
        "span-view", SPAN_SCHEMA, SPAN_COLUMNS, partition_expr="pmod(start_time_millis div 3600000, 4)"
    )
    out = apply_view(event_records(spark, sf_dir), view)
    return out.select("key", "value.span_id", F.col("partition").cast("long").alias("partition"))


@query
def field_partitioner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition by field values where the topic is listed: one partition per value, none elsewhere."""
    fields = ["event_type", "user_id"]
    events = table(spark, sf_dir, "events").select(*fields)
    placed = partition_by_fields(events, fields, 8, "spans", "logs, spans")
    placed = partition_by_fields(placed, fields, 8, "traces", "logs, spans", name="other")
    return placed.groupBy(*fields).agg(
        F.count_distinct("partition").alias("partitions"),
        F.min(F.col("partition").between(0, 7)).alias("in_range"),
        F.count("other").alias("elsewhere"),
        F.count(F.lit(1)).alias("n"),
    )


# Shaping


@query
def split_props_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The props map as a key array and a value array."""
    props = F.from_json("props", "map<string,bigint>").alias("props")
    split = split_map(table(spark, sf_dir, "events").select("event_id", props), "props")
    return split.select(
        "event_id",
        F.array_join("props__KEYS", ",").alias("keys"),
        F.array_join(F.col("props__VALUES").cast("array<string>"), ",").alias("values"),
    )


@query
def split_built_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of several keys, given out of order, some values null: split in key order."""
    source = F.when(F.col("lang") != "en", F.col("source"))
    built = F.create_map(F.lit("source"), source, F.lit("lang"), F.col("lang"), F.lit("a"), F.lit("z")).alias("m")
    split = split_map(table(spark, sf_dir, "documents").select("doc_id", built), "m")
    return split.select(
        "doc_id",
        F.array_join("m__KEYS", ",").alias("keys"),
        F.array_join("m__VALUES", ",", "-").alias("values"),
    )


@query
def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls replaced by defaults, in a string, a number and an array."""
    kind = F.nullif("event_type", F.lit("click"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        kind.alias("kind"),
        F.nullif(F.pmod("user_id", F.lit(7)), F.lit(0)).alias("shard"),
        F.when(kind.isNotNull(), F.array(kind, kind)).alias("tags"),
    )
    schema = T.StructType(
        [
            column("kind", T.StringType(), "null"),
            column("shard", T.LongType(), -1),
            column("tags", T.ArrayType(T.StringType()), "none"),
        ]
    )
    filled = fill_defaults(events, schema)
    return filled.withColumn("tags", F.array_join("tags", ","))


@query
def null_defaults_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults first, then lengths: a default is cut too."""
    kind = F.nullif("event_type", F.lit("click")).alias("kind")
    schema = T.StructType([column("kind", T.StringType(), "null")])
    filled = fill_defaults(table(spark, sf_dir, "events").select("event_id", kind), schema)
    return truncate(filled, {"kind": 3})


@query
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings and the elements of string arrays cut to a length per column."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("head"), F.split("text", " ").alias("words")
    )
    cut = truncate(documents, {"head": 12, "words": 3})
    return cut.withColumn("words", F.array_join("words", " "))


def _span_spec(spark: SparkSession, bucket: str = "6h") -> TableSpec:
    return span_view_spec(spark, bucket=bucket).realtime()


@query
def role_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only columns with a role are kept; maps are split though unlisted."""
    spec = _span_spec(spark)
    shaped = shape(span_rows(table(spark, sf_dir, "events")), spec)
    names = [f.name for f in shaped.schema.fields]
    roles = ",".join(f"{f.name}:{f.metadata['role']}" for f in table_schema(spec).fields)
    return shaped.select(
        F.lit(",".join(names)).alias("columns"), F.lit(roles).alias("roles"), "tenant_id", "start_time_millis"
    )


@query
def shape_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way of a view row into the table: filter, derive, split, default, cut, project."""
    rows = prepare(span_rows(table(spark, sf_dir, "events")), _span_spec(spark))
    return _flat(rows)


def _flat(rows: DataFrame) -> DataFrame:
    """Array columns as text."""
    joined = {
        f.name: F.array_join(F.col(f.name).cast("array<string>"), ",")
        for f in rows.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    return rows.withColumns(joined)


@query
def epoch_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch numbers in every unit, to a timestamp and back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    units = ["MICROSECONDS", "MILLISECONDS", "SECONDS", "MINUTES", "HOURS", "DAYS"]
    epochs = orders.select("o_orderkey", *[ntz_to_epoch("o_orderdate", u).alias(u.lower()) for u in units])
    back = [ts_to_epoch(epoch_to_ts(u.lower(), u), u).alias(u.lower()) for u in units]
    nanos = ts_to_epoch(epoch_to_ts(F.col("microseconds") * 1000, "NANOSECONDS"), "NANOSECONDS")
    return epochs.select("o_orderkey", *back, nanos.alias("nanoseconds"))


# Ingest


@query
def ingest_filter_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for which the condition is true go; where it is null they stay."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("click")).alias("kind"), "user_id"
    )
    return ingest_filter(events, drop_when="kind = 'error' OR (kind IS NULL AND user_id < 10)")


@query
def ingest_filter_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positive form, which reaches the scan."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return ingest_filter(events, keep_when="event_type = 'purchase' AND user_id >= 10")


@query
def strcmp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String comparison as a column and as SQL."""
    register_sql_functions(spark)
    return table(spark, sf_dir, "events").select(
        "event_id",
        strcmp("event_type", F.lit("error")).alias("order"),
        F.expr("strcmp('purchase', event_type)").alias("reverse"),
    )


@query
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived columns in list order, the later from the earlier."""
    register_sql_functions(spark)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    derived = ingest_transform(
        lines,
        [
            ("cents", "cast(round(l_extendedprice * 100) as bigint)"),
            ("cents_net", "cents * (100 - cast(round(l_discount * 100) as bigint))"),
            ("price_band", "time_bucket(cents, 100000)"),
        ],
    )
    return derived.select("l_orderkey", "l_linenumber", "cents", "cents_net", "price_band")


@query
def time_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour."""
    events = with_millis(table(spark, sf_dir, "events").select("ts"))
    return events.groupBy(time_bucket("millis", HOUR).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def _rollup_spec(name: str = "rollup") -> TableSpec:
    schema = T.StructType(
        [
            column("user_id", T.LongType()),
            column("event_type", T.StringType()),
            column("hour", T.LongType()),
            column("total", T.LongType(), 0),
            column("n", T.LongType(), 0),
        ]
    )
    return TableSpec(
        name, schema, ["user_id", "event_type"], ["total", "n"], "hour", "MILLISECONDS", "3 DAYS"
    )


def _rollup_input(events: DataFrame) -> DataFrame:
    return ingest_transform(
        with_millis(events),
        [("hour", time_bucket("millis", HOUR)), ("total", "floor(value)"), ("n", "1L")],
    ).select("user_id", "event_type", "hour", "total", "n")


@query
def ingest_rollup_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics summed over equal dimensions and times."""
    events = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    return ingest_rollup(shape(_rollup_input(events), _rollup_spec()), _rollup_spec())


# Cubes

EVENT_TREE = StarTree(("shard", "event_type"), ("COUNT__event_id", "SUM__total"))
FULL_TREE = StarTree(
    ("shard", "event_type"),
    ("MIN__total", "MAX__total", "AVG__total", "DISTINCTCOUNTHLL__digit"),
    ("shard",),
)
LINE_TREE = StarTree(
    ("l_returnflag", "l_linestatus", "l_linenumber"), ("COUNT__l_orderkey", "SUM__cents", "MAX__cents")
)


WIDE_TREE = StarTree(
    ("l_returnflag", "l_linestatus", "l_linenumber", "discount", "tax"), ("COUNT__l_orderkey", "SUM__cents"), ("tax",)
)


def _cube_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.pmod("user_id", F.lit(5)).alias("shard"),
        "event_type",
        F.floor("value").alias("total"),
        (F.col("event_id") % 7 / 2).alias("digit"),
    )


def _line_input(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    number = F.col("l_linenumber").cast("long").alias("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", number, cents, *more)


@query
def star_rollup_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All subsets of the dimensions."""
    return star_rollup(_cube_input(spark, sf_dir), EVENT_TREE)


@query
def star_rollup_no_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subsets that keep a dimension which may not be starred."""
    tree = StarTree(EVENT_TREE.dims, EVENT_TREE.pairs, ("shard",))
    return star_rollup(_cube_input(spark, sf_dir), tree)


@query
def star_rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dimensions over the largest table."""
    return star_rollup(_line_input(spark, sf_dir), LINE_TREE)


@query
def star_rollup_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five dimensions, one of them never starred, the others starred in two steps."""
    percents = {c: F.round(F.col(f"l_{c}") * 100).cast("long").alias(c) for c in ("discount", "tax")}
    lines = _line_input(spark, sf_dir, *percents.values())
    return star_rollup(lines, WIDE_TREE, dims_per_step=2)


@query
def star_rollup_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pre-aggregation a table's own settings ask for, over its shaped rows."""
    spec = _span_spec(spark)
    rows = prepare(span_rows(table(spark, sf_dir, "events")), spec)
    return star_rollup(rows, spec.star_trees[0])


@query
def query_rollup_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GROUP BY one dimension, from the cube."""
    return query_rollup(star_rollup(_cube_input(spark, sf_dir), EVENT_TREE), EVENT_TREE, ["event_type"])


@query
def query_rollup_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GROUP BY one dimension with a condition on another, from the cube."""
    cube = star_rollup(_line_input(spark, sf_dir), LINE_TREE)
    return query_rollup(cube, LINE_TREE, ["l_returnflag"], {"l_linenumber": [1, 2, 3]})


@query
def query_rollup_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MIN, MAX, AVG and an approximate distinct count, over a dimension that is never starred."""
    cube = star_rollup(_cube_input(spark, sf_dir), FULL_TREE)
    answer = query_rollup(cube, FULL_TREE, ["event_type"])
    return answer.withColumn("AVG__total", F.round("AVG__total", 6))


@query
def query_rollup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube written by its flags and read back for one grouping set."""
    path = f"{work_dir(spark)}/cube"
    write_rollup(_line_input(spark, sf_dir), LINE_TREE, path)
    return query_rollup(spark.read.parquet(path), LINE_TREE, ["l_returnflag", "l_linestatus"])


@query
def query_rollup_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube stored without small starred groups; those come from the groups of all dimensions."""
    path, tree = f"{work_dir(spark)}/cube", StarTree(("user_id", "event_type", "day"), ("SUM__cents", "MAX__cents"), (), 40)
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.dayofmonth("ts").alias("day"), F.floor(F.col("value") * 100).alias("cents")
    )
    write_rollup(events, tree, path)
    cube = spark.read.parquet(path)
    by_user = query_leaves(cube, tree, ["user_id"], {"event_type": ["view", "error"]})
    by_day = query_leaves(cube, tree, ["event_type", "day"])
    nothing = {"event_type": F.lit(None).cast("string"), "day": F.lit(None).cast("int")}
    parts = by_user.withColumns(nothing).unionByName(by_day.withColumn("user_id", F.lit(None).cast("long")))
    return parts.select("user_id", "event_type", "day", F.col("SUM__cents").alias("cents"), F.col("MAX__cents").alias("most"))


# Layout


@query
def partition_id_hashcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition by Java's string hash."""
    value = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    ids = table(spark, sf_dir, "events").select(partition_id(value, "HashCode", 7).cast("long").alias("part"))
    return ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query
def partition_id_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hash over whole page addresses."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", partition_id("url", "HashCode", 16).cast("long").alias("part"))


@query
def partition_id_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ids = orders.select(partition_id("o_custkey", "Modulo", 13).cast("long").alias("part"))
    return ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query
def layout_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written partitioned, sorted, with bloom filters and plain columns, then read back."""
    spec = _span_spec(spark, "1d")
    path = f"{work_dir(spark)}/layout"
    write_layout(prepare(span_rows(table(spark, sf_dir, "events")), spec), spec, path)
    stored = spark.read.parquet(path)
    return _flat(stored).withColumn("part_tenant_id", F.col("part_tenant_id").cast("long"))


@query
def layout_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one tenant, from its partition's folders only."""
    spec = _span_spec(spark, "1d")
    path = f"{work_dir(spark)}/layout"
    write_layout(prepare(span_rows(table(spark, sf_dir, "events")), spec), spec, path)
    found = part_filter(spark.read.parquet(path), spec, "tenant_id", "tenant-3")
    return found.select("tenant_id", "span_id", "span_kind", "time_taken_millis")


@query
def layout_second_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the second of two range columns, from files cut along a curve through both."""
    path = f"{work_dir(spark)}/layout"
    ranges = ["l_shipdate", "l_extendedprice"]
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", *ranges)
    arrange(items, [], ranges, by_range=True, curve=ranges).write.parquet(path)
    found = spark.read.parquet(path).where("l_extendedprice >= 20000 AND l_extendedprice < 30000")
    return found.select("l_orderkey", "l_quantity", "l_extendedprice")


# Life cycle


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_millis(table(spark, sf_dir, "events").select("event_id", "ts")).withColumnRenamed("millis", "start_time_millis")


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last three days."""
    return apply_retention(_timed(spark, sf_dir), _span_spec(spark), AS_OF, "ts").drop("ts")


@query
def retention_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored rows: old buckets' folders are not read."""
    spec = _span_spec(spark, "1d")
    path = f"{work_dir(spark)}/layout"
    write_layout(prepare(span_rows(table(spark, sf_dir, "events")), spec), spec, path)
    kept = apply_retention(spark.read.parquet(path), spec, AS_OF)
    return kept.select("tenant_id", "span_id", "start_time_millis")


@query
def age_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per age tier."""
    tiered = assign_tier(_timed(spark, sf_dir), _span_spec(spark), AS_OF, default="hot")
    return tiered.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query
def age_tier_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept in one folder per tier; one tier read."""
    path = f"{work_dir(spark)}/tiers"
    tiered = assign_tier(_timed(spark, sf_dir).drop("ts"), _span_spec(spark), AS_OF, default="hot")
    tiered.write.partitionBy("tier").parquet(path)
    return spark.read.parquet(path).where("tier = 'warm'").select("event_id", "start_time_millis", "tier")


@query
def roll_over_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of complete six-hour buckets, twelve hours back."""
    return complete_rows(_timed(spark, sf_dir), _span_spec(spark), AS_OF, "ts").drop("ts")


@query
def hybrid_read_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline rows before the boundary, realtime rows after, though both tables overlap."""
    spec = _span_spec(spark)
    rows = _timed(spark, sf_dir)
    boundary = complete_until(spec, AS_OF)
    offline = complete_rows(rows, spec, AS_OF, "ts").drop("bucket_start")
    realtime = apply_retention(rows, spec, AS_OF, "ts")
    return hybrid_rows(
        offline.withColumn("origin", F.lit("offline")),
        realtime.withColumn("origin", F.lit("realtime")),
        spec,
        boundary,
        "ts",
    ).drop("ts")


# Streams


@query
def stream_span_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The span view as a stream over the events, written as a topic and read back."""
    folder = work_dir(spark)
    target = FileTarget(f"{folder}/spans")
    out = apply_view(event_records(spark, sf_dir, stream=True), SPAN_VIEW)
    write_view(out, target, f"{folder}/checkpoint", AVAILABLE_NOW).awaitTermination()
    return target.read(spark).select("key", "value.*")


@query
def stream_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over another view's topic; the first one's batches come again in between and add nothing."""
    folder = work_dir(spark)
    spans, late = FileTarget(f"{folder}/spans"), FileTarget(f"{folder}/late")
    next_view = projection_view("late", SPAN_SCHEMA, {**{c: c for c in SPAN_SCHEMA.names}, "span_kind": "upper(span_kind)"})
    for attempt in range(2):
        # A checkpoint lost after the batch was written: the stream writes the same batches again.
        first = event_records(spark, sf_dir, stream=True)
        write_view(first, spans, f"{folder}/first-{attempt}", AVAILABLE_NOW, SPAN_VIEW).awaitTermination()
        jobs = [ViewJob(next_view, ["spans"], late)]
        sources = SourceSet(spark, [spans.as_topic("spans", SPAN_SCHEMA)])
        run_views(jobs, sources, f"{folder}/second", trigger=AVAILABLE_NOW).awaitTermination()
    return late.read(spark).select("key", "value.*")


def _two_topics(spark: SparkSession, sf_dir: str, folder: str, codec: str = "struct") -> SourceSet:
    """Events published as two topics, by even and odd users, in one pass over them."""
    records = encode_value(event_records(spark, sf_dir).withColumn("odd", F.expr("value.user_id % 2")), codec)
    written = records.select("key", "value", "odd")
    written.write.partitionBy("odd").parquet(f"{folder}/topics")
    schema = written.drop("odd").schema
    return SourceSet(spark, [Topic(f"topic-{n}", path=f"{folder}/topics/odd={n}", schema=schema) for n in (0, 1)])


@query
def batch_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics read as one batch, each record with its topic."""
    folder = work_dir(spark)
    _two_topics(spark, sf_dir, folder)
    topics = [Topic(f"topic-{n}", path=f"{folder}/topics/odd={n}") for n in (0, 1)]
    merged = SourceSet(spark, topics, stream=False).merged(["topic-0", "topic-1"])
    return merged.select("topic", "key", "value.event_id")


RAW_SCHEMA = T.StructType([column("event_id", T.LongType()), column("event_type", T.StringType())])
RAW_VIEW = projection_view("raw-view", RAW_SCHEMA, {"event_id": "event_id", "event_type": "event_type"})


@query
def stream_multi_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two views in one query over shared topics; the second sees one topic only."""
    folder = work_dir(spark)
    settings = {
        "view.generators": ["span-view", "raw-view"],
        "span-view": {"input.topics": ["topic-0", "topic-1"], "output.topic": "spans"},
        "raw-view": {"input.topics": ["topic-0"], "output.topic": "raw", "kind.prefix": "raw-"},
    }

    def prefixed(df: DataFrame, ctx: Context) -> DataFrame:
        return df.withColumn("event_type", F.concat(F.lit(ctx.config["kind.prefix"]), "event_type"))

    views = {view.name: view for view in (SPAN_VIEW, View("raw-view", RAW_SCHEMA, prefixed))}
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, millis BIGINT"
    jobs = jobs_from_settings(settings, views, lambda name: FileTarget(f"{folder}/{name}"), schema, "json")
    sources = _two_topics(spark, sf_dir, folder, "json")
    run_views(jobs, sources, f"{folder}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    spans, raw = (job.target for job in jobs)
    first = spans.read(spark).select(F.lit("spans").alias("view"), "key", F.col("value.span_id").alias("id"))
    second = raw.read(spark).select(
        F.lit("raw").alias("view"), "key", F.concat("value.event_type", F.lit(" "), "value.event_id").alias("id")
    )
    return first.unionByName(second)


@query
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged topics, a lookup joined in, two outputs, one of them partitioned by the view."""
    folder = work_dir(spark)
    schema = T.StructType([column("event_id", T.LongType()), column("n_name", T.StringType())])

    def with_nation(df: DataFrame, ctx: Context) -> DataFrame:
        return enrich(df.withColumn("n_nationkey", F.expr("cast(user_id % 30 as int)")), ctx.lookup("nation"))

    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    context = Context(lookups={"nation": measure_lookup(nations, ["n_nationkey"])})
    located, raw = FileTarget(f"{folder}/located"), FileTarget(f"{folder}/raw")
    jobs = [
        ViewJob(View("located", schema, with_nation, "pmod(event_id, 3)"), ["topic-0", "topic-1"], located),
        ViewJob(RAW_VIEW, ["topic-1"], raw),
    ]
    sources = _two_topics(spark, sf_dir, folder)
    run_views(jobs, sources, f"{folder}/checkpoint", context, AVAILABLE_NOW).awaitTermination()
    first = located.read(spark).select("key", "value.*", F.col("partition").cast("long").alias("partition"))
    second = raw.read(spark).select(
        "key", "value.event_id", F.col("value.event_type").alias("n_name"), F.lit(-1).cast("long").alias("partition")
    )
    return first.unionByName(second)


@query
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a stream: every batch leaves its sums, which are added up on reading."""
    folder, spec = work_dir(spark), _rollup_spec()
    events = stream_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"])
    write_rollup_stream(
        _rollup_input(events), spec, f"{folder}/rollup", f"{folder}/checkpoint", AVAILABLE_NOW
    ).awaitTermination()
    return read_rollup(spark, spec, f"{folder}/rollup")


# Tables


def _ingested(spark: SparkSession, sf_dir: str, aggregate: bool = False, cubes: bool = False):
    """A table pair filled by two streams over topics with half the events each; the second comes late."""
    folder = work_dir(spark)
    view = span_view_spec(spark, "spans", aggregate, "1d", cubes)
    # A database of its own, beside the other scratch data.
    pair = create_tables(spark, view, f"viewflow_{uuid.uuid4().hex}", f"{folder}/tables")
    events = table(spark, sf_dir, "events").select(*EVENT_COLUMNS, "props")
    # The topic's values have the view's schema; an odd and an even half.
    values = keyed(span_rows(events), "tenant_id").withColumn("odd", F.expr("cast(value.span_id as bigint) % 2"))
    return pair, folder, values


def _publish_halves(records: DataFrame, folder: str) -> None:
    records.select("key", "value", "odd").write.partitionBy("odd").parquet(f"{folder}/topics")


def _run_ingest(spark: SparkSession, pair, folder: str, part: int) -> None:
    source = ingest_source(spark, pair.realtime_spec, f"{folder}/topics/odd={part}")
    ingest_realtime(spark, pair, f"{folder}/checkpoint-{part}", source, AVAILABLE_NOW).awaitTermination()


@query
def ingest_realtime_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic ingested into the realtime table by the table's own settings."""
    pair, folder, records = _ingested(spark, sf_dir)
    publish(records, f"{folder}/topics/odd=0")
    _run_ingest(spark, pair, folder, 0)
    stored = _flat(spark.table(pair.realtime))
    return stored.drop("batch_id").withColumn("part_tenant_id", F.col("part_tenant_id").cast("long"))


@query
def ingest_from_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that begins at its topic's end: the records that were there before are never read, later ones once."""
    pair, folder, records = _ingested(spark, sf_dir)
    pair.realtime_spec.stream["stream.kafka.consumer.prop.auto.offset.reset"] = "largest"
    for part in (0, 1):
        publish(records.where(F.col("odd") == part), f"{folder}/topics")
        # The second run goes on from the first one's checkpoint.
        ingest_realtime(
            spark, pair, f"{folder}/checkpoint", trigger=AVAILABLE_NOW, folder=f"{folder}/topics"
        ).awaitTermination()
    return spark.table(pair.realtime).select("tenant_id", "span_id", "start_time_millis", "time_taken_millis")


@query
def ingest_realtime_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each batch rolled up; sums over the table are those of the rows."""
    pair, folder, records = _ingested(spark, sf_dir, aggregate=True)
    _publish_halves(records, folder)
    for part in (0, 1):
        _run_ingest(spark, pair, folder, part)
    stored = spark.table(pair.realtime)
    return stored.groupBy("tenant_id", "span_kind", "bucket_start_time_millis").agg(
        F.sum("time_taken_millis").alias("time_taken_millis")
    )


def _rolled_over(spark: SparkSession, sf_dir: str, aggregate: bool = False, cubes: bool = False):
    """Ingest, roll over, late rows, roll over again."""
    pair, folder, records = _ingested(spark, sf_dir, aggregate, cubes)
    _publish_halves(records, folder)
    _run_ingest(spark, pair, folder, 0)
    roll_over(spark, pair, "2024-01-15T00:00:00")
    _run_ingest(spark, pair, folder, 1)
    roll_over(spark, pair, AS_OF)
    return pair


@query
def table_pair_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, roll over, late rows, roll over again, expire: every row is still read once."""
    pair = _rolled_over(spark, sf_dir)
    drop_expired(spark, pair, AS_OF)
    return read_hybrid(spark, pair).select("tenant_id", "span_id", "start_time_millis", "time_taken_millis")


@query
def pair_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables as one at a later moment: rows past their table's retention are hidden, not yet dropped."""
    pair = _rolled_over(spark, sf_dir)
    return read_hybrid(spark, pair, "2024-04-15T00:00:00").select("tenant_id", "span_id", "start_time_millis")


@query
def pair_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one age tier of both tables."""
    pair = _rolled_over(spark, sf_dir)
    return read_hybrid(spark, pair, AS_OF, "warm").select("tenant_id", "span_id", "start_time_millis")


@query
def pair_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches rolled up each, merged again by the roll-over, summed over both tables."""
    pair = _rolled_over(spark, sf_dir, aggregate=True)
    return read_hybrid(spark, pair).groupBy("tenant_id", "span_kind", "bucket_start_time_millis").agg(
        F.sum("time_taken_millis").alias("time_taken_millis")
    )


@query
def pair_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups over both tables, answered from the cubes that two roll-overs kept up and the rows not moved yet."""
    pair = _rolled_over(spark, sf_dir, cubes=True)
    # The first reads the small cube, the second the one that has the hour.
    by_tenant = query_pair(spark, pair, ["tenant_id"], {"span_kind": ["null", "view"]})
    by_hour = query_pair(spark, pair, ["bucket_start_time_millis", "span_kind"])
    parts = by_tenant.withColumns({"bucket_start_time_millis": F.lit(None).cast("long"), "span_kind": F.lit(None).cast("string")})
    return parts.unionByName(by_hour.withColumn("tenant_id", F.lit(None).cast("string"))).select(
        "tenant_id",
        "span_kind",
        "bucket_start_time_millis",
        F.col("COUNT__span_id").alias("spans"),
        F.col("SUM__time_taken_millis").alias("time_taken_millis"),
        F.col("MAX__end_time_millis").alias("last_end"),
    )
