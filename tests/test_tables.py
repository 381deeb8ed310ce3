import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.fixtures import HOUR, ROW, config
from viewflow import (
    SpecError,
    ViewSpec,
    create_all,
    create_tables,
    drop_expired,
    ingest_realtime,
    prepare,
    read_hybrid,
    roll_over,
)
from viewflow.functions import register_sql_functions
from viewflow.operators.tables import append_batch, first_batch, last_batch
from viewflow.spec import column

DAY = 24 * HOUR
# The row schema without defaults and constraints.
PLAIN = T.StructType([T.StructField(f.name, f.dataType) for f in ROW.fields])


def view(name, schema=None, **table):
    settings = config(name, **table)
    settings["view.output.schema"] = schema or ROW
    return ViewSpec.parse(settings)


@pytest.fixture
def pair(spark, unique):
    return create_tables(spark, view(unique))


def shaped(spark, pair, *times, tenant="t1", name="n"):
    data = [(tenant, name, t, t, t, None, ["f"], {"k": "v"}, 7, None) for t in times]
    return prepare(spark.createDataFrame(data, PLAIN), pair.realtime_spec)


def times(df):
    return sorted(r[0] for r in df.select("creation_time_millis").collect())


def test_two_tables_one_schema(spark, pair, unique):
    assert pair.realtime == f"{unique}_realtime" and pair.offline == f"{unique}_offline"
    realtime, offline = spark.table(pair.realtime), spark.table(pair.offline)
    assert realtime.columns[-3:] == ["batch_id", "bucket_start", "part_tenant_id"]
    # The offline settings have no partitioned column.
    assert offline.columns[-2:] == ["run_id", "bucket_start"]
    assert realtime.columns[:-3] == offline.columns[:-2]
    assert "bucket_start_time_millis" in realtime.columns


def test_create_again_and_widen(spark, unique, folder):
    first = view(unique)
    pair = create_tables(spark, first)
    append_batch(shaped(spark, pair, 5), pair, 0)
    assert create_tables(spark, first) == pair

    wider = T.StructType([*ROW.fields, column("city", T.StringType())])
    dimensions = [*config()["table"]["dimensionColumns"], "city"]
    wide = create_tables(spark, view(unique, wider, dimensionColumns=dimensions))
    assert "city" in spark.table(wide.offline).columns
    append_batch(shaped(spark, pair, 5, name="later").withColumn("city", F.lit("x")), wide, 1)
    # A writer that does not know the new column still works.
    append_batch(shaped(spark, pair, 6), pair, 2)
    assert rows(spark.table(pair.realtime).select("batch_id", "name", "city")) == [
        (0, "n", None),
        (1, "later", "x"),
        (2, "n", None),
    ]


def test_changed_type_raises(spark, pair, unique, folder):
    fields = [column("name", T.LongType()) if f.name == "name" else f for f in ROW.fields]
    settings = config(unique)
    settings["view.output.schema"] = T.StructType(fields)
    del settings["realtime"]["filterConfig"]
    with pytest.raises(SpecError, match="name"):
        create_tables(spark, ViewSpec.parse(settings))


def test_a_database_at_a_place(spark, unique, folder):
    pair = create_tables(spark, view("rows"), unique, f"{folder}/there")
    assert (pair.realtime, pair.offline) == (f"{unique}.rows_realtime", f"{unique}.rows_offline")
    assert create_tables(spark, view("rows"), unique) == pair
    append_batch(shaped(spark, pair, 0, DAY), pair, 0)
    roll_over(spark, pair, 10 * DAY)
    assert times(read_hybrid(spark, pair)) == [0, DAY]

    def stored(name):
        return glob.glob(f"{folder}/there/{name}/**/*.parquet", recursive=True)

    assert len(stored("rows_realtime")) == len(stored("rows_offline")) == 2
    drop_expired(spark, pair, 10 * DAY)
    # Expired files are gone, not only forgotten.
    assert stored("rows_realtime") == [] and len(stored("rows_offline")) == 2
    assert times(read_hybrid(spark, pair)) == [0, DAY]


@pytest.mark.parametrize("what", ["bucket", "partitions"])
def test_a_changed_layout_raises(spark, pair, unique, what):
    settings = config(unique)
    settings["view.output.schema"] = ROW
    if what == "bucket":
        settings["realtime"]["taskConfigs"]["RealtimeToOfflineSegmentsTask"]["bucketTimePeriod"] = "1d"
    else:
        settings["realtime"]["segmentPartitionConfig"]["columnPartitionMap"]["tenant_id"]["numPartitions"] = 8
    with pytest.raises(SpecError, match="stored by"):
        create_tables(spark, ViewSpec.parse(settings))


def test_several_views_stop_at_the_first_error(spark, unique, folder):
    bad = view(f"{unique}_b", timeColumn="name")
    with pytest.raises(SpecError):
        create_all(spark, [view(f"{unique}_a"), bad, view(f"{unique}_c")])
    made = [spark.catalog.tableExists(f"{unique}_{n}_realtime") for n in "abc"]
    assert made == [True, False, False]


def test_names_of_partition_columns_are_taken(spark, unique, folder):
    fields = T.StructType([*ROW.fields, column("batch_id", T.StringType())])
    dimensions = [*config()["table"]["dimensionColumns"], "batch_id"]
    with pytest.raises(SpecError, match="batch_id"):
        create_tables(spark, view(unique, fields, dimensionColumns=dimensions))


def test_a_batch_written_again_replaces_itself(spark, pair):
    append_batch(shaped(spark, pair, 1, 2 * DAY), pair, 0)
    append_batch(shaped(spark, pair, 3), pair, 1)
    append_batch(shaped(spark, pair, 1), pair, 0)
    assert times(spark.table(pair.realtime)) == [1, 3]
    assert last_batch(spark, pair) == 1


def test_overwrites_stay_within_the_batch_in_any_session_mode(spark, pair):
    try:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        append_batch(shaped(spark, pair, 1, 2 * DAY), pair, 0)
        append_batch(shaped(spark, pair, 1), pair, 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert times(spark.table(pair.realtime)) == [1]


def test_a_batch_replaced_in_another_session_is_seen(spark, pair):
    append_batch(shaped(spark, pair, 1, 2), pair, 0)
    assert times(read_hybrid(spark, pair)) == [1, 2]
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    register_sql_functions(other)
    append_batch(shaped(other, pair, 3, 4), pair, 0)
    assert times(read_hybrid(spark, pair)) == [3, 4]
    roll_over(spark, pair, DAY)
    assert times(read_hybrid(spark, pair)) == [3, 4]


def test_batch_numbers_go_on_after_a_new_checkpoint(spark, pair):
    assert first_batch(spark, pair, "/a") == 0
    append_batch(shaped(spark, pair, 1), pair, 0)
    append_batch(shaped(spark, pair, 2), pair, 1)
    assert first_batch(spark, pair, "/a") == 0
    assert first_batch(spark, pair, "/b") == 2
    assert first_batch(spark, pair, "/b") == 2


def test_roll_over_moves_complete_buckets_once(spark, pair):
    append_batch(shaped(spark, pair, 0, 6 * HOUR - 1, 6 * HOUR, 20 * HOUR), pair, 0)
    state = roll_over(spark, pair, 18 * HOUR)
    assert (state.run, state.boundary, state.batch) == (1, 6 * HOUR, 0)
    assert times(spark.table(pair.offline)) == [0, 6 * HOUR - 1]
    assert roll_over(spark, pair, 18 * HOUR) == state
    assert times(read_hybrid(spark, pair)) == [0, 6 * HOUR - 1, 6 * HOUR, 20 * HOUR]
    # An earlier moment takes nothing back.
    assert roll_over(spark, pair, 0) == state


def test_roll_over_of_an_empty_table(spark, pair):
    assert roll_over(spark, pair, DAY).run == 0
    assert read_hybrid(spark, pair).isEmpty()


def test_late_rows_are_moved_and_read_once(spark, pair):
    append_batch(shaped(spark, pair, 0, DAY), pair, 0)
    roll_over(spark, pair, DAY)
    append_batch(shaped(spark, pair, 1, DAY + 1), pair, 1)
    everything = [0, 1, DAY, DAY + 1]
    assert times(read_hybrid(spark, pair)) == everything
    assert roll_over(spark, pair, DAY).run == 2
    assert times(spark.table(pair.offline)) == [0, 1]
    assert times(read_hybrid(spark, pair)) == everything
    roll_over(spark, pair, 3 * DAY)
    assert times(spark.table(pair.offline)) == everything
    assert times(read_hybrid(spark, pair)) == everything


def test_any_order_of_batches_and_roll_overs_keeps_every_row(spark, pair):
    draw, written = random.Random(3), []
    for step in range(8):
        some = [draw.randrange(4 * DAY) for _ in range(6)]
        written += some
        append_batch(shaped(spark, pair, *some), pair, step)
        if draw.random() < 0.7:
            roll_over(spark, pair, draw.randrange(5 * DAY))
        if draw.random() < 0.3:
            drop_expired(spark, pair, 6 * DAY)
        assert times(read_hybrid(spark, pair)) == sorted(written)


def test_a_broken_run_is_repeated(spark, pair, monkeypatch):
    import viewflow.operators.tables as tables

    append_batch(shaped(spark, pair, 0, DAY), pair, 0)

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_set_property", broken)
        with pytest.raises(RuntimeError):
            roll_over(spark, pair, 3 * DAY)
    # Written but not counted: the rows are still read from the realtime table.
    assert times(spark.table(pair.offline)) == [0, DAY]
    assert times(read_hybrid(spark, pair)) == [0, DAY]
    # The repeated run covers less, and what the broken one had written beyond it is gone.
    assert roll_over(spark, pair, DAY).run == 1
    assert times(spark.table(pair.offline)) == [0]
    assert times(read_hybrid(spark, pair)) == [0, DAY]


def test_rows_without_time_or_before_1970_are_kept(spark, pair):
    append_batch(shaped(spark, pair, -1, None), pair, 0)
    # A null time takes the schema's default.
    roll_over(spark, pair, 3 * DAY)
    assert times(spark.table(pair.offline)) == [-1, -1]
    assert times(read_hybrid(spark, pair)) == [-1, -1]


def test_expiry_drops_old_partitions_only(spark, pair):
    append_batch(shaped(spark, pair, 0, 6 * HOUR, 5 * DAY), pair, 0)
    # Nothing was rolled over yet, so nothing may go.
    drop_expired(spark, pair, 10 * DAY)
    assert times(spark.table(pair.realtime)) == [0, 6 * HOUR, 5 * DAY]
    roll_over(spark, pair, 5 * DAY)
    append_batch(shaped(spark, pair, 1), pair, 1)
    # Three days in realtime: the first bucket ends before, the second is cut through.
    drop_expired(spark, pair, 3 * DAY + 7 * HOUR)
    assert times(spark.table(pair.realtime)) == [1, 6 * HOUR, 5 * DAY]
    assert times(read_hybrid(spark, pair)) == [0, 1, 6 * HOUR, 5 * DAY]
    # Ninety days in offline.
    roll_over(spark, pair, 5 * DAY)
    drop_expired(spark, pair, 91 * DAY)
    assert times(read_hybrid(spark, pair)) == [5 * DAY]


def test_rolled_files_are_sorted_and_no_row_changes(spark, pair):
    for batch in range(3):
        some = [shaped(spark, pair, batch, batch + 100, tenant=t) for t in ("b", "a")]
        append_batch(some[0].unionByName(some[1]), pair, batch)
    before = rows(read_hybrid(spark, pair))
    roll_over(spark, pair, DAY)
    assert rows(read_hybrid(spark, pair)) == before
    in_file = spark.table(pair.offline).select("tenant_id", "creation_time_millis", F.input_file_name().alias("f"))
    by_file = {}
    for r in in_file.collect():
        by_file.setdefault(r.f, []).append((r.tenant_id, r.creation_time_millis))
    assert all(v == sorted(v) for v in by_file.values()) and len(by_file) == 1


def raw(spark, *pairs):
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PLAIN)])
    data = [("k", (t, n, at, at, at, None, None, None, 7, {"x": 1.0})) for t, n, at in pairs]
    return spark.createDataFrame(data, schema)


def ingest(spark, pair, folder, checkpoint="c"):
    schema = spark.read.parquet(f"{folder}/topic").schema
    records = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/topic")
    query = ingest_realtime(spark, pair, f"{folder}/{checkpoint}", records, {"availableNow": True})
    query.awaitTermination()


def test_ingest_job_restarts_where_it_was(spark, pair, folder):
    raw(spark, ("t1", "n", 1), ("t2", "abcd-1234", 2), ("t3", None, 3)).coalesce(1).write.parquet(f"{folder}/topic")
    ingest(spark, pair, folder)
    ingest(spark, pair, folder)
    assert times(spark.table(pair.realtime)) == [1, 3]
    raw(spark, ("t4", "n", 4)).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
    ingest(spark, pair, folder)
    out = spark.table(pair.realtime)
    assert rows(out.select("name", "creation_time_millis", "scores__KEYS", "friends", "time_taken_millis")) == [
        ("n", 1, ["x"], ["null"], 7),
        ("n", 4, ["x"], ["null"], 7),
        ("null", 3, ["x"], ["null"], 7),
    ]


def test_ingest_goes_on_after_the_table_was_widened(spark, unique, folder):
    pair = create_tables(spark, view(unique))
    raw(spark, ("t1", "n", 1)).write.parquet(f"{folder}/topic")
    ingest(spark, pair, folder)
    wider = T.StructType([*ROW.fields, column("city", T.StringType())])
    create_tables(spark, view(unique, wider, dimensionColumns=[*config()["table"]["dimensionColumns"], "city"]))
    raw(spark, ("t1", "n", 2)).write.mode("append").parquet(f"{folder}/topic")
    ingest(spark, pair, folder)
    assert rows(spark.table(pair.realtime).select("creation_time_millis", "city")) == [(1, None), (2, None)]


def test_ingest_may_roll_up_each_batch(spark, unique, folder):
    pair = create_tables(spark, view(unique, aggregateMetrics=True))
    raw(spark, ("t1", "n", 1), ("t1", "n", 1), ("t1", "m", 1)).coalesce(1).write.parquet(f"{folder}/topic")
    ingest(spark, pair, folder)
    out = spark.table(pair.realtime).select("name", "time_taken_millis", "scores__KEYS", "tenant_id")
    assert rows(out) == [("m", 7, ["x"], "t1"), ("n", 14, ["x"], "t1")]


def stored_topic(spark, folder, *times):
    data = [("k", ("t1", "n", t, t, t, None, ["f"], {"k": "v"}, 7, None)) for t in times]
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PLAIN)])
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/topic")


@pytest.mark.parametrize("offset, wanted", [("largest", [3, 4, 5]), ("smallest", [1, 2, 3, 4, 5])])
def test_a_folder_is_read_from_the_start_offset_on(spark, pair, folder, offset, wanted):
    pair.realtime_spec.stream["stream.kafka.consumer.prop.auto.offset.reset"] = offset

    def run(checkpoint):
        name = f"{folder}/{checkpoint}"
        ingest_realtime(spark, pair, name, trigger={"availableNow": True}, folder=f"{folder}/topic").awaitTermination()

    stored_topic(spark, folder, 1, 2)
    run("a")
    stored_topic(spark, folder, 3)
    run("a")
    stored_topic(spark, folder, 4, 5)
    run("a")
    run("a")
    assert times(spark.table(pair.realtime)) == wanted
    # Another checkpoint starts at what is the end by now.
    run("b")
    assert times(spark.table(pair.realtime)) == (wanted if offset == "largest" else sorted(2 * wanted))


def test_an_empty_folder_has_no_end(spark, pair, folder):
    import os

    os.mkdir(f"{folder}/topic")
    for n in (0, 1):
        ingest_realtime(
            spark, pair, f"{folder}/a", trigger={"availableNow": True}, folder=f"{folder}/topic"
        ).awaitTermination()
        if not n:
            stored_topic(spark, folder, 1)
    assert times(spark.table(pair.realtime)) == [1]


def test_a_segment_has_no_more_rows_than_the_threshold(spark, unique):
    plan = view(unique)
    plan.config["realtime"]["streamConfigs"]["realtime.segment.flush.threshold.size"] = 40
    pair = create_tables(spark, plan)
    append_batch(shaped(spark, pair, *range(150)), pair, 0, files=1)
    sizes = spark.table(pair.realtime).groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in sizes) == 150 and max(r["count"] for r in sizes) == 40
    # The offline table's files are as large as they like.
    roll_over(spark, pair, "2024-01-01T00:00:00", files=1)
    assert spark.table(pair.offline).groupBy("_metadata.file_path").count().count() == 1
