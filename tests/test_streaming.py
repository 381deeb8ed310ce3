import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.fixtures import ROW, SPAN, SPAN_RECORD, config
from viewflow import (
    Context,
    FileTarget,
    KafkaTarget,
    SourceSet,
    SpecError,
    Topic,
    View,
    ViewJob,
    ViewSpec,
    apply_view,
    decode_value,
    encode_value,
    enrich,
    ingest_realtime,
    jobs_from_settings,
    keyed,
    measure_lookup,
    projection_view,
    publish,
    run_views,
    topic_source,
    write_view,
)
from viewflow.operators.tables import table_pair
from viewflow.sources.codecs import VALUE_CODEC_ENV, avro_schema
from viewflow.sources.topics import ingest_codec, ingest_source, ingest_topic, ingest_trigger, stream_path
from viewflow.spec import TableSpec, column
from viewflow.streaming.commits import commit_once
from viewflow.streaming.jobs import check_jobs, work_dir
from viewflow.streaming.sinks import read_rollup, write_rollup_stream

COPY = projection_view("spans", SPAN, {f.name: f.name for f in SPAN.fields})
KINDS = projection_view("kinds", T.StructType([column("kind", T.StringType())]), {"kind": "span_kind"})
NOW = {"availableNow": True}


def topic(spark, folder, name, *pairs):
    return publish(spark.createDataFrame(list(pairs), SPAN_RECORD).coalesce(1), f"{folder}/{name}")


def span(name, kind="span-kind"):
    return (name, 10, 1010, kind)


def run(spark, folder, jobs, topics, context=None):
    query = run_views(jobs, SourceSet(spark, topics), f"{folder}/checkpoint", context, NOW)
    query.awaitTermination()
    return query


def test_one_view_over_two_topics(spark, folder):
    topics = [
        topic(spark, folder, "t1", (None, span("a")), ("k", span("b"))),
        topic(spark, folder, "t2", (None, span("c"))),
    ]
    target = FileTarget(f"{folder}/out")
    run(spark, folder, [ViewJob(COPY, ["t1", "t2"], target)], topics)
    out = target.read(spark)
    assert rows(out.select("key", "value.*")) == [("k", *span("b")), (None, *span("a")), (None, *span("c"))]
    assert out.where("emit_time IS NULL").isEmpty()


def test_views_see_their_own_topics_only(spark, folder):
    topics = [
        topic(spark, folder, "t1", (None, span("a", "x")), ("k1", span("b", "y"))),
        topic(spark, folder, "t2", ("k2", span("c", "z"))),
    ]
    spans, kinds = FileTarget(f"{folder}/spans"), FileTarget(f"{folder}/kinds")
    jobs = [ViewJob(KINDS, ["t1"], kinds), ViewJob(COPY, ["t1", "t2"], spans)]
    run(spark, folder, jobs, topics)
    assert rows(spans.read(spark).select("key", "value.span_id")) == [("k1", "b"), ("k2", "c"), (None, "a")]
    assert rows(kinds.read(spark).select("key", "value.kind")) == [("k1", "y"), (None, "x")]


def test_jobs_from_settings(spark, folder):
    topics = [topic(spark, folder, "t1", ("k1", span("a", "x"))), topic(spark, folder, "t2", ("k2", span("c", "z")))]
    settings = {
        "view.generators": ["raw", "spans"],
        "raw": {"input.topics": ["t1"], "output.topic": "kinds"},
        "spans": {"input.topics": ["t1", "t2"], "output.topic": "spans"},
    }

    def target(name):
        return FileTarget(f"{folder}/{name}")

    run(spark, folder, jobs_from_settings(settings, {"raw": KINDS, "spans": COPY}, target), topics)
    assert rows(target("kinds").read(spark).select("key", "value.kind")) == [("k1", "x")]
    assert target("spans").read(spark).count() == 2
    alone = jobs_from_settings({"input": {"topics": ["t2"]}, "output.topic": "one"}, {"any": COPY}, target)
    assert [(job.inputs, job.target) for job in alone] == [(["t2"], target("one"))]
    with pytest.raises(SpecError, match="list"):
        jobs_from_settings({}, {"a": COPY, "b": KINDS}, target)
    with pytest.raises(SpecError, match="spans"):
        jobs_from_settings(settings, {"raw": KINDS}, target)
    del settings["raw"]["output.topic"]
    with pytest.raises(SpecError, match="output.topic"):
        jobs_from_settings(settings, {"raw": KINDS, "spans": COPY}, target)


def test_restart_adds_only_new_records(spark, folder):
    topics = [topic(spark, folder, "t1", ("k", span("a")))]
    target = FileTarget(f"{folder}/out")
    jobs = [ViewJob(COPY, ["t1"], target)]
    run(spark, folder, jobs, topics)
    run(spark, folder, jobs, topics)
    assert target.read(spark).count() == 1
    topic(spark, folder, "t1", ("k", span("b")))
    run(spark, folder, jobs, topics)
    assert rows(target.read(spark).select("value.span_id")) == [("a",), ("b",)]


def test_a_failing_view_stops_the_query_and_the_batch_is_run_again(spark, folder):
    topics = [topic(spark, folder, "t1", ("k", span("a")))]

    def fail(df, ctx):
        return df.select("__key", F.raise_error(F.lit("broken")).cast("string").alias("kind"))

    good, bad = FileTarget(f"{folder}/good"), FileTarget(f"{folder}/bad")
    with pytest.raises(Exception, match="broken"):
        run(spark, folder, [ViewJob(COPY, ["t1"], good), ViewJob(View("b", KINDS.schema, fail), ["t1"], bad)], topics)
    run(spark, folder, [ViewJob(COPY, ["t1"], good), ViewJob(KINDS, ["t1"], bad)], topics)
    assert good.read(spark).count() == 1 and bad.read(spark).count() == 1


@pytest.mark.parametrize("codec", ["struct", "json"])
@pytest.mark.parametrize("placed", [None, "start_time_millis % 3"])
def test_output_of_a_view_is_a_topic_for_the_next(spark, folder, codec, placed):
    made = topic(spark, folder, "t1", ("k", span("a", "x")), (None, span("b", "y")))
    middle, last = FileTarget(f"{folder}/middle", codec=codec), FileTarget(f"{folder}/last")
    first = replace(COPY, partition_expr=placed)
    run(spark, f"{folder}/1", [ViewJob(first, ["t1"], middle)], [made])
    second = middle.as_topic("spans", T.StringType() if codec == "json" else SPAN, placed is not None)
    for _ in range(2):
        run(spark, f"{folder}/2", [ViewJob(KINDS, ["spans"], last, SPAN, codec)], [second])
    assert rows(last.read(spark).select("key", "value.kind")) == [("k", "x"), (None, "y")]


def test_each_topic_is_opened_once(spark, folder):
    sources = SourceSet(spark, [topic(spark, folder, "t1", ("k", span("a")))], stream=False)
    assert sources.get("t1") is sources.get("t1")
    assert rows(sources.merged(["t1"]).select("key", "topic")) == [("k", "t1")]
    with pytest.raises(SpecError):
        sources.get("t2")


def test_a_job_is_checked(spark, folder):
    target, other = FileTarget(f"{folder}/a"), FileTarget(f"{folder}/b")
    for jobs in (
        [],
        [ViewJob(COPY, [], target)],
        [ViewJob(COPY, ["t", "t"], target)],
        [ViewJob(COPY, ["t"], target), ViewJob(COPY, ["t"], other)],
        [ViewJob(COPY, ["t"], target), ViewJob(KINDS, ["t"], FileTarget(f"{folder}/a/"))],
    ):
        with pytest.raises(SpecError):
            check_jobs(jobs)
    with pytest.raises(SpecError):
        SourceSet(spark, [Topic("t"), Topic("t")])
    with pytest.raises(SpecError):
        topic_source(spark, Topic("t"))


@pytest.mark.parametrize("max_rows", [0, 10])
def test_lookup_and_partitioner_in_a_stream(spark, folder, max_rows):
    topics = [topic(spark, folder, "t1", *[(str(i), span(str(i), "x" if i % 2 else "y")) for i in range(50)])]
    schema = T.StructType([column("span_id", T.StringType()), column("n", T.LongType())])
    view = View("v", schema, lambda df, ctx: enrich(df, ctx.lookup("kinds")), "cast(span_id as int) % 3")
    kinds = spark.createDataFrame([("x", 1)], "span_kind string, n long")
    context = Context(lookups={"kinds": measure_lookup(kinds, ["span_kind"], max_rows)})
    assert context.lookup("kinds").small is (max_rows > 0)
    target = FileTarget(f"{folder}/out")
    run(spark, folder, [ViewJob(view, ["t1"], target)], topics, context)
    out = target.read(spark).select("value.*", "partition")
    assert rows(out) == sorted(((str(i), 1 if i % 2 else None, i % 3) for i in range(50)), key=repr)


def test_json_topics(spark, folder):
    records = encode_value(spark.createDataFrame([("k", span("a")), (None, span("b"))], SPAN_RECORD), "json")
    topics = [publish(records, f"{folder}/t1")]
    target = FileTarget(f"{folder}/out", codec="json")
    run(spark, folder, [ViewJob(COPY, ["t1"], target, SPAN, "json")], topics)
    back = decode_value(target.read(spark), SPAN, "json")
    assert rows(back.select("key", "value.*")) == [("k", *span("a")), (None, *span("b"))]


def test_views_may_decode_differently(spark, folder):
    records = encode_value(spark.createDataFrame([("k", span("a", "x"))], SPAN_RECORD), "json")
    topics = [publish(records, f"{folder}/t1")]
    narrow, wide = FileTarget(f"{folder}/narrow"), FileTarget(f"{folder}/wide")
    jobs = [ViewJob(KINDS, ["t1"], narrow, "span_kind STRING", "json"), ViewJob(COPY, ["t1"], wide, SPAN, "json")]
    run(spark, folder, jobs, topics)
    assert rows(narrow.read(spark).select("key", "value.*")) == [("k", "x")]
    assert rows(wide.read(spark).select("key", "value.*")) == [("k", *span("a", "x"))]


def test_a_value_that_cannot_be_decoded_fails_or_is_null(spark):
    df = spark.createDataFrame([("k", "{not json")], "key string, value string")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        decode_value(df, "a INT", "json").collect()
    assert decode_value(df, "a INT", "json", on_error="PERMISSIVE").first().value.a is None


def test_encoding_override(spark, monkeypatch):
    df = spark.createDataFrame([("k", (1,))], "key string, value struct<n: int>")
    assert encode_value(df).first().value.n == 1
    monkeypatch.setenv(VALUE_CODEC_ENV, "json")
    assert encode_value(df, "struct").first().value == '{"n":1}'
    monkeypatch.setenv(VALUE_CODEC_ENV, "no.such.Codec")
    with pytest.raises(SpecError, match="no.such.Codec"):
        encode_value(df)
    with pytest.raises(SpecError):
        decode_value(df, "n INT", "xml")


def test_avro_schema_of_a_view():
    assert avro_schema(T.StructType([column("a", T.LongType(), nullable=False), column("b", T.StringType())])) == (
        '{"type": "record", "name": "record", "fields": ['
        '{"name": "a", "type": "long"}, {"name": "b", "type": ["null", "string"]}]}'
    )
    assert '"items": ["null", "string"]' in avro_schema(ROW) and '"values": ["null", "double"]' in avro_schema(ROW)
    nested = T.StructType.fromDDL("d DATE, t TIMESTAMP, n DECIMAL(10,2), s STRUCT<a: BIGINT, m: MAP<STRING, DATE>>")
    text = avro_schema(nested)
    for part in ('"date"', '"timestamp-micros"', '"precision": 10', '"name": "record_s"', '"values": ["null", {"type": "int"'):
        assert part in text
    with pytest.raises(SpecError):
        avro_schema(T.StructType([column("v", T.VariantType())]))


def test_stream_and_batch_write_the_same(spark, folder):
    made = topic(spark, folder, "t1", ("k", span("a")), (None, span("b")))
    batch, stream = FileTarget(f"{folder}/batch"), FileTarget(f"{folder}/stream")
    assert write_view(apply_view(topic_source(spark, made, stream=False), COPY), batch) is None
    out = apply_view(topic_source(spark, made), COPY)
    with pytest.raises(ValueError):
        write_view(out, stream)
    write_view(out, stream, f"{folder}/checkpoint", NOW).awaitTermination()
    assert rows(batch.read(spark).select("key", "value.*")) == rows(stream.read(spark).select("key", "value.*"))


def test_a_batch_written_again_replaces_itself(spark, folder):
    target = FileTarget(folder)
    out = apply_view(spark.createDataFrame([("k", span("a"))], SPAN_RECORD), COPY)
    for batch in (0, 1, 1, 0):
        target.write(out, batch)
    assert target.read(spark).count() == 2


def test_keyed(spark):
    out = keyed(spark.range(1, 2).withColumn("x", F.lit("a")), "id", ["x"])
    assert out.schema["key"].dataType == T.StringType() and rows(out.select("key", "value.*")) == [("1", "a")]


def test_batches_of_file_topics_are_bounded(spark, folder, monkeypatch):
    import viewflow.sources.topics as topics

    df = spark.createDataFrame([(str(i), span(str(i))) for i in range(40)], SPAN_RECORD)
    made = publish(df.repartition(4), f"{folder}/t1")
    target = FileTarget(f"{folder}/out")
    monkeypatch.setattr(topics, "FILE_BATCH_BYTES", 1)
    run(spark, folder, [ViewJob(COPY, ["t1"], target)], [made])
    assert target.read(spark).count() == 40
    assert spark.read.parquet(f"{folder}/out").select("batch_id").distinct().count() == 4


def test_stream_path():
    assert stream_path("/a/b.parquet") == "/a/b.parque[t]" and stream_path("/a/*") == "/a/*"


def test_stream_settings():
    spec = ViewSpec.parse(config()).realtime()
    made = ingest_topic(spec)
    assert made.name == "test-view-events" and made.fmt == "kafka"
    assert made.options == {
        "kafka.bootstrap.servers": "localhost:9092",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500000",
    }
    assert ingest_trigger(spec) == {"processingTime": "3600000 milliseconds"}
    assert ingest_codec(spec) == "struct"
    for decoder, codec in (("a.SimpleAvroMessageDecoder", "avro"), ("a.JSONMessageDecoder", "json")):
        spec.stream["stream.kafka.decoder.class.name"] = decoder
        assert ingest_codec(spec) == codec
    spec.stream["stream.kafka.decoder.class.name"] = "a.RegistryAvroMessageDecoder"
    with pytest.raises(SpecError, match="decoder"):
        ingest_codec(spec)
    spec.stream["stream.kafka.consumer.prop.auto.offset.reset"] = "smallest"
    spec.stream["stream.kafka.min.partitions"] = 64
    assert ingest_topic(spec).options["startingOffsets"] == "earliest"
    assert ingest_topic(spec).options["minPartitions"] == "64"
    spec.stream["stream.kafka.consumer.prop.auto.offset.reset"] = "middle"
    with pytest.raises(SpecError):
        ingest_topic(spec)
    with pytest.raises(SpecError):
        ingest_topic(ViewSpec.parse(config()).offline())


def test_without_connectors_kafka_and_avro_say_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest_source(spark, ViewSpec.parse(config()).realtime())
    df = spark.createDataFrame([("k", bytearray(b"x"))], "key string, value binary")
    with pytest.raises(Exception, match="(?i)avro"):
        decode_value(df, ROW, "avro").collect()
    target = KafkaTarget("t", "localhost:9092", "json")
    assert target.name == "localhost:9092/t"
    with pytest.raises(Exception, match="(?i)kafka"):
        target.write(spark.createDataFrame([("k", (1,))], "key string, value struct<n: int>"), 0)


def test_kafka_needs_encoded_values_and_a_decoder(spark):
    df = spark.createDataFrame([("k", (1,))], "key string, value struct<n: int>")
    with pytest.raises(SpecError, match="encoded"):
        KafkaTarget("t", "localhost:9092", "struct").write(df, 0)
    with pytest.raises(SpecError, match="decoder"):
        ingest_realtime(spark, table_pair(ViewSpec.parse(config())), "/nowhere")


def test_work_folders_are_new_and_shared(spark):
    first, second = work_dir(spark), work_dir(spark)
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_a_streamed_rollup_keeps_every_row_however_batches_overlap(spark, folder, batches):
    schema = T.StructType([column("k", T.LongType()), column("hour", T.LongType()), column("n", T.LongType(), 0)])
    spec = TableSpec("rolled", schema, ["k"], ["n"], "hour", "MILLISECONDS", "90d")
    rows_in = spark.range(400).selectExpr("id % 3 AS k", "id * 7919 % 40 * 3600000 AS hour", "1L AS n", "id")
    for part in range(batches):
        # Each file spans the whole time, the later ones lie behind any watermark of the first.
        rows_in.where(f"id % {batches} = {part}").drop("id").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    write_rollup_stream(stream, spec, f"{folder}/sums", f"{folder}/checkpoint", NOW).awaitTermination()
    found = read_rollup(spark, spec, f"{folder}/sums")
    assert found.agg({"n": "sum"}).first()[0] == 400
    assert rows(found) == rows(rows_in.groupBy("k", "hour").agg({"n": "sum"}))


def test_a_large_lookup_is_joined_batch_by_batch(spark, folder):
    made = topic(spark, folder, "t1", ("k", span("a")), (None, span("b")))
    lookup = measure_lookup(spark.createDataFrame([("a", "x")], "span_id string, note string"), ["span_id"], max_rows=0)
    schema = T.StructType([column("span_id", T.StringType()), column("note", T.StringType())])
    view = View("noted", schema, lambda df, ctx: enrich(df, ctx.lookup("notes")))
    target, context = FileTarget(f"{folder}/noted"), Context(lookups={"notes": lookup})
    with pytest.raises(SpecError, match="batch"):
        apply_view(topic_source(spark, made), view, context)
    write_view(topic_source(spark, made), target, f"{folder}/c", NOW, view, context).awaitTermination()
    assert rows(target.read(spark).select("key", "value.*")) == [("k", "a", "x"), (None, "b", None)]


def test_a_replay_adds_nothing_downstream(spark, folder):
    """A batch written again is the one that further streams have seen."""
    target, last = FileTarget(f"{folder}/first"), FileTarget(f"{folder}/last")
    five = spark.createDataFrame([(str(i), span(str(i))) for i in range(5)], f"key string, value {SPAN.simpleString()}")
    second = target.as_topic("first", SPAN)
    for attempt in range(3):
        target.write(five, 0)
        run(spark, f"{folder}/2", [ViewJob(COPY, ["first"], last)], [second])
    assert target.read(spark).count() == 5 and last.read(spark).count() == 5
    # Other rows under the same number change nothing either; asked for, they take its place.
    target.write(five.limit(2), 0)
    assert target.read(spark).count() == 5
    target.write(five.limit(2), 0, again=True)
    assert target.read(spark).count() == 2


def test_half_a_batch_is_never_seen(spark, folder):
    """An attempt that breaks off, or is still writing, shows nothing; the next one clears it away."""
    target = FileTarget(f"{folder}/t")
    rows_ = spark.createDataFrame([(str(i), span(str(i))) for i in range(4)], f"key string, value {SPAN.simpleString()}")
    target.write(rows_, 0)
    seen = []

    def slow(path):
        rows_.write.parquet(path)
        seen.append(target.read(spark).count())
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        commit_once(spark, target.name, "batch_id=1", slow)
    assert seen == [4] and target.read(spark).count() == 4
    assert len(os.listdir(f"{folder}/t/_attempts")) == 1
    target.write(rows_, 1)
    assert target.read(spark).count() == 8 and os.listdir(f"{folder}/t/_attempts") == []


def test_of_two_attempts_one_counts(spark, folder):
    target = FileTarget(f"{folder}/t")
    rows_ = spark.createDataFrame([("a", span("a"))], f"key string, value {SPAN.simpleString()}")

    def late(path):
        rows_.write.parquet(path)
        target.write(rows_, 0)  # another attempt is faster

    assert not commit_once(spark, target.name, "batch_id=0", late)
    assert target.read(spark).count() == 1
