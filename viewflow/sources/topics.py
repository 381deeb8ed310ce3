"""Topics as (key, value) records: Kafka, or folders of files in any Spark format."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.operators.merge import merge_streams
from viewflow.spec import SpecError, TableSpec


# A micro-batch of a file topic takes about this many bytes unless its options say otherwise.
FILE_BATCH_BYTES = 1 << 40


@dataclass(frozen=True)
class Topic:
    """Where a topic lives. ``schema`` is that of the raw (key, value) files; Kafka needs none.

    Pass a schema with the needed fields only: a streamed file is read no wider than its schema. With ``after``
    (microseconds) only files changed later are read.
    """

    name: str
    fmt: str = "parquet"
    path: str | None = None
    schema: T.StructType | None = None
    options: dict[str, str] = field(default_factory=dict)
    after: int | None = None


def stream_path(path: str) -> str:
    """A glob matching only ``path``: in this form a file stream takes a single file, not just a folder."""
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def topic_source(spark: SparkSession, topic: Topic, stream: bool = True) -> DataFrame:
    """Open a topic as ``key STRING, value, topic STRING``, streaming or as one batch."""
    options = dict(topic.options)
    if stream and topic.fmt != "kafka" and not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options):
        options["maxBytesPerTrigger"] = str(FILE_BATCH_BYTES)
    reader = (spark.readStream if stream else spark.read).format(topic.fmt).options(**options)
    if topic.fmt == "kafka":
        raw = reader.option("subscribe", topic.name).load()
    else:
        if topic.path is None or (stream and topic.schema is None):
            raise SpecError(f"topic {topic.name!r}: a file topic needs a path, and a schema to be streamed")
        if topic.schema is not None:
            reader = reader.schema(topic.schema)
        raw = reader.load(topic.path)
        if topic.after is not None:
            raw = raw.where(F.col("_metadata.file_modification_time") > F.timestamp_micros(F.lit(topic.after)))
    return raw.select(F.col("key").cast("string").alias("key"), "value", F.lit(topic.name).alias("topic"))


class SourceSet:
    """The topics of a job. Each is opened once, whoever asks first, and shared by all views."""

    def __init__(self, spark: SparkSession, topics: Iterable[Topic], stream: bool = True):
        self._spark = spark
        self._stream = stream
        self._topics = {}
        for topic in topics:
            if topic.name in self._topics:
                raise SpecError(f"topic {topic.name!r} is defined twice")
            self._topics[topic.name] = topic
        self._opened: dict[str, DataFrame] = {}

    def get(self, name: str) -> DataFrame:
        if name not in self._topics:
            raise SpecError(f"unknown topic {name!r}")
        if name not in self._opened:
            self._opened[name] = topic_source(self._spark, self._topics[name], self._stream)
        return self._opened[name]

    def merged(self, names: Iterable[str]) -> DataFrame:
        """All named topics as one input."""
        return merge_streams([self.get(name) for name in check_topics(names)])


def check_topics(names: Iterable[str]) -> list[str]:
    names = list(names)
    if not names:
        raise SpecError("a view needs at least one input topic")
    if len(set(names)) < len(names):
        raise SpecError(f"an input topic is listed twice: {names}")
    return names


def keyed(df: DataFrame, key: Column | str, columns: Iterable[str] | None = None) -> DataFrame:
    """Records out of table rows: ``key`` as text, the columns as the value struct."""
    key = F.expr(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.struct(*(columns or df.columns)).alias("value"))


def publish(records: DataFrame, path: str, fmt: str = "parquet") -> Topic:
    """Write (key, value) records as a file topic, named by the last part of its path."""
    records = records.select("key", "value")
    records.write.format(fmt).mode("append").save(path)
    return Topic(path.rstrip("/").rsplit("/", 1)[-1], fmt, path, records.schema)


# Names of the stream settings, and the words for the start offset.
_TOPIC = "stream.kafka.topic.name"
_BROKERS = "stream.kafka.broker.list"
_RESET = "stream.kafka.consumer.prop.auto.offset.reset"
_FLUSH_ROWS = "realtime.segment.flush.threshold.size"
_FLUSH_MILLIS = "realtime.segment.flush.threshold.time"
_OFFSET_WORDS = {"smallest": "earliest", "largest": "latest", "earliest": "earliest", "latest": "latest"}


def newest_file(spark: SparkSession, path: str) -> int:
    """When the newest file below a folder was changed, in microseconds; 0 without files. Reads no file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.unix_micros(F.max("modificationTime"))).first()[0] or 0


def start_offset(spec: TableSpec) -> str:
    """Where a new stream of a table starts in its topic: ``earliest`` or ``latest``."""
    reset = spec.stream.get(_RESET, "largest")
    if reset not in _OFFSET_WORDS:
        raise SpecError(f"unknown start offset {reset!r}")
    return _OFFSET_WORDS[reset]


def flush_rows(spec: TableSpec) -> int | None:
    """The row threshold: a segment holds no more rows."""
    rows = spec.stream.get(_FLUSH_ROWS)
    return int(rows) if rows else None


def ingest_topic(spec: TableSpec, path: str | None = None, fmt: str = "parquet") -> Topic:
    """The topic a realtime table reads, from its stream settings; with ``path``, the same as files."""
    stream = spec.stream
    if _TOPIC not in stream:
        raise SpecError(f"table {spec.table_name}: no topic in the stream settings")
    if path is not None:
        files = stream.get("stream.file.max.per.trigger")
        options = {"maxFilesPerTrigger": str(files)} if files else {}
        return Topic(stream[_TOPIC], fmt, path, spec_records(spec), options)
    options = {"kafka.bootstrap.servers": stream[_BROKERS], "startingOffsets": start_offset(spec)}
    # The row threshold bounds a micro-batch, as it bounds a segment.
    if flush_rows(spec):
        options["maxOffsetsPerTrigger"] = str(flush_rows(spec))
    if stream.get("stream.kafka.min.partitions"):
        # Splits large topic partitions over several tasks.
        options["minPartitions"] = str(stream["stream.kafka.min.partitions"])
    return Topic(stream[_TOPIC], "kafka", None, None, options)


def ingest_trigger(spec: TableSpec) -> dict[str, str]:
    """Trigger arguments from the time threshold."""
    millis = int(spec.stream.get(_FLUSH_MILLIS, 60_000))
    return {"processingTime": f"{millis} milliseconds"}


# The last part of the decoder classes whose values are plain Avro or JSON.
_DECODERS = {"SimpleAvroMessageDecoder": "avro", "JSONMessageDecoder": "json"}


def ingest_codec(spec: TableSpec) -> str:
    """How the topic's values are read. Other decoders' values may have more than the record in them: they raise."""
    decoder = spec.stream.get("stream.kafka.decoder.class.name")
    if not decoder:
        return "struct"
    name = str(decoder).rsplit(".", 1)[-1]
    if name not in _DECODERS:
        raise SpecError(f"table {spec.table_name}: unknown decoder {decoder!r}")
    return _DECODERS[name]


def spec_records(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField("key", T.StringType()), T.StructField("value", spec.schema)])


def ingest_source(
    spark: SparkSession, spec: TableSpec, path: str | None = None, fmt: str = "parquet", stream: bool = True
) -> DataFrame:
    """The realtime table's input, opened from its stream settings."""
    return topic_source(spark, ingest_topic(spec, path, fmt), stream)
