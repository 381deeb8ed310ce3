"""Where view output goes. A target takes one batch at a time and may get the same batch twice."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from viewflow.operators.enrich import Context
from viewflow.operators.ingest import ingest_rollup
from viewflow.operators.layout import arrange
from viewflow.operators.views import View, apply_view
from viewflow.sources.codecs import encode_value
from viewflow.sources.topics import Topic
from viewflow.spec import SpecError, TableSpec
from viewflow.streaming.commits import commit_once

BATCH = "batch_id"


@dataclass(frozen=True)
class FileTarget:
    """A folder of records, one subfolder per batch, which appears whole and then stays.

    A batch written again changes nothing, so that readers and further streams see each record once. One stream at a
    time, with one checkpoint, writes a target. With a view partitioner, records lie under ``partition=<n>``; a partition with most of the rows
    is written by as many tasks as its share asks for.
    """

    path: str
    fmt: str = "parquet"
    codec: str = "struct"

    @property
    def name(self) -> str:
        return self.path.rstrip("/")

    def write(self, out: DataFrame, batch_id: int, again: bool = False) -> None:
        """Write one batch; ``again`` puts it in place of what it had written before."""
        out = encode_value(out, self.codec)
        partitioned = "partition" in out.columns
        if partitioned:
            out = arrange(out, ["partition"], [])
        writer = out.write.format(self.fmt)
        if partitioned:
            writer = writer.partitionBy("partition")
        commit_once(out.sparkSession, self.name, f"{BATCH}={batch_id}", writer.save, again)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.fmt).load(self.path).drop(BATCH)

    def as_topic(self, name: str, value: T.DataType, partitioned: bool = False) -> Topic:
        """The written records as a topic for further views.

        ``value`` is the type they were encoded to, ``partitioned`` whether the view has a partitioner.
        """
        schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", value)])
        # A streamed folder's schema names its partition columns too.
        schema.add(BATCH, T.LongType())
        if partitioned:
            schema.add("partition", T.IntegerType())
        return Topic(name, self.fmt, self.path, schema)


@dataclass(frozen=True)
class KafkaTarget:
    """A Kafka topic. Spark's Kafka sink may repeat records after a failure."""

    topic: str
    servers: str
    codec: str = "avro"
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.servers}/{self.topic}"

    def write(self, out: DataFrame, batch_id: int, again: bool = False) -> None:
        out = encode_value(out, self.codec)
        if isinstance(out.schema["value"].dataType, T.StructType):
            raise SpecError("a Kafka value must be encoded: json or avro")
        columns = [c for c in ("key", "value", "partition") if c in out.columns]
        out.select(*columns).write.format("kafka").option("kafka.bootstrap.servers", self.servers).option(
            "topic", self.topic
        ).options(**self.options).save()


Target = FileTarget | KafkaTarget


def write_view(
    out: DataFrame,
    target: Target,
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    view: View | None = None,
    context: Context | None = None,
) -> StreamingQuery | None:
    """Write a view's output: a stream as a query that is returned started, a batch at once in place of an earlier one.

    With a ``view``, ``out`` is its input. A stream is then given to it as a whole, or batch by batch where a
    lookup is too large to broadcast.
    """
    large = view is not None and context is not None and not all(x.small for x in context.lookups.values())
    if large and out.isStreaming:

        def write(batch: DataFrame, batch_id: int) -> None:
            target.write(apply_view(batch, view, context.measured()), batch_id)

        return _started(out, write, checkpoint, trigger)
    if view is not None:
        out = apply_view(out, view, context)
    if not out.isStreaming:
        target.write(out, 0, again=True)
        return None
    return _started(out, target.write, checkpoint, trigger)


def _started(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str | None, trigger: Mapping | None
) -> StreamingQuery:
    if checkpoint is None:
        raise ValueError("a streamed view needs a checkpoint folder")
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .foreachBatch(write)
        .start()
    )


def write_rollup_stream(
    rows: DataFrame, spec: TableSpec, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Roll up a stream of shaped rows without losing any, however late and however cut into batches.

    Each batch leaves its own sums in a folder that it replaces if it comes again; ``read_rollup`` adds them up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest_rollup(batch, spec).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return _started(rows, write, checkpoint, trigger)


def read_rollup(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The sums of all batches written so far."""
    return ingest_rollup(spark.read.parquet(path).drop(BATCH), spec)
