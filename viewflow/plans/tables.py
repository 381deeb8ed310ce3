"""The given tables as records and rows, and the specs the registered queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.functions import ntz_to_epoch, register_sql_functions
from viewflow.sources.topics import keyed, stream_path
from viewflow.spec import ViewSpec, column

HOUR = 3_600_000
# The moment all life-cycle queries look back from: midnight after the last day of the events, UTC.
AS_OF = "2024-01-31T00:00:00"

SPAN_SCHEMA = T.StructType(
    [
        column("span_id", T.StringType(), nullable=False),
        column("start_time_millis", T.LongType(), 0, nullable=False),
        column("end_time_millis", T.LongType(), 0, nullable=False),
        column("span_kind", T.StringType(), nullable=False),
    ]
)

SPAN_COLUMNS = {
    "span_id": "cast(event_id as string)",
    "start_time_millis": "millis",
    "end_time_millis": "millis + floor(value)",
    "span_kind": "event_type",
}

# Columns of the span table: a view's output, from which the table spec picks.
SPAN_TABLE_SCHEMA = T.StructType(
    [
        column("tenant_id", T.StringType()),
        column("span_id", T.StringType()),
        column("span_kind", T.StringType()),
        column("start_time_millis", T.LongType(), 0),
        column("end_time_millis", T.LongType(), 0),
        column("attributes", T.MapType(T.StringType(), T.LongType())),
        column("time_taken_millis", T.LongType(), 0),
        column("note", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """The same table as a stream, read no wider than ``columns``."""
    schema = table(spark, sf_dir, name).select(*columns).schema
    return spark.readStream.schema(schema).parquet(stream_path(f"{sf_dir}/{name}.parquet"))


def with_millis(events: DataFrame) -> DataFrame:
    return events.withColumn("millis", ntz_to_epoch("ts"))


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def event_records(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Events as records: the user is the key."""
    if stream:
        events = stream_table(spark, sf_dir, "events", EVENT_COLUMNS)
    else:
        events = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    return keyed(with_millis(events).drop("ts"), "user_id")


def span_rows(events: DataFrame) -> DataFrame:
    """Events as rows of the span view."""
    return with_millis(events).select(
        F.concat(F.lit("tenant-"), F.pmod("user_id", F.lit(10))).alias("tenant_id"),
        F.col("event_id").cast("string").alias("span_id"),
        F.nullif("event_type", F.lit("click")).alias("span_kind"),
        F.col("millis").alias("start_time_millis"),
        (F.col("millis") + F.floor("value")).alias("end_time_millis"),
        F.from_json("props", "map<string,bigint>").alias("attributes"),
        F.floor("value").alias("time_taken_millis"),
        F.lit("not in the table").alias("note"),
    )


# Cubes of the offline table: one of few groups, one that also has the hour.
CUBES = [
    {
        "dimensionsSplitOrder": dims,
        "skipStarNodeCreationForDimensions": [],
        "functionColumnPairs": ["COUNT__span_id", "SUM__time_taken_millis", "MAX__end_time_millis"],
    }
    for dims in (["tenant_id", "span_kind"], ["tenant_id", "span_kind", "bucket_start_time_millis"])
]


def span_table_config(name: str = "spans", aggregate: bool = False, bucket: str = "6h", cubes: bool = False) -> dict:
    """Settings of the span view and its two tables."""
    dimensions = ["tenant_id", "span_kind", "start_time_millis"]
    return {
        "view.name": "span-view",
        "view.output.schema": SPAN_TABLE_SCHEMA,
        "table": {
            "tableName": name,
            "timeColumn": "start_time_millis",
            "timeUnit": "MILLISECONDS",
            "dimensionColumns": dimensions if aggregate else [*dimensions, "span_id"],
            "dateTimeColumns": ["bucket_start_time_millis"] + ([] if aggregate else ["end_time_millis"]),
            "metricColumns": ["time_taken_millis"],
            "columnsMaxLength": {"span_kind": 4},
            "sortedColumn": "tenant_id",
            "noDictionaryColumns": ["attributes__VALUES"],
            "bloomFilterColumns": [] if aggregate else ["span_id"],
            "rangeIndexColumns": ["start_time_millis"],
            "retentionTimeValue": 3,
            "retentionTimeUnit": "DAYS",
            "aggregateMetrics": aggregate,
        },
        "realtime": {
            "streamConfigs": {"streamType": "kafka", "stream.kafka.topic.name": "span-view-events"},
            "taskConfigs": {
                "RealtimeToOfflineSegmentsTask": {"bucketTimePeriod": bucket, "bufferTimePeriod": "12h"}
            },
            "transformConfigs": [
                {
                    "columnName": "bucket_start_time_millis",
                    "transformFunction": "time_bucket(start_time_millis, 3600000)",
                }
            ],
            "filterConfig": {"filterFunction": "strcmp(span_kind, 'error') = 0"},
            "tierConfigs": [
                {"name": "warm", "segmentSelectorType": "time", "segmentAge": "5d"},
                {"name": "cold", "segmentSelectorType": "time", "segmentAge": "20d"},
            ],
            "starTreeIndexConfigs": [
                {
                    "dimensionsSplitOrder": ["tenant_id", "span_kind"],
                    "skipStarNodeCreationForDimensions": [],
                    "functionColumnPairs": ["COUNT__span_id", "SUM__time_taken_millis"],
                    "maxLeafRecords": 100,
                }
            ],
            "segmentPartitionConfig": {
                "columnPartitionMap": {"tenant_id": {"functionName": "HashCode", "numPartitions": 4}}
            },
        },
        "offline": {
            "starTreeIndexConfigs": CUBES if cubes else [],
            "retentionTimeValue": 90,
            "taskConfigs": {
                "RealtimeToOfflineSegmentsTask": {"bucketTimePeriod": bucket, "bufferTimePeriod": "12h"}
            },
        },
    }


def span_view_spec(
    spark: SparkSession, name: str = "spans", aggregate: bool = False, bucket: str = "6h", cubes: bool = False
) -> ViewSpec:
    # The spec's expressions use our SQL functions.
    register_sql_functions(spark)
    return ViewSpec.parse(span_table_config(name, aggregate, bucket, cubes))
