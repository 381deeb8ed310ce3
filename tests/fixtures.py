"""Schemas and specs for the tests."""

from pyspark.sql import types as T

from viewflow.spec import column

SPAN = T.StructType(
    [
        column("span_id", T.StringType(), nullable=False),
        column("start_time_millis", T.LongType(), 0, nullable=False),
        column("end_time_millis", T.LongType(), 0, nullable=False),
        column("span_kind", T.StringType(), nullable=False),
    ]
)
SPAN_RECORD = (
    "key STRING, value STRUCT<span_id: STRING, start_time_millis: BIGINT, end_time_millis: BIGINT, span_kind: STRING>"
)

ROW = T.StructType(
    [
        column("tenant_id", T.StringType()),
        column("name", T.StringType()),
        column("creation_time_millis", T.LongType(), -1),
        column("start_time_millis", T.LongType(), 0),
        column("end_time_millis", T.LongType(), 0),
        column("id_sha", T.BinaryType()),
        column("friends", T.ArrayType(T.StringType()), []),
        column("properties", T.MapType(T.StringType(), T.StringType()), {}),
        column("time_taken_millis", T.LongType(), 0),
        column("scores", T.MapType(T.StringType(), T.DoubleType()), {}),
    ]
)

HOUR = 3_600_000


# Names of fields and settings, on which the expected numbers of dimensions and date-times depend.
def config(name="rows", **table):
    """A full set of settings for rows of ``ROW``; ``table`` overrides the common ones."""
    return {
        "view.name": "myView",
        "view.output.schema": ROW,
        "table": {
            "tableName": name,
            "sortedColumn": "tenant_id",
            "timeColumn": "creation_time_millis",
            "timeUnit": "MILLISECONDS",
            "dimensionColumns": [
                "name",
                "creation_time_millis",
                "id_sha",
                "friends",
                "properties__KEYS",
                "properties__VALUES",
            ],
            "dateTimeColumns": ["start_time_millis", "end_time_millis", "bucket_start_time_millis"],
            "columnsMaxLength": {"id_sha": 64},
            "metricColumns": ["time_taken_millis"],
            "noDictionaryColumns": ["properties__VALUES"],
            "bloomFilterColumns": ["id_sha"],
            "rangeIndexColumns": ["creation_time_millis", "start_time_millis"],
            "retentionTimeValue": 3,
            "retentionTimeUnit": "DAYS",
            "numReplicas": 2,
            **table,
        },
        "realtime": {
            "streamConfigs": {
                "streamType": "kafka",
                "stream.kafka.topic.name": "test-view-events",
                "stream.kafka.broker.list": "localhost:9092",
                "realtime.segment.flush.threshold.time": 3_600_000,
                "realtime.segment.flush.threshold.size": 500_000,
                "stream.kafka.consumer.prop.auto.offset.reset": "largest",
            },
            "taskConfigs": {"RealtimeToOfflineSegmentsTask": {"bucketTimePeriod": "6h", "bufferTimePeriod": "12h"}},
            "transformConfigs": [
                {
                    "columnName": "bucket_start_time_millis",
                    "transformFunction": "time_bucket(start_time_millis, 3600000)",
                }
            ],
            "filterConfig": {"filterFunction": "strcmp(name, 'abcd-1234') = 0"},
            "tierConfigs": [{"name": "old", "segmentSelectorType": "time", "segmentAge": "5d"}],
            "starTreeIndexConfigs": [
                {
                    "dimensionsSplitOrder": ["tenant_id", "start_time_millis"],
                    "skipStarNodeCreationForDimensions": [],
                    "functionColumnPairs": ["COUNT__name", "SUM__time_taken_millis"],
                    "maxLeafRecords": 100,
                }
            ],
            "segmentPartitionConfig": {
                "columnPartitionMap": {"tenant_id": {"functionName": "HashCode", "numPartitions": 4}}
            },
        },
        "offline": {
            "retentionTimeValue": 90,
            "taskConfigs": {"RealtimeToOfflineSegmentsTask": {"bucketTimePeriod": "6h", "bufferTimePeriod": "12h"}},
        },
    }
