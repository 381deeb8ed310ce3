"""Column functions: everything here stays inside Spark's own expressions."""

from viewflow.functions.epoch import epoch_to_ts, ntz_to_epoch, time_bucket, ts_to_epoch
from viewflow.functions.partitioning import java_hash, partition_by_fields, partition_id, spread_salt
from viewflow.functions.text import register_sql_functions, strcmp

__all__ = [
    "epoch_to_ts",
    "java_hash",
    "ntz_to_epoch",
    "partition_by_fields",
    "partition_id",
    "register_sql_functions",
    "spread_salt",
    "strcmp",
    "time_bucket",
    "ts_to_epoch",
]
