"""Analytics views over event streams and tables, as Spark DataFrame operations."""

from viewflow.functions import (
    epoch_to_ts,
    java_hash,
    ntz_to_epoch,
    partition_by_fields,
    partition_id,
    register_sql_functions,
    strcmp,
    time_bucket,
    ts_to_epoch,
)
from viewflow.operators.enrich import Context, Lookup, enrich, measure_lookup
from viewflow.operators.ingest import ingest_filter, ingest_rollup, ingest_transform, prepare
from viewflow.operators.layout import arrange, parquet_options, write_layout
from viewflow.operators.lifecycle import apply_retention, assign_tier, complete_rows, hybrid_rows
from viewflow.operators.merge import merge_streams
from viewflow.operators.rollup import query_leaves, query_rollup, star_rollup, write_rollup
from viewflow.operators.shape import fill_defaults, shape, split_map, table_schema, truncate
from viewflow.operators.tables import (
    TablePair,
    create_all,
    create_tables,
    drop_expired,
    query_pair,
    read_hybrid,
    roll_over,
)
from viewflow.operators.views import (
    View,
    apply_view,
    conform,
    explode_view,
    projection_view,
    row_view,
    view_rows,
)
from viewflow.sources import SourceSet, Topic, decode_value, encode_value, ingest_source, keyed, publish, topic_source
from viewflow.spec import SpecError, StarTree, TableSpec, Tier, ViewSpec, column
from viewflow.streaming import (
    FileTarget,
    KafkaTarget,
    ViewJob,
    ingest_realtime,
    jobs_from_settings,
    run_views,
    write_view,
)

__all__ = [name for name in dir() if not name.startswith("_")]
