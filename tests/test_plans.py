"""Physical plans: what must not shuffle does not, and scans read only what is asked for."""

import os
import re

import pytest

from tests.test_queries import DATA
from viewflow.operators.ingest import ingest_filter
from viewflow.plans import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")

NARROW = """
span_view merge_topics flat_map_view flat_map_zero_to_two row_function_view row_drop_view schema_conform decode_json
encode_json output_partitioner split_props_map split_built_map null_defaults truncate_text role_projection shape_table
epoch_columns ingest_filter ingest_filter_keep strcmp_view derived_columns partition_id_text retention
roll_over hybrid_read
""".split()

SCANNED = {
    "span_view": "event_id ts user_id event_type value",
    "flat_map_view": "doc_id source",
    "flat_map_zero_to_two": "event_id user_id",
    "row_function_view": "doc_id text",
    "split_props_map": "event_id props",
    "role_projection": "ts user_id",
    "time_bucket_counts": "ts",
    "age_tier": "ts",
    "partition_id_modulo": "o_custkey",
    "star_rollup_lineitem": "l_linenumber l_extendedprice l_returnflag l_linestatus",
    "ingest_rollup": "ts user_id event_type value",
}


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "Join" not in text
    python = "MapInArrow" in text or "Python" in text
    assert python == (name == "row_function_view")


@pytest.mark.parametrize("name", sorted(SCANNED))
def test_columns_read(spark, name):
    scans = re.findall(r"FileScan parquet \[(.*?)\]", plan(spark, name))
    assert len(scans) == 1
    assert sorted(re.sub(r"#\d+L?", "", scans[0]).split(",")) == sorted(SCANNED[name].split())


@pytest.mark.parametrize("name", ["time_bucket_counts", "ingest_rollup", "age_tier", "partition_id_hashcode"])
def test_one_shuffle_after_a_partial_aggregate(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 1 and "Exchange" not in text[text.index("partial_") :]


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,purchase)" in plan(spark, "ingest_filter_keep")
    assert "GreaterThanOrEqual(value,250.0)" in plan(spark, "row_drop_view")
    events = spark.read.parquet(f"{DATA}/events.parquet")
    dropped = ingest_filter(events, drop_when=[("event_type", "=", "error")])._jdf.queryExecution().executedPlan().toString()
    assert "Or(Not(EqualTo(event_type,error)),IsNull(event_type))" in dropped
    for name, pushed in (("retention", "GreaterThanOrEqual(ts"), ("roll_over", "LessThan(ts"), ("hybrid_read", "LessThan(ts")):
        assert pushed in plan(spark, name)
    assert "GreaterThanOrEqual(ts" in plan(spark, "hybrid_read")
    stored = plan(spark, "retention_stored")
    assert "bucket_start" in stored[stored.index("PartitionFilters") : stored.index("PushedFilters")]
    assert "GreaterThanOrEqual(start_time_millis" in stored


def test_partition_filters_of_the_pair_are_bare(spark):
    filters = re.findall(r"PartitionFilters: \[(.*?)\], P", plan(spark, "table_pair_hybrid"))
    # Offline runs, and of the realtime table open buckets, late batches, rows without a bucket.
    assert 3 <= len(filters) <= 4
    for text in filters:
        assert not any(word in text for word in ("coalesce", "NOT", " + ", " OR "))
