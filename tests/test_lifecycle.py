from datetime import datetime, timezone

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from viewflow import apply_retention, assign_tier, complete_rows, hybrid_rows
from viewflow.operators.lifecycle import complete_until
from viewflow.spec import TableSpec, Tier, column

SCHEMA = T.StructType([column("t", T.LongType())])
HOUR = 3600


def spec(**changes):
    settings = {"bucket_period": "6h", "buffer_period": "12h", **changes}
    return TableSpec("x", SCHEMA, [], [], "t", "SECONDS", "1d", **settings)


def times(spark, *values):
    return spark.createDataFrame([(v,) for v in values], SCHEMA)


def test_retention_edge(spark):
    df = times(spark, -1, 0, 1, 86_400, None)
    assert rows(apply_retention(df, spec(), 86_400)) == [(0,), (1,), (86_400,)]
    assert rows(apply_retention(df, spec(), "1970-01-02T00:00:01")) == [(1,), (86_400,)]
    assert rows(apply_retention(df, spec(), datetime(1970, 1, 3, tzinfo=timezone.utc))) == [(86_400,)]


def test_retention_uses_the_bucket_folder(spark, folder):
    df = times(spark, *range(0, 100 * HOUR, HOUR))
    stored = complete_rows(df, spec(), 1_000 * HOUR)
    stored.write.partitionBy("bucket_start").parquet(f"{folder}/x")
    kept = apply_retention(spark.read.parquet(f"{folder}/x"), spec(), 99 * HOUR)
    assert rows(kept.select("t")) == rows(apply_retention(df, spec(), 99 * HOUR))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "bucket_start" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "GreaterThanOrEqual(t" in plan


def test_tiers(spark):
    tiers = [Tier("warm", "1h"), Tier("cold", "2h")]
    df = times(spark, 0, HOUR, HOUR + 1, 2 * HOUR, 3 * HOUR)
    out = assign_tier(df, spec(tiers=tiers), 2 * HOUR, default="hot")
    assert [r.tier for r in out.collect()] == ["cold", "warm", "hot", "hot", "hot"]
    assert [r.tier for r in assign_tier(df, spec(), 2 * HOUR).collect()] == [None] * 5


@pytest.mark.parametrize(
    "as_of, until",
    [(18 * HOUR, 6 * HOUR), (18 * HOUR - 1, 0), (23 * HOUR, 6 * HOUR), (24 * HOUR, 12 * HOUR), (0, -12 * HOUR)],
)
def test_complete_buckets(as_of, until):
    assert complete_until(spec(), as_of) == until


def test_complete_rows(spark):
    df = times(spark, -1, 0, 6 * HOUR - 1, 6 * HOUR, None)
    assert rows(complete_rows(df, spec(), 18 * HOUR)) == [(-1, -6 * HOUR), (0, 0), (6 * HOUR - 1, 0)]


def test_hybrid_reads_each_row_once(spark):
    all_times = list(range(0, 48 * HOUR, 1800))
    df = times(spark, *all_times)
    offline = complete_rows(df, spec(), 40 * HOUR).drop("bucket_start")
    realtime = apply_retention(df, spec(), 40 * HOUR)
    boundary = complete_until(spec(), 40 * HOUR)
    assert rows(hybrid_rows(offline, realtime, spec(), boundary)) == rows(df)
    edge = hybrid_rows(times(spark, 5, 6, 7), times(spark, 5, 6, 7), spec(), 6)
    assert rows(edge) == [(5,), (6,), (7,)]
