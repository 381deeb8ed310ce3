import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from viewflow.functions import (
    epoch_to_ts,
    java_hash,
    ntz_to_epoch,
    partition_by_fields,
    partition_id,
    register_sql_functions,
    spread_salt,
    strcmp,
    time_bucket,
    ts_to_epoch,
)
from viewflow.functions.epoch import bucket_floor
from viewflow.spec import UNIT_NANOS, SpecError


def brute_hash(text):
    data = text.encode("utf-16-be")
    number = 0
    for i in range(0, len(data), 2):
        number = (number * 31 + (data[i] << 8) + data[i + 1]) % (1 << 32)
    return number - (1 << 32) if number >= 1 << 31 else number


def test_java_hash_known_values(spark):
    # Fixed values of Java's own String.hashCode.
    known = {"": 0, "a": 97, "hello": 99162322, "polygenelubricants": -2147483648, None: None}
    df = spark.createDataFrame([(k,) for k in known], "s string").select("s", java_hash("s").alias("h"))
    assert {r.s: r.h for r in df.collect()} == known


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=40))
def test_java_hash_any_text(spark, texts):
    df = spark.createDataFrame([(t + "\U0001f600",) for t in texts], "s string")
    found = {r.s: r.h for r in df.select("s", java_hash("s").alias("h")).collect()}
    assert found == {t: brute_hash(t) for t in found}


def test_partition_ids(spark):
    df = spark.createDataFrame([("polygenelubricants", -5), ("a", 5), (None, None)], "s string, n long")
    ids = df.select(partition_id("s", "HashCode", 7), partition_id("n", "Modulo", 4), partition_id("s", "Murmur3", 4))
    first, second, third = ids.collect()
    assert first[0] == -2147483648 % 7 and first[1] == 3
    assert second[0] == 97 % 7 and second[1] == 1
    assert third[0] is None and all(0 <= r[2] < 4 for r in (first, second))
    with pytest.raises(SpecError):
        partition_id("s", "Other", 4)
    with pytest.raises(SpecError):
        partition_id("s", "HashCode", 0)


def test_partition_by_fields_only_for_listed_topics(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "s string, n long")
    out = partition_by_fields(df, ["s", "n"], 8, "t1", " t0 , t1 ").collect()
    assert out[0].partition == out[1].partition and all(0 <= r.partition < 8 for r in out)
    for topics in ("t0,t11", None, ""):
        assert {r.partition for r in partition_by_fields(df, ["s"], 8, "t1", topics).collect()} == {None}


def test_time_bucket_and_floor(spark):
    df = spark.createDataFrame([(7_200_123,), (7_200_000,), (-1,), (None,)], "x long")
    assert [tuple(r) for r in df.select(time_bucket("x", 3_600_000), bucket_floor("x", 3_600_000)).collect()] == [
        (7_200_000, 7_200_000),
        (7_200_000, 7_200_000),
        (0, -3_600_000),
        (None, None),
    ]


def test_strcmp(spark):
    register_sql_functions(spark)
    pairs = [("a", "a"), ("a", "b"), ("b", "a"), ("", "a"), (None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "l string, r string")
    expected = [0, -1, 1, -1, None, None]
    assert [r[0] for r in df.select(strcmp("l", "r")).collect()] == expected
    assert [r[0] for r in df.select(F.expr("strcmp(l, r)")).collect()] == expected
    assert df.select(F.expr("time_bucket(7200123, 3600000)")).first()[0] == 7_200_000


@pytest.mark.parametrize("unit", list(UNIT_NANOS))
def test_epoch_round_trip(spark, unit):
    step = {"NANOSECONDS": 1_000}.get(unit, 1)
    values = [0, 1 * step, 19_000 * step, -1 * step, -19_001 * step]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x long")
    back = [r[0] for r in df.select(ts_to_epoch(epoch_to_ts("x", unit), unit)).collect()]
    assert back == [*values, None]


def test_nanoseconds_round_down(spark):
    df = spark.createDataFrame([(1_999,), (-1,)], "x long")
    assert [r[0] for r in df.select(F.unix_micros(epoch_to_ts("x", "NANOSECONDS"))).collect()] == [1, -1]


def test_epoch_units_checked():
    with pytest.raises(SpecError):
        epoch_to_ts(F.lit(1), "WEEKS")
    with pytest.raises(SpecError):
        ts_to_epoch(F.lit(1), "WEEKS")


def test_zoneless_timestamps_ignore_the_session_zone(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-03-10 02:30:00.123456'), "
        "(timestamp_ntz'1969-12-31 23:59:59.999999') AS t(ts)"
    )
    expected = [(1710037800123456, 1710037800123, 1710037800, 19792), (-1, -1, -1, -1)]
    units = ["MICROSECONDS", "MILLISECONDS", "SECONDS", "DAYS"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [tuple(r) for r in df.select(*[ntz_to_epoch("ts", u) for u in units]).collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_salt_spreads_copies_and_is_repeatable(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit("same").alias("x"), F.expr("map('a', 1)").alias("m"))
    salted = copies.select(F.pmod(spread_salt(copies), F.lit(8)).alias("salt"))
    counts = {r.salt: r["count"] for r in salted.groupBy("salt").count().collect()}
    assert len(counts) >= 6 and max(counts.values()) < 4000 / 3
    assert rows(salted) == rows(salted)
