import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from viewflow import SpecError, ingest_filter, ingest_rollup, ingest_transform, shape
from viewflow.spec import TableSpec, column

SCHEMA = T.StructType(
    [
        column("kind", T.StringType()),
        column("tags", T.ArrayType(T.StringType())),
        column("t", T.LongType(), 0),
        column("n", T.LongType(), 0),
    ]
)
SPEC = TableSpec("x", SCHEMA, ["kind", "tags"], ["n"], "t", "SECONDS", "1d")


def test_filter_and_null_predicates(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows(ingest_filter(df, drop_when="k = 'a'")) == [("b",), (None,)]
    assert rows(ingest_filter(df, keep_when="k = 'a'")) == [("a",)]
    assert rows(ingest_filter(df, drop_when=F.col("k").isNull(), keep_when="k <> 'a'")) == [("b",)]
    assert ingest_filter(df).count() == 3


def test_keep_when_reaches_the_scan(spark, folder):
    spark.range(10).write.parquet(f"{folder}/x")
    plan = ingest_filter(spark.read.parquet(f"{folder}/x"), keep_when="id > 5")._jdf.queryExecution().toString()
    assert "GreaterThan(id,5)" in plan


def test_transforms_in_order(spark):
    out = ingest_transform(spark.range(1, 2), [("a", "id + 1"), ("b", "a * 10"), ("id", "b + 1")])
    assert tuple(out.first()) == (21, 2, 20)


def test_rollup_sums_equal_groups(spark):
    data = [("a", ["x"], 1, 5), ("a", ["x"], 1, 7), ("a", ["y"], 1, 1), (None, ["x"], 1, None), ("a", ["x"], 2, 1)]
    out = ingest_rollup(shape(spark.createDataFrame(data, SCHEMA), SPEC), SPEC)
    assert rows(out.select("kind", "tags", "t", "n")) == [
        ("a", ["x"], 1, 12),
        ("a", ["x"], 2, 1),
        ("a", ["y"], 1, 1),
        ("null", ["x"], 1, 0),
    ]


def test_rollup_of_rows_read_back(spark):
    schema = T.StructType([*SCHEMA.fields, column("m", T.MapType(T.StringType(), T.LongType()))])
    spec = TableSpec("x", schema, ["kind", "day"], ["n"], "t", "SECONDS", "1d")
    data = [("a", ["x"], 1, 5, {"k": 1}), ("a", ["y"], 1, 7, {"k": 1}), ("a", ["x"], 1, 1, {"k": 2})]
    shaped = shape(spark.createDataFrame(data, schema).withColumn("day", F.lit("d")), spec)
    # Without the metadata that shaping leaves, as a table gives them.
    bare = T.StructType([T.StructField(f.name, f.dataType) for f in shaped.schema.fields])
    plain = spark.createDataFrame(shaped.collect(), bare)
    for df in (shaped, plain):
        out = ingest_rollup(df, spec).select("kind", "day", "t", "m__KEYS", "m__VALUES", "n")
        assert rows(out) == [("a", "d", 1, ["k"], [1], 12), ("a", "d", 1, ["k"], [2], 1)]


def test_rollup_aggregates_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", ["x"], 1, 5)], SCHEMA)
    plan = ingest_rollup(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")


def test_rollup_needs_a_metric_and_a_watermark(spark):
    none = TableSpec("x", SCHEMA, ["kind"], [], "t", "SECONDS", "1d")
    with pytest.raises(SpecError, match="metric"):
        ingest_rollup(spark.createDataFrame([], SCHEMA), none)
    rate = spark.readStream.format("rate").load()
    stream = rate.selectExpr("'a' AS kind", "array('x') AS tags", "value AS t", "1L AS n")
    with pytest.raises(SpecError, match="watermark"):
        ingest_rollup(stream, SPEC)


def test_stream_rollup_equals_batch_but_for_the_open_group(spark, folder):
    data = [("a", ["x"], t, 1) for t in (0, 5, 5, 10, 3600, 3600, 7200)]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    query = (
        ingest_rollup(shape(stream, SPEC), SPEC, watermark="1 minute")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    closed = rows(spark.read.parquet(f"{folder}/out").select("t", "n"))
    # The last group is open, and a row at the start of 1970 is behind the first watermark.
    assert closed == [(10, 1), (3600, 2), (5, 2)]


@pytest.mark.parametrize(
    "condition",
    ["a = 1", "a = 1 AND b > 2", "a = 1 OR NOT (b > 2 AND a < b)", "NOT a = 1", "a IN (1, 2)", "nullif(a, 1) = 2", "a = NULL", "a <=> 1"],
)
def test_rows_are_dropped_only_where_the_condition_is_true(spark, condition):
    df = spark.sql("SELECT * FROM VALUES (1), (2), (null) AS x(a) CROSS JOIN VALUES (1), (3), (null) AS y(b)")
    true = df.where(condition).count()
    assert ingest_filter(df, drop_when=condition).count() == 9 - true


def test_stated_comparisons_drop_like_their_expression(spark):
    values = [(a, b) for a in ("x", "y", None) for b in (1, 2, None)]
    df = spark.createDataFrame(values, "a string, b int")
    for stated in ([("a", "=", "x")], [("a", "<>", "x")], [("a", "=", "x"), ("b", ">=", 2)], [("b", "<", 2), ("b", ">", 0), ("a", "<=", "x")]):
        text = " AND ".join(f"{c} {sign} {v!r}" for c, sign, v in stated)
        assert rows(ingest_filter(df, drop_when=stated)) == rows(ingest_filter(df, drop_when=text))
    assert ingest_filter(df, drop_when=[]).count() == 9
    for wrong in ([("a", "like", "x")], [("a", "=", None)]):
        with pytest.raises(SpecError):
            ingest_filter(df, drop_when=wrong)
