import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from viewflow import arrange, write_layout
from viewflow.functions.partitioning import partition_id
from viewflow.operators.layout import add_partitions, order_columns, parquet_options, part_filter, partition_columns
from viewflow.spec import TableSpec, column

SCHEMA = T.StructType(
    [
        column("tenant", T.StringType()),
        column("id", T.StringType()),
        column("t", T.LongType()),
        column("tags", T.ArrayType(T.StringType())),
    ]
)


def make_spec(**changes):
    settings = {
        "sorted_column": "tenant",
        "range_columns": ["t"],
        "partitions": {"tenant": ("HashCode", 4)},
        "bloom_columns": ["id"],
        "no_dictionary_columns": ["tags"],
        "bucket_period": "1h",
        **changes,
    }
    return TableSpec("x", SCHEMA, ["tenant", "id", "tags"], [], "t", "SECONDS", "1d", **settings)


@pytest.fixture
def data(spark):
    # A third of the rows, exact copies among them, belong to one tenant.
    return spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 20)).alias("tenant"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(10)).otherwise(F.col("id") % 7200).alias("t"),
        F.array(F.lit("a")).alias("tags"),
    )


def files(folder):
    return sorted(glob.glob(f"{folder}/**/*.parquet", recursive=True))


def test_round_trip_and_folders(spark, folder, data):
    spec = make_spec()
    write_layout(data, spec, folder)
    stored = spark.read.parquet(folder)
    assert rows(stored.select(*SCHEMA.names)) == rows(data)
    assert partition_columns(spec) == ["bucket_start", "part_tenant"]
    wrong = stored.where(
        (F.col("bucket_start") != F.col("t") - F.col("t") % 3600)
        | (F.col("part_tenant") != partition_id("tenant", "HashCode", 4))
    )
    assert wrong.isEmpty()


@pytest.mark.parametrize("by_range", [False, True])
def test_files_are_sorted(folder, data, by_range):
    write_layout(data, make_spec(), folder, by_range=by_range)
    for file in files(folder):
        table = pq.ParquetFile(file).read(columns=["tenant", "t"]).to_pydict()
        pairs = list(zip(table["tenant"], table["t"]))
        assert pairs == sorted(pairs)


@pytest.mark.parametrize("way", ["adaptive", "by range", "not adaptive"])
def test_hot_partition_is_written_by_several_tasks(spark, folder, data, way):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.enabled": "true"}
    if way == "not adaptive":
        small["spark.sql.adaptive.enabled"] = "false"
    kept = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        write_layout(data, make_spec(), folder, files=8 if way == "by range" else None)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert rows(spark.read.parquet(folder).select(*SCHEMA.names)) == rows(data)
    tenants = [pq.ParquetFile(f).read(columns=["tenant"])["tenant"].to_pylist() for f in files(folder)]
    hot = [t.count("hot") for t in tenants if "hot" in t]
    assert sum(hot) == 2000 and len(hot) >= 2 and max(hot) < 1500


def test_written_again_replaces_its_partitions(spark, folder, data):
    spec = make_spec()
    write_layout(data, spec, folder)
    write_layout(data.where("t < 3600"), spec, folder)
    assert rows(spark.read.parquet(folder).select(*SCHEMA.names)) == rows(data)


def test_bloom_and_dictionary_options(folder, data):
    spec = make_spec()
    options = parquet_options(spec, SCHEMA)
    assert options["parquet.bloom.filter.enabled#id"] == "true"
    assert options["parquet.enable.dictionary#id"] == "false"
    assert options["parquet.enable.dictionary#tags.list.element"] == "false"
    assert parquet_options(spec, SCHEMA, 99)["parquet.bloom.filter.expected.ndv#id"] == "99"
    assert parquet_options(make_spec(bloom_columns=["gone"], no_dictionary_columns=["gone"]), SCHEMA) == {}

    write_layout(data, spec, f"{folder}/with", files=1)
    write_layout(data, make_spec(bloom_columns=[]), f"{folder}/without", files=1)

    def column_of(kind, name):
        meta = pq.ParquetFile(files(f"{folder}/{kind}")[0]).metadata.row_group(0)
        return next(c for c in (meta.column(i) for i in range(meta.num_columns)) if c.path_in_schema.startswith(name))

    assert not any("DICTIONARY" in e for e in column_of("with", "tags").encodings)
    assert not any("DICTIONARY" in e for e in column_of("with", "id").encodings)
    assert any("DICTIONARY" in e for e in column_of("with", "tenant").encodings)

    # What a file holds besides column data and footer: page indexes, and the filter if there is one.
    def besides(kind):
        file = files(f"{folder}/{kind}")[0]
        meta = pq.ParquetFile(file).metadata
        group = meta.row_group(0)
        data_bytes = sum(group.column(i).total_compressed_size for i in range(meta.num_columns))
        return os.path.getsize(file) - data_bytes - meta.serialized_size

    assert besides("with") > besides("without") + 100


def test_part_filter_reads_one_part(spark, folder, data):
    spec = make_spec()
    write_layout(data, spec, folder)
    found = part_filter(spark.read.parquet(folder), spec, "tenant", "t1")
    assert rows(found.select(*SCHEMA.names)) == rows(data.where("tenant = 't1'"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "part_tenant" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]


def test_order_of_columns():
    assert order_columns(make_spec(range_columns=["t", "tenant"])) == ["tenant", "t"]
    assert order_columns(make_spec(sorted_column=None, range_columns=[])) == []


def test_arrange_without_columns_is_the_input(data):
    assert arrange(data, [], []) is data


def test_negative_times_have_buckets_too(spark):
    df = spark.createDataFrame([("a", "b", -1, None)], SCHEMA)
    assert add_partitions(df, make_spec()).first().bucket_start == -3600


def test_files_are_narrow_in_every_range_column(spark, folder):
    """A filter on the second of two range columns meets the ranges of a small part of the files."""
    from viewflow.operators.layout import arrange

    data = spark.range(20_000).selectExpr("id", "(id * 7919) % 20000 AS a", "(id * 104729) % 19997 AS b")
    met = {}
    for name, curve in (("plain", []), ("curve", ["a", "b"])):
        arrange(data, [], ["a", "b"], 64, True, curve).write.parquet(f"{folder}/{name}")
        stored = spark.read.parquet(f"{folder}/{name}")
        assert rows(stored) == rows(data) and stored.columns == data.columns
        ranges = stored.groupBy("_metadata.file_path").agg(
            *[f(c).alias(f.__name__ + c) for c in "ab" for f in (F.min, F.max)]
        ).collect()
        met[name] = {c: sum(r["min" + c] <= 9_000 <= r["max" + c] for r in ranges) / len(ranges) for c in "ab"}
    assert met["plain"]["b"] > 0.9
    assert met["curve"]["a"] < 0.25 and met["curve"]["b"] < 0.25


def test_the_curve_takes_nulls_ties_and_other_types(spark):
    from viewflow.functions.curve import curve_columns, cut_points, z_order

    df = spark.createDataFrame(
        [(None, 1.0, "x"), (1, None, "y"), (5, 2.0, None), (5, 2.0, "z"), (9, 9.0, "z")], "a int, b double, c string"
    ).withColumn("d", F.timestamp_seconds(F.col("a")))
    assert curve_columns(df, ["a", "b", "c", "d", "e"]) == ["a", "b", "d"]
    cuts = cut_points(df, ["a", "b", "d"], 2)
    places = [r[0] for r in df.select(z_order(df, cuts, 2)).collect()]
    assert places[2] == places[3] <= places[4] and min(places) >= 0 and max(places) < 64
    # By hand: two columns cut in four, the first column's bits lead.
    grid = spark.range(16).selectExpr("id % 4 AS x", "id div 4 AS y")
    found = {(r.x, r.y): r.z for r in grid.select("x", "y", z_order(grid, {"x": [1, 2, 3], "y": [1, 2, 3]}, 2).alias("z")).collect()}
    assert sorted(found.values()) == list(range(16))
    assert found[0, 1] == 1 and found[1, 0] == 2 and found[2, 3] == 0b1101 and found[3, 3] == 15
    empty = df.limit(0)
    assert empty.select(z_order(empty, cut_points(empty, ["a", "b"]))).count() == 0
