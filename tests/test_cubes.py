"""Cubes of a table pair: upkeep by roll-overs, choice by size, retention, expiry."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.fixtures import HOUR, ROW, config
from viewflow import SpecError, ViewSpec, create_tables, drop_expired, prepare, query_pair, read_hybrid, roll_over
from viewflow.operators import tables as stored_tables
from viewflow.operators.cubes import cheapest_cube, cube_table, write_cubes
from viewflow.operators.tables import RUN, append_batch, roll_state
from viewflow.spec import StarTree

DAY = 24 * HOUR
PAIRS = ["COUNT__name", "SUM__time_taken_millis", "MAX__end_time_millis", "AVG__time_taken_millis"]


def tree(*dims, pairs=PAIRS, no_star=()):
    return {"dimensionsSplitOrder": list(dims), "functionColumnPairs": pairs, "skipStarNodeCreationForDimensions": list(no_star)}


def settings(name, *trees):
    own = config(name)
    own["offline"] = {**own["offline"], "starTreeIndexConfigs": list(trees)}
    return ViewSpec.parse(own)


WIDE, NARROW = tree("tenant_id", "name", "bucket_start_time_millis"), tree("tenant_id", "name")


@pytest.fixture
def pair(spark, unique):
    return create_tables(spark, settings(unique, WIDE, NARROW))


def batch(spark, pair, number, seed, n=60, days=6):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        at = rng.randrange(days * DAY)
        name = rng.choice(["a", "b", None])
        data.append((rng.choice(["t1", "t2"]), name, at, at, at + i, None, ["f"], {"k": "v"}, rng.randrange(100), None))
    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ROW.fields)
    append_batch(prepare(spark.createDataFrame(data, plain), pair.realtime_spec), pair, number)


def direct(df, group_by, where=None):
    for c, values in (where or {}).items():
        df = df.where(F.col(c).isin(values))
    found = [F.count("*"), F.sum("time_taken_millis"), F.max("end_time_millis"), F.avg("time_taken_millis")]
    return rows(df.groupBy(*group_by).agg(*found))


ASKED = [((), None), (("tenant_id",), None), (("name", "bucket_start_time_millis"), None), (("name",), {"tenant_id": ["t1"]}), ((), {"name": ["a", "null"]})]


def check(spark, pair, as_of=None):
    whole = read_hybrid(spark, pair, as_of)
    for group_by, where in ASKED:
        assert rows(query_pair(spark, pair, list(group_by), where, as_of=as_of)) == direct(whole, group_by, where)


def test_cubes_follow_roll_overs_and_late_rows(spark, pair):
    batch(spark, pair, 0, 1)
    check(spark, pair)  # nothing moved yet
    roll_over(spark, pair, "1970-01-04T00:00:00")
    check(spark, pair)
    batch(spark, pair, 1, 2)  # late rows for moved buckets, and new ones
    check(spark, pair)
    roll_over(spark, pair, "1970-01-06T00:00:00")
    check(spark, pair)
    assert {r[0] for r in spark.table(cube_table(pair.offline, 0)).select(RUN).distinct().collect()} == {1, 2}


def test_a_broken_run_is_repeated(spark, pair, monkeypatch):
    batch(spark, pair, 0, 3)
    roll_over(spark, pair, "1970-01-03T00:00:00")
    batch(spark, pair, 1, 4)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        real = stored_tables.write_cubes
        m.setattr(stored_tables, "write_cubes", lambda *a: (real(*a), broken()))
        with pytest.raises(RuntimeError):
            roll_over(spark, pair, "1970-01-06T00:00:00")
    assert roll_state(spark, pair).run == 1
    check(spark, pair)  # what the broken run wrote is not read
    batch(spark, pair, 2, 5)
    roll_over(spark, pair, "1970-01-06T00:00:00")
    check(spark, pair)
    sizes = stored_tables._properties(spark, cube_table(pair.offline, 1))["viewflow.cube.sizes"]
    n = spark.table(cube_table(pair.offline, 1)).count()
    found = json.loads(sizes)
    assert sum(found["before"].values()) + sum(found["last"].values()) == n


def test_a_cube_made_later_gets_the_earlier_runs(spark, unique):
    pair = create_tables(spark, settings(unique))
    batch(spark, pair, 0, 6)
    roll_over(spark, pair, "1970-01-03T00:00:00")
    batch(spark, pair, 1, 7)
    pair = create_tables(spark, settings(unique, NARROW))
    roll_over(spark, pair, "1970-01-06T00:00:00")
    assert rows(query_pair(spark, pair, ["name"])) == direct(read_hybrid(spark, pair), ["name"])
    with pytest.raises(SpecError):
        create_tables(spark, settings(unique, tree("name")))


def test_no_offline_row_is_read(spark, pair):
    batch(spark, pair, 0, 8)
    roll_over(spark, pair, "1970-01-06T00:00:00")
    plan = query_pair(spark, pair, ["tenant_id"])._jdf.queryExecution().executedPlan().toString()
    assert f"{pair.offline}_cube_" in plan and pair.realtime in plan
    assert f"{pair.offline}[" not in plan and f"{pair.offline} " not in plan


def test_the_smallest_cube_is_chosen(spark, pair):
    batch(spark, pair, 0, 9)
    roll_over(spark, pair, "1970-01-06T00:00:00")
    trees = pair.offline_spec.star_trees
    pick = lambda dims, pairs=None: cheapest_cube(spark, pair.offline, trees, set(dims), pairs)
    assert pick(["tenant_id", "name"]) in (0, 1) and pick(["bucket_start_time_millis"]) == 0
    # One that never stars the hour has more groups for the same question.
    other = [StarTree(t.dims, t.pairs, t.dims[2:]) for t in trees[:1]] + trees[1:]
    write_cubes(spark, pair.offline, other, RUN, roll_state(spark, pair).run)
    assert cheapest_cube(spark, pair.offline, other, {"tenant_id"}, None) == 1
    for dims, pairs in ((["creation_time_millis"], None), (["name"], ["MIN__time_taken_millis"])):
        with pytest.raises(SpecError):
            pick(dims, pairs)


def test_retention_and_expiry(spark, pair):
    batch(spark, pair, 0, 10, days=4)
    roll_over(spark, pair, "1970-01-05T12:00:00")
    # 90 days: the bound lies within a bucket.
    check(spark, pair, "1970-04-03T02:30:00")
    drop_expired(spark, pair, "1970-04-03T02:30:00")
    check(spark, pair)
    assert spark.table(cube_table(pair.offline, 0)).agg(F.min("bucket_start")).first()[0] >= DAY
