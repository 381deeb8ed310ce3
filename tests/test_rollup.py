import itertools
import random

import pytest

from tests.conftest import rows
from viewflow import SpecError, StarTree, query_rollup, star_rollup
from viewflow.operators.rollup import iceberg_rollup, query_leaves, split_pair

PAIRS = ("COUNT__v", "SUM__v", "MIN__v", "MAX__v", "AVG__v", "DISTINCTCOUNTHLL__v")
TREE = StarTree(("a", "b", "c"), PAIRS)


@pytest.fixture(scope="module")
def data():
    draw = random.Random(7)
    # One value holds most rows, some are null, groups are missing.
    return [
        (draw.choice(["hot"] * 8 + ["x", None]), draw.randrange(3), draw.choice("pq"), draw.choice([None, *range(9)]))
        for _ in range(400)
    ]


@pytest.fixture(scope="module")
def cube(spark, data):
    return star_rollup(spark.createDataFrame(data, "a string, b int, c string, v long"), TREE).persist()


def brute(data, dims, keep=lambda row: True):
    groups = {}
    for row in data:
        if keep(row):
            groups.setdefault(tuple(row["abc".index(d)] for d in dims), []).append(row[3])
    out = []
    for key, values in groups.items():
        known = [v for v in values if v is not None]
        out.append((*key, len(values), sum(known), min(known), max(known), sum(known) / len(known), len(set(known))))
    return sorted(out, key=repr)


def test_pairs_split_at_the_first_underscores():
    assert split_pair("SUM__time__taken") == ("SUM", "time__taken")
    for bad in ("SUM_x", "MEDIAN__x", "x"):
        with pytest.raises(SpecError):
            split_pair(bad)


def test_number_of_sets(cube):
    assert cube.select("a__starred", "b__starred", "c__starred").distinct().count() == 8


@pytest.mark.parametrize("step", [1, 2])
def test_starring_in_steps_gives_the_same(spark, data, cube, step):
    stepped = star_rollup(spark.createDataFrame(data, "a string, b int, c string, v long"), TREE, step)
    assert stepped.schema == cube.schema
    # Sketches of one set may differ in their bytes.
    plain = [c for c in cube.columns if not c.startswith("DISTINCT")]
    assert rows(stepped.select(plain)) == rows(cube.select(plain))
    assert rows(query_rollup(stepped, TREE, ["b"])) == brute(data, ["b"])


@pytest.mark.parametrize("dims", [d for n in range(4) for d in itertools.combinations("abc", n)])
def test_every_subset(cube, data, dims):
    assert rows(query_rollup(cube, TREE, dims)) == brute(data, dims)


def test_conditions(cube, data):
    found = query_rollup(cube, TREE, ["c"], {"b": [0, 2], "a": "hot"})
    assert rows(found) == brute(data, ["c"], lambda r: r[1] in (0, 2) and r[0] == "hot")
    found = query_rollup(cube, TREE, ["b", "c"], {"b": 1})
    assert rows(found) == brute(data, ["b", "c"], lambda r: r[1] == 1)


def test_unstarred_dimensions(spark, data):
    tree = StarTree(("a", "b", "c"), PAIRS, ("b",))
    cube = star_rollup(spark.createDataFrame(data, "a string, b int, c string, v long"), tree)
    assert cube.where("b__starred = 1").isEmpty()
    assert rows(query_rollup(cube, tree, ["a"])) == brute(data, ["a"])
    assert rows(query_rollup(cube, tree)) == brute(data, [])


def test_null_values_differ_from_stars(cube, data):
    assert cube.where("a IS NULL AND a__starred = 0 AND b__starred = 1 AND c__starred = 1").count() == 1


def test_unknown_dimension(cube):
    with pytest.raises(SpecError):
        query_rollup(cube, TREE, ["z"])


def test_rows_are_aggregated_before_they_are_copied(spark, data):
    df = spark.createDataFrame(data, "a string, b int, c string, v long")
    plan = star_rollup(df, TREE)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "partial_sum" in plan[plan.index("Expand") :]


@pytest.mark.parametrize("pairs", [PAIRS, PAIRS[1:]])
@pytest.mark.parametrize("no_star", [(), ("b",)])
def test_leaf_limit_changes_no_answer(spark, data, pairs, no_star):
    """Stored rows fall with the limit; every question has the answer of the whole cube."""
    df = spark.createDataFrame(data, "a string, b int, c string, v long")
    sizes = []
    whole = star_rollup(df, StarTree(("a", "b", "c"), pairs, no_star)).persist()
    for limit in (0, 20, 100, 10_000):
        tree = StarTree(("a", "b", "c"), pairs, no_star, limit)
        cube = iceberg_rollup(df, tree).persist()
        sizes.append(cube.count())
        assert set(cube.columns) == set(whole.columns)
        for dims in [(), ("a",), ("b", "c"), ("a", "b", "c")]:
            for where in (None, {"c": "p"}, {"a": ["x"], "b": [1, 2]}):
                assert rows(query_leaves(cube, tree, dims, where)) == rows(query_rollup(whole, tree, dims, where))
    assert sizes[0] == whole.count() and sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[1] > sizes[-1]
