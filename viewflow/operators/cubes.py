"""Cubes that belong to a table pair: kept up by each roll-over, and chosen for a query by their size.

Each pre-aggregation of the offline settings is a table of its own, partitioned by roll-over run and bucket like the
offline table. A run writes the cube of its own rows only; a run repeated replaces what it had written, and a
partition that expires goes with its bucket. Sums of one group from several runs and buckets are added up on reading.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.operators.layout import BUCKET, arrange
from viewflow.operators.rollup import grouping_set, merged_groups, base_groups, star_rollup, starred
from viewflow.spec import SpecError, StarTree

_TREE, _SIZES = "viewflow.cube.tree", "viewflow.cube.sizes"


def cube_table(offline: str, number: int) -> str:
    return f"{offline}_cube_{number}"


def _bucketed(tree: StarTree) -> StarTree:
    return StarTree((BUCKET, *tree.dims), tree.pairs, (BUCKET, *tree.no_star))


def _run_cube(rows: DataFrame, tree: StarTree) -> DataFrame:
    """The cube of offline rows, each bucket for itself."""
    return star_rollup(rows, _bucketed(tree)).drop(starred(BUCKET))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _described(tree: StarTree) -> str:
    return json.dumps({"dims": tree.dims, "pairs": tree.pairs, "no_star": tree.no_star}, sort_keys=True)


def create_cubes(spark: SparkSession, offline: str, trees: Sequence[StarTree], own: str) -> None:
    """Create the cube tables that are missing. Safe to repeat; a changed tree raises."""
    rows = spark.createDataFrame([], T.StructType([f for f in spark.table(offline).schema.fields]))
    for number, tree in enumerate(trees):
        name = cube_table(offline, number)
        if spark.catalog.tableExists(name):
            if _properties(spark, name).get(_TREE) != _described(tree):
                raise SpecError(f"table {name}: its cube is another one than the settings' number {number}")
            continue
        columns = [f for f in _run_cube(rows, tree).schema.fields if f.name != BUCKET]
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({listed}, `{own}` BIGINT, `{BUCKET}` BIGINT) USING parquet "
            f"OPTIONS ('partitionOverwriteMode' = 'static') PARTITIONED BY (`{own}`, `{BUCKET}`) "
            f"TBLPROPERTIES ('{_TREE}' = '{_described(tree)}')"
        )


def write_cubes(spark: SparkSession, offline: str, trees: Sequence[StarTree], own: str, run: int) -> None:
    """Aggregate the run's stored offline rows into the cubes, in place of what the run had written.

    A cube made after earlier runs gets their rows first.
    """
    for number, tree in enumerate(trees):
        name = cube_table(offline, number)
        sizes = _sizes(spark, name)
        for missing in [*range(sizes["run"] + 1, run), run]:
            _write_cube(spark, offline, name, tree, own, missing)


def _sizes(spark: SparkSession, name: str) -> dict:
    """The last run in the cube, the rows of each grouping set up to the run before it, and those of that run."""
    return json.loads(_properties(spark, name).get(_SIZES, '{"run": 0, "before": {}, "last": {}}'))


def _write_cube(spark: SparkSession, offline: str, name: str, tree: StarTree, own: str, run: int) -> None:
    cube = _run_cube(spark.table(offline).where(F.col(own) == F.lit(run)), tree)
    flags = [starred(d) for d in tree.dims]
    columns = [f"`{c}`" for c in cube.columns if c != BUCKET]
    # A grouping set lies together, so that a query skips the others' row groups.
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({own} = {run}, `{BUCKET}`) SELECT {', '.join(columns)}, `{BUCKET}` FROM {{rows}}",
        rows=arrange(cube, [BUCKET], flags),
    )
    found = _sizes(spark, name)
    before = found["before"]
    if found["run"] != run:
        before = {key: before.get(key, 0) + found["last"].get(key, 0) for key in {*before, *found["last"]}}
    # One row for each grouping set.
    counted = spark.table(name).where(F.col(own) == F.lit(run)).groupBy(*flags).agg(F.count(F.lit(1)).alias("n")).collect()
    last = {"".join(str(row[f]) for f in flags): row["n"] for row in counted}
    sizes = json.dumps({"run": run, "before": before, "last": last}, sort_keys=True)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_SIZES}' = '{sizes}')")


def cheapest_cube(
    spark: SparkSession, offline: str, trees: Sequence[StarTree], dims: set[str], pairs: Sequence[str] | None
) -> int:
    """The number of the cube whose grouping set for these dimensions has the fewest stored rows."""
    found = []
    for number, tree in enumerate(trees):
        if dims <= set(tree.dims) and set(pairs or ()) <= set(tree.pairs):
            kept = dims | set(tree.no_star)
            key = "".join("0" if d in kept else "1" for d in tree.dims)
            sizes = _sizes(spark, cube_table(offline, number))
            found.append((sizes["before"].get(key, 0) + sizes["last"].get(key, 0), number))
    if not found:
        raise SpecError(f"no cube of {offline} has the dimensions {sorted(dims)} and the pairs {list(pairs or ())}")
    return min(found)[1]


def answered(
    stored: Sequence[DataFrame],
    rows: Sequence[DataFrame],
    tree: StarTree,
    group_by: Sequence[str],
    where: Mapping[str, Any] | None,
    pairs: Sequence[str] | None,
) -> DataFrame:
    """``GROUP BY group_by`` over the grouping sets of stored cubes and over further rows."""
    parts = [grouping_set(cube, tree, group_by, where) for cube in stored]
    parts += [base_groups(df, tree, group_by, where) for df in rows]
    return merged_groups(reduce(DataFrame.unionByName, parts), tree, group_by, pairs)
