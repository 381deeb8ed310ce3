"""String comparison, and the SQL names under which specs may use our functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def strcmp(left: Column | str, right: Column | str) -> Column:
    """-1, 0 or 1 by string order; null if either side is null."""
    left = F.col(left) if isinstance(left, str) else left
    right = F.col(right) if isinstance(right, str) else right
    return F.when(left == right, F.lit(0)).when(left < right, F.lit(-1)).when(left > right, F.lit(1))


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``strcmp(a, b)`` and ``time_bucket(x, width)`` known to the spec's SQL expressions.

    They are SQL functions, which Catalyst inlines, not Python ones.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION strcmp(a STRING, b STRING) RETURNS INT "
        "RETURN CASE WHEN a = b THEN 0 WHEN a < b THEN -1 WHEN a > b THEN 1 END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION time_bucket(x BIGINT, width BIGINT) RETURNS BIGINT "
        "RETURN x - x % width"
    )
