"""Merging of inputs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame

from viewflow.spec import SpecError


def merge_streams(inputs: Iterable[DataFrame]) -> DataFrame:
    """All rows of all inputs: nothing is deduplicated and no order holds between inputs."""
    inputs = list(inputs)
    if not inputs:
        raise SpecError("a view needs at least one input")
    return reduce(DataFrame.unionByName, inputs)
