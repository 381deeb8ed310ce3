"""Helpers of the operators: tables, shared scratch tables, and texts in Arrow batches cut by bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task holds as Python objects at a time; one longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: The same where the words stay in Arrow's memory.
WORD_BLOCK_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below `spark.checkpoint.dir`; below the warehouse where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/viewflow-llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to a shared folder and read back: later steps never compute them again."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(batches: Iterable[pa.RecordBatch], column: int, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch in runs of rows of about `size` bytes of the given text column, at least one row each."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        start = 0
        while start < len(ends):
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def texts(column: pa.Array) -> list[str]:
    """The texts as strings, a null as an empty one."""
    return ["" if x is None else x for x in column.to_pylist()]


class Words:
    """The words of a block's texts, parted by ASCII white space: distinct ones, and each word as its number."""

    def __init__(self, column: pa.Array):
        listed = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = listed.flatten().dictionary_encode()
        #: Distinct words.
        self.distinct: pa.StringArray = coded.dictionary
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.index(self.distinct, "").as_py()
        if empty >= 0:  # white space at an end of a text leaves an empty word
            kept = numbers != empty
            lengths = sums(kept.astype(np.int64), lengths)
            numbers = numbers[kept]
        #: Each word's place in `distinct`, text after text, and the number of words of each text.
        self.numbers, self.lengths = numbers, lengths


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sums of consecutive runs of values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def gathered(starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the elements of the chosen runs, one run after another, and the runs' lengths."""
    taken = lengths[chosen]
    ends = np.cumsum(taken)
    return np.repeat(starts[chosen] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0), taken
