"""Exact top-k by inner product over a bit-sliced index.

The index has a row per block of vectors: for each attribute its least value and a bitmap for each bit of the rest.
A query's inner product with all vectors of a block is a sum of bitmaps, each standing for a power of two: a slice
counts once for each set bit of the query's attribute, in complement where that is negative, and full adders of
bitmap operations bring the sum into slices again. From the most significant slice downward rows are taken for sure
or stay candidates; the rows left at the boundary have equal scores and are resolved by their ids. Blocks of queries
meet blocks of the index on a grid, whose size follows from the number of pairs; blocks' best rows are then ranked for
each query, and the query's own row goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scale of quantised attributes; rows of an index block; queries of a block.
SCALE, BLOCK, QUERIES = 1024, 16_384, 32
#: Pairs of a query and a vector for a cell of the grid, and least number of cells.
PAIRS, CELLS = 1 << 29, 48
K = 10


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """`key` and `v`, whole numbers; rows without a key, null vectors, and null or non-finite components are left out."""
    usable = F.forall(F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(df[key].cast("long").alias("key"), df[vector].cast("array<double>").alias("x"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("x").isNotNull() & usable)
    return rows.select("key", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _by_length(batch: pa.RecordBatch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys and vectors of a batch in order of the keys, cut into parts of equal length vectors."""
    keys = batch.column(0).to_numpy()
    lists = batch.column(1)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        own = own[np.argsort(keys[own], kind="stable")]
        for at in range(0, len(own), most):
            part = own[at : at + most]
            yield keys[part], flat[starts[part][:, None] + np.arange(length)]


def bit_sliced(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """The index: length of the vectors, keys in order, least values, bits of each attribute, and the slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for keys, values in _by_length(batch, block):
                least = values.min(axis=0)
                # Two's complement: right for any two whole numbers of 64 bits.
                rest = values.view(np.uint64) - least.view(np.uint64)
                most = rest.max(axis=0)
                bits = [int(m).bit_length() for m in most.tolist()]
                words = -(-len(keys) // 64)
                slices = np.zeros((sum(bits), words * 64), dtype=np.uint8)
                row = 0
                for attribute, n in enumerate(bits):
                    for bit in range(n):
                        slices[row, : len(keys)] = (rest[:, attribute] >> np.uint64(bit)) & np.uint64(1)
                        row += 1
                packed = np.packbits(slices, axis=1, bitorder="little").tobytes()
                rows.append((values.shape[1], keys.tobytes(), least.tobytes(), bytes(bits), packed))
            names = ["length", "keys", "least", "bits", "slices"]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)

    return vectors.mapInArrow(run, "length long, keys binary, least binary, bits binary, slices binary")


def _query_blocks(queries: DataFrame, size: int) -> DataFrame:
    """Queries in blocks: length of the vectors, numbers of the rows, keys, and vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for keys, values in _by_length(batch, size):
                numbers = np.arange(number, number + len(keys))
                number += len(keys)
                rows.append((values.shape[1], numbers.tobytes(), keys.tobytes(), values.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["length", "numbers", "query_keys", "queries"])

    return queries.mapInArrow(run, "length long, numbers binary, query_keys binary, queries binary")


class _Sum:
    """A sum of bitmaps with weights of powers of two: at most two bitmaps wait at each weight."""

    def __init__(self):
        self.waiting: list[list[np.ndarray]] = []

    def add(self, weight: int, bitmap: np.ndarray) -> None:
        while True:
            while len(self.waiting) <= weight:
                self.waiting.append([])
            own = self.waiting[weight]
            if len(own) < 2:
                own.append(bitmap)
                return
            # A full adder: three bitmaps become one of the same weight and one of the next.
            a, b = own.pop(), own.pop()
            either = a ^ b
            np.bitwise_and(a, b, out=a)
            np.bitwise_and(either, bitmap, out=b)
            np.bitwise_or(a, b, out=a)
            np.bitwise_xor(either, bitmap, out=either)
            own.append(either)
            bitmap, weight = a, weight + 1

    def slices(self, like: np.ndarray) -> list[np.ndarray]:
        """The sum as one bitmap for each bit, least first."""
        weight = 0
        while weight < len(self.waiting):
            own = self.waiting[weight]
            if len(own) == 2:
                a, b = own
                self.waiting[weight] = [a ^ b]
                self.add(weight + 1, a & b)
            weight += 1
        return [own[0] if own else np.zeros_like(like) for own in self.waiting]


def _summed(queries: np.ndarray, least: np.ndarray, bits: bytes, slices: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each query the scores of all rows, less a constant, as slices; and the constants."""
    total = _Sum()
    size = np.abs(queries)
    negative = queries < 0
    full = ~np.uint64(0)
    row = 0
    constants = (queries * least).sum(axis=1)
    for attribute, n in enumerate(bits):
        own, flip = size[:, attribute], np.where(negative[:, attribute], full, np.uint64(0))[:, None]
        # A negative weight counts the complement: so much more than its due.
        constants -= np.where(negative[:, attribute], own * ((1 << n) - 1 if n < 63 else -1), 0)
        factors = [
            (bit, np.where((own >> bit) & 1, full, np.uint64(0))[:, None])
            for bit in range(int(own.max(initial=0)).bit_length())
            if ((own >> bit) & 1).any()
        ]
        for place in range(n):
            turned = slices[row][None, :] ^ flip
            row += 1
            for bit, factor in factors:
                total.add(place + bit, turned & factor)
    return total.slices(np.zeros((len(queries), slices.shape[1]), dtype=np.uint64)), constants


def _best(sums: list[np.ndarray], n_rows: int, n_queries: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the rows of its k highest scores in the block, as pairs of query and row."""
    words = -(-n_rows // 64)
    open_ = np.zeros((n_queries, words * 64), dtype=np.uint8)
    open_[:, :n_rows] = 1
    tied = np.packbits(open_, axis=1, bitorder="little").view(np.uint64)
    sure = np.zeros_like(tied)
    n_sure = np.zeros(n_queries, dtype=np.int64)
    for slice_ in reversed(sums):
        higher = tied & slice_
        n = n_sure + np.bitwise_count(higher).sum(axis=1, dtype=np.int64)
        # Too many have this bit: the rest are out. Else those are in for sure, and the others go on.
        narrow = (n > k)[:, None]
        sure = np.where(narrow, sure, sure | higher)
        tied = np.where(narrow, higher, tied & ~slice_)
        n_sure = np.where(n > k, n_sure, n)
    in_rows = np.unpackbits(sure.view(np.uint8), axis=1, bitorder="little").astype(bool)
    # The boundary: equal scores, in order of the keys.
    edge = np.unpackbits(tied.view(np.uint8), axis=1, bitorder="little").astype(bool)
    in_rows |= edge & (np.cumsum(edge, axis=1) <= (k - n_sure)[:, None])
    return np.nonzero(in_rows)


def _matched(batch: pa.RecordBatch, k: int) -> tuple[list[np.ndarray], ...]:
    out: tuple[list[np.ndarray], ...] = ([], [], [], [], [])
    for row in batch.to_pylist():
        keys = np.frombuffer(row["keys"], dtype=np.int64)
        numbers = np.frombuffer(row["numbers"], dtype=np.int64)
        queries = np.frombuffer(row["queries"], dtype=np.int64).reshape(len(numbers), row["length"])
        query_keys = np.frombuffer(row["query_keys"], dtype=np.int64)
        slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(-1, -(-len(keys) // 64))
        sums, constants = _summed(queries, np.frombuffer(row["least"], dtype=np.int64), row["bits"], slices)
        query, found = _best(sums, len(keys), len(query_keys), k)
        scores = constants[query]
        for weight, slice_ in enumerate(sums):
            bit = (slice_[query, found >> 6] >> (found & 63).astype(np.uint64)) & np.uint64(1)
            scores = scores + (bit.astype(np.int64) << weight if weight < 64 else 0)
        # A row with the query's key and the query's product with itself: the query, or one like it in all results.
        own = (keys[found] == query_keys[query]) & (scores == (queries * queries).sum(axis=1)[query])
        for column, values in zip(out, (numbers[query], query_keys[query], keys[found], scores, own)):
            column.append(values)
    return out


def _grid(n_vectors: int, n_queries: int, pairs: int) -> tuple[int, int]:
    """Into how many parts the index and the queries are dealt: every part of one meets every part of the other.

    The number of cells follows from the number of pairs, their shape from the sizes: each side is copied once for
    each part of the other, and the larger side less often.
    """
    cells = max(CELLS, n_vectors * n_queries // pairs)
    parts = max(1, min(cells, ceil(sqrt(cells * max(n_vectors, 1) / max(n_queries, 1)))))
    return parts, ceil(cells / parts)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, per_block: int = QUERIES, pairs: int = PAIRS
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products with vectors of its length.

    Both inputs have `key` and `v`; queries are rows of the vectors. A query's own row is no candidate, other rows with
    its key are; ties go to the smaller key; fewer than k candidates give all; repeated query rows are answered each.
    Scores are whole numbers of 64 bits.
    """
    parts, groups = _grid(vectors.count(), queries.count(), pairs)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    index = bit_sliced(vectors, block).withColumn("part", F.pmod(F.xxhash64("keys", "slices"), F.lit(parts))).withColumn("group", every(groups))
    asked = _query_blocks(queries, per_block).withColumn("group", F.pmod(F.xxhash64("numbers"), F.lit(groups))).withColumn("part", every(parts))
    met = index.join(asked, ["length", "part", "group"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.concatenate(x) if x else np.array([], dtype=np.int64) for x in _matched(batch, k + 1)]
            arrays = [pa.array(x, pa.int64()) for x in columns[:4]] + [pa.array(columns[4].astype(bool))]
            yield pa.RecordBatch.from_arrays(arrays, names=["number", "query_id", "vec_id", "score", "own"])

    found = met.select("length", "keys", "least", "bits", "slices", "numbers", "query_keys", "queries").mapInArrow(
        run, "number long, query_id long, vec_id long, score long, own boolean"
    )
    by_query = Window.partitionBy("number")
    ranked = found.withColumn("place", F.row_number().over(by_query.orderBy(F.col("score").desc(), "vec_id"))).filter(F.col("place") <= k + 1)
    # Rows flagged as the query's own have one key and one score: any of them may be the one that goes.
    ranked = ranked.withColumn("gone", F.coalesce(F.min(F.when(F.col("own"), F.col("place"))).over(by_query), F.lit(k + 2)))
    ranked = ranked.filter(F.col("place") != F.col("gone")).withColumn("rank", F.col("place") - (F.col("place") > F.col("gone")).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def is_query(key: Column) -> Column:
    return key % 100 == 0


def neighbours(embeddings: DataFrame, k: int = K) -> DataFrame:
    """The k highest of all rows for every row whose vec_id is divisible by 100."""
    vectors = quantised(embeddings)
    return search(vectors, vectors.filter(is_query(F.col("key"))), k)


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
