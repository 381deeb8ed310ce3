"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the character n-grams of its words that it has at all, hashed to cells. Each feature is scaled
by the logarithm of how much likelier it is in toxic training texts than in others, and a logistic regression is
trained on the scaled features. It learns from at most `LABELLED` labelled documents of each kind, weighted so that
the kinds count as often as among all labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewflow.llm.common import Words, blocks, gathered, sums

#: Training documents of each kind, at most but for a chance of about one in a billion.
LABELLED = 2000
#: Shortest and longest n-gram, cells of hashed n-grams, least number of training texts with a feature and least ratio.
SHORT, LONG, CELLS, LEAST, TELLS = 4, 6, 1 << 18, 5, 0.5
#: Added to counts; weight of the squared weights; steps of the training and their size.
SMOOTH, PENALTY, STEPS, RATE = 1.0, 3e-3, 80, 0.05
#: From which score on a text is predicted to be toxic.
THRESHOLD = 0.3


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of the n-grams of words, with a mark before and after each, one word after another; and how many each has."""
    data = np.frombuffer("".join(f"\x02{word}\x03" for word in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    rest = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))
    padded = np.concatenate([data, np.zeros(LONG, dtype=np.uint64)])
    found = np.full((len(data), LONG - SHORT + 1), -1, dtype=np.int64)
    code = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, LONG + 1):
        code = (code + padded[n - 1 : n - 1 + len(data)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
        if n >= SHORT:
            there = rest >= n
            found[there, n - SHORT] = (code[there] & np.uint64(CELLS - 1)).astype(np.int64)
    flat = found.ravel()
    return flat[flat >= 0], sums((found >= 0).sum(axis=1), lengths)


def features(column: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells of each text in ascending order, text after text, and how many each has; only `used` cells."""
    words = Words(column)
    bare = pc.replace_substring_regex(pc.utf8_lower(words.distinct), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    coded = bare.dictionary_encode()
    cells, n = _grams(coded.dictionary.to_pylist())
    if used is not None:
        kept = used[cells]
        n, cells = sums(kept.astype(np.int64), n), cells[kept]
    rows = np.repeat(np.arange(len(words.lengths)), words.lengths)
    own = np.unique(rows * max(len(n), 1) + coded.indices.to_numpy(zero_copy_only=False)[words.numbers])
    place, taken = gathered(np.cumsum(n) - n, n, own % max(len(n), 1))
    both = np.unique(np.repeat(own // max(len(n), 1), taken) * CELLS + cells[place])
    return both % CELLS, np.bincount(both // CELLS, minlength=len(column))


@dataclass
class Model:
    bias: float
    #: By cell: the log-count ratio times the weight; 0 for cells seen in too few texts or alike in both kinds.
    weights: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        cells, n = features(column, self.weights != 0)
        return 1 / (1 + np.exp(-(self.bias + sums(self.weights[cells], n))))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[DataFrame, dict[int, int]]:
    """`id`, `toxic` and `text` of the sampled documents, one row for each id; and the number of labelled ids of each kind.

    Held-out ids and null labels and ids are left out. An id is toxic if one of its labels says so; of several texts of
    an id the least is taken. Where there are more than `labelled` ids of a kind, those whose hash is small enough stay.
    """
    known = labels.select(labels["doc_id"].alias("id"), (labels["toxic"] == 1).cast("int").alias("toxic")).dropna()
    known = known.filter(~is_held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    most = max(labelled - 6 * labelled**0.5, 1)
    share = {kind: min(1.0, most / n if n > labelled else 1.0) for kind, n in sizes.items()}
    place = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(place < F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)))
    texts = docs.select(docs["doc_id"].alias("id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    # At most two times `labelled` ids.
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")), sizes


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Learned from the sample; where a kind has no label, a model that gives the labels' share to every text."""
    sample, sizes = training_texts(docs, labels, labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 2):
            cells, n = features(block.column(2))
            own = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(cells, pa.int32()))
            yield pa.record_batch([block.column(0), block.column(1), own], names=["at", "toxic", "cells"])

    numbered = sample.select(F.xxhash64("id").alias("at"), "toxic", "text")
    # In an order of their own, as the training adds up numbers row by row.
    rows = numbered.mapInArrow(run, "at long, toxic int, cells array<int>").toArrow().sort_by("at")
    toxic = rows["toxic"].to_numpy() == 1
    n = pc.list_value_length(rows["cells"]).to_numpy().astype(np.int64)
    cells = pc.list_flatten(rows["cells"]).to_numpy().astype(np.int64)
    of = np.array([sizes.get(0, 0), sizes.get(1, 0)], dtype=np.float64)
    there = np.array([(~toxic).sum(), toxic.sum()], dtype=np.float64)
    if not there.all():
        share = (of[1] + 0.5) / (of.sum() + 1)
        return Model(float(np.log(share / (1 - share))), np.zeros(CELLS))
    # A row stands for as many labels as its kind has for each row of it; together they weigh 1.
    weight = (of / there)[toxic.astype(int)] / of.sum()
    return _trained(toxic, cells, n, weight)


def _trained(toxic: np.ndarray, cells: np.ndarray, n: np.ndarray, weight: np.ndarray) -> Model:
    rows = np.repeat(np.arange(len(n)), n)
    counts = np.stack([np.bincount(cells[toxic[rows] == kind], minlength=CELLS) for kind in (False, True)])
    rates = (counts + SMOOTH) / (np.bincount(toxic, minlength=2)[:, None] + 2 * SMOOTH)
    every = np.log(rates[1] / rates[0])
    # What nearly as many toxic texts as others have is scaled to nearly nothing.
    used = np.flatnonzero((counts.sum(axis=0) >= LEAST) & (np.abs(every) >= TELLS))
    ratio = every[used]
    number = np.full(CELLS, -1)
    number[used] = np.arange(len(used))
    kept = number[cells] >= 0
    rows, columns = rows[kept], number[cells][kept]
    starts = np.searchsorted(rows, np.arange(len(n) + 1))
    share = weight[toxic].sum()
    bias, w = np.log(share / (1 - share)), np.zeros(len(used))
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        total = np.concatenate([[0.0], np.cumsum((ratio * w)[columns])])
        error = weight * (1 / (1 + np.exp(-(bias + total[starts[1:]] - total[starts[:-1]]))) - toxic)
        slope = ratio * np.bincount(columns, weights=error[rows], minlength=len(w)) + PENALTY * w
        slope = np.append(slope, error.sum())
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        change = RATE * (1 - step / (STEPS + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        w -= change[:-1]
        bias -= change[-1]
    weights = np.zeros(CELLS)
    weights[used] = ratio * w
    return Model(float(bias), weights)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `score` (0 to 1) of every row. A null, empty or blank text has the score of a text without features;
    repeated rows stay repeated. A task holds a block of texts, or one longer text, with its distinct features."""
    bound = docs.sparkSession.sparkContext.broadcast(model)  # CELLS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 1):
            scores = np.clip(np.round(bound.value.scores(block.column(1)), 6), 0.0, 1.0)
            yield pa.record_batch([block.column(0), pa.array(scores)], names=["key", "score"])

    chosen = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. A null id is not held out."""
    out = scored(docs, fit(docs, labels))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
