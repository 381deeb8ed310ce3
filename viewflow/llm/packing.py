"""Packing by concatenate and cut: token totals of partitions, prefix sums over them, fixed windows.

Every text is tokenised once; the ids are written to a shared folder with the number of the task's partition and
the offset within it. The totals of the partitions, one row each, are summed up to where each partition starts in
the endless sequence, and windows of fixed length cut it. A document over a window's end is cut into pieces. Only
the very last sequence is shorter and thus padded.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewflow.llm.common import WORD_BLOCK_BYTES, Words, blocks, gathered, stored, sums

#: Ids per sequence, and the id that ends a document.
SEQUENCE, END_ID = 2048, 1
#: Words of plain letters, which need no normalisation but lower case, and the marks after them.
_PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!#$%&*+,./:;=?@|~-]*)$"
#: Where the byte-level alphabet shows bytes that are not printable: next free code points, in order.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_BYTE_CHARS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}


class WordTokenizer:
    """Ids of a tokenizer that never joins what white space parts; of each distinct word of a block once.

    A word of plain letters goes to the merges in lower case, without the marks at its end: the tokenizer would
    lower and part it itself. All other words go through all its steps.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after another, and how many each has."""
        cut = pc.extract_regex(words, _PLAIN)
        plain = pc.is_valid(cut)
        # A word is a plain part (or none) and a rest for all steps (perhaps empty).
        first = pc.utf8_lower(cut.field("word").filter(plain)).dictionary_encode()
        rest = pc.if_else(plain, cut.field("marks"), words).dictionary_encode()
        plain_ids, plain_n = _ids(self.merges, list(map(_byte_chars, first.dictionary.to_pylist())))
        other_ids, other_n = _ids(self.tokenizer, rest.dictionary.to_pylist())
        lengths = np.concatenate([[0], plain_n, other_n])
        starts = np.cumsum(lengths) - lengths
        chosen = np.zeros((len(words), 2), dtype=np.int64)
        chosen[plain.to_numpy(zero_copy_only=False), 0] = first.indices.to_numpy(zero_copy_only=False) + 1
        chosen[:, 1] = rest.indices.to_numpy(zero_copy_only=False) + 1 + len(plain_n)
        places, taken = gathered(starts, lengths, chosen.ravel())
        return np.concatenate([plain_ids, other_ids])[places], taken.reshape(-1, 2).sum(axis=1)


def _ids(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after another, and how many each has."""
    flat: list[int] = []
    lengths: list[int] = []
    for at in range(0, len(words), 10_000):
        for found in tokenizer.encode_batch_fast(words[at : at + 10_000], add_special_tokens=False):
            ids = found.ids
            flat += ids
            lengths.append(len(ids))
    return np.array(flat, dtype="<u4"), np.array(lengths, dtype=np.int64)


def _byte_chars(text: str) -> str:
    """The text's bytes in the byte-level alphabet."""
    return text if text.isascii() else "".join([_BYTE_CHARS[b] for b in text.encode()])


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, in one thread: Spark's tasks share the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(path)


def tokenise(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """`key`, `ids` (little-endian unsigned 32-bit, `end_id` last), `n` of them, `part`, and `place`: the ids before
    it in that part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, place = _tokenizer(path), TaskContext.get().partitionId(), 0
        for block in blocks(batches, 1, WORD_BLOCK_BYTES):
            words = Words(block.column(1))
            ids, lengths = tokenizer.encode(words.distinct)
            # The end id is one more word, after the last of each text.
            ids, lengths = np.append(ids, np.uint32(end_id)), np.append(lengths, 1)
            numbers = np.insert(words.numbers, np.cumsum(words.lengths), len(lengths) - 1)
            places, taken = gathered(np.cumsum(lengths) - lengths, lengths, numbers)
            n = sums(taken, words.lengths + 1)
            ends = np.cumsum(n)
            offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids[places].astype("<u4"))]
            )
            columns = [block.column(0), packed, n, np.full(len(n), part), place + ends - n]
            yield pa.record_batch(columns, names=["key", "ids", "n", "part", "place"])
            place += int(ends[-1])

    chosen = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, ids binary, n long, part long, place long").withColumnRenamed("key", key)


def pack(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A null or empty text is the end id alone; repeated rows are packed each; no rows give no pieces. `ids` are
    the piece's own.
    """
    tokens = stored(tokenise(df, path, key, text, end_id))
    # A row for each partition of the text table, not of the data.
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    placed = tokens.join(F.broadcast(starts), "part").withColumn("at", F.col("first") + F.col("place"))
    from_, to = F.col("at"), F.col("at") + F.col("n")

    def piece(number):
        start = F.greatest(number * sequence, from_)
        length = F.least((number + 1) * sequence, to) - start
        first = (start - from_).cast("int")
        return F.struct(
            (start - from_).alias("start"),
            length.alias("length"),
            F.substring(F.col("ids"), first * 4 + 1, (length * 4).cast("int")).alias("ids"),
            number.alias("sequence_id"),
            (start - number * sequence).alias("offset"),
        )

    numbers = F.sequence(F.floor(from_ / sequence), F.floor((to - 1) / sequence))
    pieces = placed.select(key, F.col("n").alias("doc_tokens"), F.inline(F.transform(numbers, piece)))
    columns = [key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids"]
    return pieces.select(*columns)
