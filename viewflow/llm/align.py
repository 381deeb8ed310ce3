"""Two tokenizers aligned over the bytes of each text, by products of sparse incidence matrices.

A token's bytes are a row of an incidence matrix in compressed rows (CSR), built by hand for each tokenizer. Gustavson's
row product of the first with the second's transpose gives the tokens that overlap. Where tokens of both end at one
byte, a group ends; products with the incidence of bytes and groups put tokens into groups, and the product of the
groups' tokens gives the links: all pairs of tokens of one group, as pairs of ids with their number.

How many documents of the corpus hold a pair linked is summed up in two steps: each block of texts lists its distinct
pairs once, the lists are added up by pair, and each block gets the counts of its own pairs back.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewflow.llm.common import blocks, gathered, stored, sums
from viewflow.llm.packing import _BYTE_CHARS

#: Bytes of text whose words are encoded together, of those whose matrices are made together, and elements that a
#: product expands to at a time.
BLOCK, SLICE, EXPANDED = 2 << 20, 128 << 10, 1 << 22
#: Words that the byte-level tokenizer gets as one text, as each call for a word of its own costs more than the word.
RUN = 32
_SEPARATORS = (",", "|", ";", "")
_CUT = r"([\p{L}\p{M}\p{N}\p{P}\p{S}]) "
_END = r"[\p{L}\p{M}\p{N}\p{P}\p{S}]\z"


@dataclass
class Csr:
    """A sparse matrix of whole numbers: `starts` of the rows in `columns` and `values`."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of_runs(cls, lengths: np.ndarray, width: int) -> Csr:
        """Ones in consecutive runs of columns, one run a row."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return cls(starts, np.arange(starts[-1]), np.ones(starts[-1], dtype=np.int64), width)

    @classmethod
    def of_ones(cls, columns: np.ndarray, width: int) -> Csr:
        """A single one in each row."""
        return cls(np.arange(len(columns) + 1), columns, np.ones(len(columns), dtype=np.int64), width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, rows[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: each row is the sum of the other's rows that its columns name. Rows are taken together
        as long as they expand to at most `EXPANDED` elements; one row alone may be longer."""
        lengths = np.diff(other.starts)
        size = np.concatenate([[0], np.cumsum(lengths[self.columns])])[self.starts]
        n = len(self.starts) - 1
        columns, values, counts, row = [], [], [], 0
        while row < n:
            end = max(row + 1, int(np.searchsorted(size, size[row] + EXPANDED, "right")) - 1)
            first, last = self.starts[row], self.starts[end]
            own = self.columns[first:last]
            place, taken = gathered(other.starts[:-1], lengths, own)
            of = np.repeat(np.repeat(np.arange(end - row), np.diff(self.starts[row : end + 1])), taken)
            weight = np.repeat(self.values[first:last], taken) * other.values[place]
            column = other.columns[place]
            cell = of * other.width + column
            if len(cell) and (cell[1:] < cell[:-1]).any():
                order = np.argsort(cell, kind="stable")
                cell, weight, column, of = cell[order], weight[order], column[order], of[order]
            new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, dtype=np.int64)
            columns.append(column[new])
            values.append(np.add.reduceat(weight, new) if len(new) else weight)
            counts.append(np.bincount(of[new], minlength=end - row))
            row = end
        parts = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (columns, values, counts)]
        return Csr(np.concatenate([[0], np.cumsum(parts[2])]), parts[0], parts[1], other.width)


@dataclass
class Tokenizer:
    """Ids of words, one word after another, with their number by word; and the bytes of each id."""

    encode: object
    pieces: pa.BinaryArray
    #: The ids in decimal digits, followed by each of the separators: id times their number plus the separator's place.
    shown: pa.BinaryArray

    @classmethod
    def of(cls, encode, pieces: list[bytes]) -> Tokenizer:
        return cls(encode, pa.array(pieces, pa.large_binary()), pa.array([f"{i}{s}".encode() for i in range(len(pieces)) for s in _SEPARATORS], pa.large_binary()))

    def tokens(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, memoryview]:
        """Ids, how many each text has, lengths of the ids' bytes, and all of those bytes."""
        flat, lengths = self.encode(words.distinct)
        place, taken = gathered(np.cumsum(lengths) - lengths, lengths, words.numbers)
        flat = flat[place]
        return flat, sums(taken, words.lengths), *_joined(self.pieces, flat)


class Words:
    """Texts cut where a space follows a letter, digit, sign or mark, where no token of either kind goes on: distinct
    parts without that space, each part's place among them, and how many parts a text has (an empty one: none)."""

    def __init__(self, texts: list[str]):
        column = pa.array(texts, pa.string())
        if pc.any(pc.match_substring(column, "\0")).as_py():  # the mark of a cut: such a text stays whole
            lists = pa.array([[text] if "\0" in text else _cut(pa.array([text]))[0].as_py() for text in texts], pa.list_(pa.string()))
        else:
            lists = _cut(column)
        self.lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(lists)
        empty = np.array([not text for text in texts], dtype=bool)
        if empty.any():
            flat = flat.filter(pa.array(~np.repeat(empty, self.lengths)))
            self.lengths[empty] = 0
        coded = flat.dictionary_encode()
        self.distinct: list[str] = coded.dictionary.to_pylist()
        self.numbers = coded.indices.to_numpy(zero_copy_only=False)


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many each list has."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum())), lengths


def _in_runs(words: list[str], encode, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words with a space before each, as `_flat` has them, from texts of up to `RUN` words.

    A word is followed by others only where texts are cut too; the ids' `sizes` in bytes tell where it ends. If they
    don't, the words are encoded one by one.
    """
    column = pa.array(words, pa.string())
    last = ~pc.match_substring_regex(column, _END).to_numpy(zero_copy_only=False).astype(bool)
    last[RUN - 1 :: RUN] = True
    last[-1:] = True
    ends = (np.flatnonzero(last) + 1).tolist()
    flat, _ = _flat(encode([" " + " ".join(words[s:e]) for s, e in zip([0, *ends], ends)]))
    token_ends = np.cumsum(sizes[flat])
    word_ends = np.cumsum(pc.binary_length(column).to_numpy().astype(np.int64) + 1)
    at = np.searchsorted(token_ends, word_ends, "right")
    if np.array_equal(np.concatenate([[0], token_ends])[at], word_ends) and (at[-1:] == len(flat)).all():
        return flat, np.diff(at, prepend=0)
    return _flat(encode([" " + word for word in words]))


def _joined(table: pa.LargeBinaryArray, chosen: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """The lengths of the chosen entries, and all their bytes."""
    taken = table.take(pa.array(chosen))
    offsets = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, dtype=np.int64)
    data = memoryview(taken.buffers()[2]).cast("B")[int(offsets[0]) : int(offsets[-1])] if len(taken) else memoryview(b"")
    return np.diff(offsets), data


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokenizer:
    """A byte-level tokenizer's file, over a space and the text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores
    from tokenizers import Tokenizer as Library

    library = Library.from_file(path)
    library.encode_special_tokens = True
    byte = {char: b for b, char in _BYTE_CHARS.items()}
    size = library.get_vocab_size(with_added_tokens=True)
    names = [library.id_to_token(i) or "" for i in range(size)]
    pieces = [bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode() for name in names]

    sizes = np.fromiter(map(len, pieces), np.int64, size)

    def encode(texts: list[str]) -> list[list[int]]:
        return [found.ids for found in library.encode_batch_fast(texts, add_special_tokens=False)]

    return Tokenizer.of(lambda words: _in_runs(words, encode, sizes), pieces)


@lru_cache(maxsize=2)
def piece_level(path: str) -> Tokenizer:
    """A piece model's file, over the text; the model itself puts a space before it."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    pieces = [bytes([int(name[1:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
    space = [model.piece_to_id("▁")]
    # What is left of a text behind its last space is empty: the space alone.
    return Tokenizer.of(lambda words: _flat([ids or space for ids in model.encode(words, num_threads=1)]), pieces)


def _cut(column: pa.StringArray) -> pa.ListArray:
    return pc.split_pattern(pc.replace_substring_regex(column, _CUT, "\\1\0"), "\0")


@dataclass
class Alignment:
    """What a block of texts comes to; by text: tokens, groups, links, digest, and pairs of ids with their number."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    #: Pairs of each text, text after text: how many, first id times the second's vocabulary plus the second id, number.
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    #: Overlapping tokens: first token, second token, shared bytes; a matrix for every few texts.
    overlaps: list[Csr]


def align(texts: list[str], a: Tokenizer, b: Tokenizer) -> Alignment:
    """The texts one by one. One that is empty, or whose joined bytes differ from a space and the text, has no tokens.

    The words of all texts are encoded once; the matrices are those of a few texts at a time, of `SLICE` bytes.
    """
    wanted = [b" " + text.encode() if text else b"" for text in texts]
    sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
    words = Words(texts)
    sides = [tokenizer.tokens(words) for tokenizer in (a, b)]
    good = sizes > 0
    for _, n, lengths, data in sides:
        found = sums(lengths, n)
        ends = np.cumsum(found)
        if not (found == sizes).all() or data != b"".join(wanted):
            good &= np.array([data[e - f : e] == w for e, f, w in zip(ends.tolist(), found.tolist(), wanted)], dtype=bool)
    parts = []
    for ids, n, lengths, _ in sides:
        kept = np.repeat(good, n)
        parts.append((ids[kept], np.where(good, n, 0), lengths[kept]))
    sizes = np.where(good, sizes, 0)
    ends, cuts = np.cumsum(sizes), [0]
    while cuts[-1] < len(texts):
        before = int(ends[cuts[-1] - 1]) if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, before + SLICE, "right"))))
    places = [np.concatenate([[0], np.cumsum(n)]) for _, n, _ in parts]
    found = []
    for first, last in zip(cuts, cuts[1:]):
        own = [(ids[p[first] : p[last]], n[first:last], lengths[p[first] : p[last]]) for (ids, n, lengths), p in zip(parts, places)]
        found.append(_aligned(sizes[first:last], own, a, b))
    joined = {f.name: [getattr(part, f.name) for part in found] for f in fields(Alignment)}
    none = np.zeros(0, dtype=np.int64)
    return Alignment(**{name: sum(x, []) if name in ("digests", "overlaps") else np.concatenate([none, *x]) for name, x in joined.items()})


def _aligned(sizes: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], a: Tokenizer, b: Tokenizer) -> Alignment:
    """A few texts from their sizes and, of each side, their ids, the number of them by text, and the ids' lengths."""
    (ids_a, n_a, lengths_a), (ids_b, n_b, lengths_b) = parts
    total = int(sizes.sum())
    of_a, of_b = Csr.of_runs(lengths_a, total), Csr.of_runs(lengths_b, total)
    overlaps = of_a.times(of_b.transposed())
    # Each token's last overlap ends with it in both: there a group ends.
    ends = np.zeros(total, dtype=np.int8)
    ends[np.cumsum(lengths_a) - 1] += 1
    ends[np.cumsum(lengths_b) - 1] += 1
    both = ends == 2
    group = np.cumsum(both) - both
    n_all = int(both.sum())
    of_group = Csr.of_ones(group, n_all)
    in_a, in_b = of_a.times(of_group), of_b.times(of_group)  # one group a token
    text_of = np.repeat(np.arange(len(sizes)), sizes)[both]  # by group
    size_a, size_b = np.bincount(in_a.columns, minlength=n_all), np.bincount(in_b.columns, minlength=n_all)
    # The groups' ids with their number, and the sum of their products by pair of ids in each text.
    ids = [_by_group(in_a.columns, ids_a, len(a.pieces), n_all), _by_group(in_b.columns, ids_b, len(b.pieces), n_all)]
    pairs, times, n_pairs = _linked(*ids, text_of, len(sizes), len(b.pieces))
    digests = _digests(a, b, (ids_a, in_a.columns, size_a), (ids_b, in_b.columns, size_b), n_a, n_b, text_of)
    n_links = np.bincount(text_of, weights=size_a * size_b, minlength=len(sizes)).astype(np.int64)
    return Alignment(n_a, n_b, np.bincount(text_of, minlength=len(sizes)), n_links, digests, n_pairs, pairs, times, [overlaps])


def _by_group(groups: np.ndarray, ids: np.ndarray, vocabulary: int, n_groups: int) -> Csr:
    """Groups by ids, with numbers."""
    cells, times = np.unique(groups * vocabulary + ids, return_counts=True)
    starts = np.concatenate([[0], np.cumsum(np.bincount(cells // vocabulary, minlength=n_groups))])
    return Csr(starts, cells % vocabulary, times.astype(np.int64), vocabulary)


def _linked(a: Csr, b: Csr, text_of: np.ndarray, n_texts: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of all texts with their numbers, and how many pairs each text has.

    The product has a row for each id of a group, which names the group's row of the other tokenizer; its rows that
    belong to one id of one text are added up.
    """
    group = np.repeat(np.arange(len(a.starts) - 1), np.diff(a.starts))
    links = Csr(np.arange(len(group) + 1), group, a.values, len(a.starts) - 1).times(b)
    n = np.diff(links.starts)
    text = np.repeat(text_of[group], n)
    pair = np.repeat(a.columns, n) * vocabulary + links.columns
    cell = text * (a.width * vocabulary) + pair
    order = np.argsort(cell, kind="stable")
    cell, text, pair, times = cell[order], text[order], pair[order], links.values[order]
    new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(pair) else np.zeros(0, dtype=np.int64)
    return pair[new], np.add.reduceat(times, new) if len(new) else times, np.bincount(text[new], minlength=n_texts)


def _digests(a: Tokenizer, b: Tokenizer, first: tuple, second: tuple, n_a: np.ndarray, n_b: np.ndarray, text_of: np.ndarray) -> list[str]:
    """The hash of each text's groups: the ids of both tokenizers in order, put between separators."""
    columns, places = [], []
    last_group = np.concatenate([text_of[1:] != text_of[:-1], [True]])
    before = np.cumsum(first[2] + second[2]) - first[2] - second[2]
    for side, (ids, group, size) in enumerate((first, second)):
        at = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        last = at == np.repeat(size, size) - 1
        separator = np.where(last, np.where(side == 0, 1, np.where(last_group[group], 3, 2)), 0)
        columns.append(ids * len(_SEPARATORS) + separator)
        places.append(np.repeat(before + (first[2] if side else 0), size) + at)
    every = np.empty(len(columns[0]) + len(columns[1]), dtype=np.int64)
    every[places[0]] = columns[0]
    every[places[1]] = columns[1] + len(a.shown)
    lengths, data = _joined(pa.concat_arrays([a.shown, b.shown]), every)
    ends = np.cumsum(sums(lengths, n_a + n_b))
    starts = np.concatenate([[0], ends[:-1]])
    return [hashlib.sha256(data[s:e]).hexdigest() if e > s else "" for s, e in zip(starts.tolist(), ends.tolist())]


def links(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    `n_best` counts the links whose pair is held linked by as many documents as any pair of its first id, `count_sum`
    adds up the documents of all links. A null or empty text, or one that a tokenizer changes, has zeros and ''.
    Repeated rows are documents of their own. A task holds a block of texts, or one longer text, with its links' pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(byte_path), piece_level(piece_path)
        for block in blocks(batches, 1, BLOCK):
            found = align(["" if x is None else x for x in block.column(1).to_pylist()], a, b)
            distinct, number = np.unique(found.pairs, return_inverse=True)
            ends = np.concatenate([[0], np.cumsum(found.n_pairs)])
            width = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
            listed = pa.StructArray.from_arrays(
                [pa.array(distinct, pa.int64()), pa.array(np.bincount(number, minlength=len(distinct)), pa.int64())], names=["pair", "n"]
            )
            own = [number[s:e].astype(width).tobytes() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            # The numbers that aren't 1: places and numbers.
            more = np.flatnonzero(found.times > 1)
            cuts = np.searchsorted(more, ends)
            of = np.repeat(ends[:-1], np.diff(cuts))
            many = np.stack([more - of, found.times[more]], axis=1)
            several = [many[s:e].tobytes() for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            shown = pa.ListArray.from_arrays(pa.array([0] + [len(distinct)] * len(block), pa.int32()), listed)
            columns = [pa.array([uuid.uuid4().hex] * len(block)), block.column(0), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links, found.digests))]
            columns += [pa.array(own, pa.binary()), pa.array([np.dtype(width).itemsize] * len(block), pa.int32()), pa.array(several, pa.binary()), shown]
            yield pa.record_batch(columns, names=["block", "key", *_COUNTS, "groups_sha256", "numbers", "width", "several", "pairs"])

    chosen = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    rest = "numbers binary, width int, several binary, pairs array<struct<pair:long,n:long>>"
    # Stored, as a block's name is new each time.
    rows = stored(chosen.mapInArrow(run, f"block string, key {kind}, {counts}, groups_sha256 string, {rest}"))
    held = rows.select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "p")).select("of", "at", "p.pair", "p.n")
    size = len(piece_level(piece_path).pieces)
    of_pair = held.groupBy("pair").agg(F.sum("n").alias("count"))
    # No more rows to a first id than the second vocabulary has.
    highest = Window.partitionBy(F.expr(f"pair div {size}"))
    of_pair = of_pair.select("pair", "count", (F.col("count") == F.max("count").over(highest)).alias("best"))
    counted = held.select("of", "at", "pair").join(of_pair, "pair").select("of", "at", "count", "best")

    def added(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(len(right), dtype=np.int64), np.zeros(len(right), dtype=np.int64)
        at = right["at"].to_numpy()
        count[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy()
        total, n_best = [], []
        for numbers, width, several in zip(left["numbers"].to_pylist(), left["width"].to_pylist(), left["several"].to_pylist()):
            own = np.frombuffer(numbers, dtype=np.uint16 if width == 2 else np.uint32)
            times = np.ones(len(own), dtype=np.int64)
            place, many = np.frombuffer(several, dtype=np.int64).reshape(-1, 2).T
            times[place] = many
            total.append(int(times @ count[own]))
            n_best.append(int(times @ best[own]))
        columns = [left["key"], *(left[name] for name in _COUNTS), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), left["groups_sha256"]]
        return pa.table(columns, names=["key", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    # A block's texts meet the counts of its pairs.
    scored = rows.drop("pairs").groupBy("block").cogroup(counted.groupBy("of"))
    return scored.applyInArrow(added, f"key {kind}, {counts}, n_best long, count_sum long, groups_sha256 string").withColumnRenamed("key", key)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
