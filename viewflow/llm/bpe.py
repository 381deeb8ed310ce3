"""Byte-level BPE by replaying the merges over all distinct pre-tokens of a block of the corpus.

A task cuts its texts into pre-tokens and encodes each distinct one once. The bytes of all new pre-tokens lie
in one array; an index leads from a merge's rank to the positions where its pair stands. Ranks are taken in
order; each merge rewrites its positions and only looks again at the two neighbours. No shuffle: the corpus is
cut into blocks of bounded bytes, and a worker's remembered pre-tokens are bounded in number.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from viewflow.llm.common import blocks, texts

_NO_RANK = np.iinfo(np.int32).max
#: From so many positions on, a rank's merges are done at once.
_TOGETHER = 24
#: Pre-tokens that a worker remembers between blocks; beyond that those of the block at hand.
CACHE_WORDS = 400_000
#: Bytes of text for a replay.
_BLOCK = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The merges of a rank table, replayed over many pre-tokens at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.shift = max(self.tokens).bit_length()
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << self.shift | right] = rank
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.byte_pairs = np.full((256, 256), _NO_RANK, dtype=np.int32)
        # By token: what it merges with on its right and on its left, and to which rank, sorted by the other token.
        rights: dict[int, list[tuple[int, int]]] = {}
        lefts: dict[int, list[tuple[int, int]]] = {}
        self.makers: dict[int, list[tuple[int, int]]] = {}
        for pair, rank in self.pairs.items():
            left, right = pair >> self.shift, pair & ((1 << self.shift) - 1)
            rights.setdefault(left, []).append((right, rank))
            lefts.setdefault(right, []).append((left, rank))
            self.makers.setdefault(rank, []).append((left, right))
            if len(self.tokens[rank]) == 2:
                self.byte_pairs[self.tokens[rank][0], self.tokens[rank][1]] = rank
        self.rights = {t: np.array(sorted(found), dtype=np.int32).T for t, found in rights.items()}
        self.lefts = {t: np.array(sorted(found), dtype=np.int32).T for t, found in lefts.items()}
        # Ranks whose positions depend on each other: a pair of equal tokens, or a merge that enables an earlier one.
        self.in_turn = {rank for rank, found in self.makers.items() if any(a == b for a, b in found)}
        self.in_turn |= {left for left, found in rights.items() if min(r for _, r in found) < left}
        self.in_turn |= {right for right, found in lefts.items() if min(r for _, r in found) < right}

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token; none may be empty."""
        whole = [self.ranks.get(word) for word in words]
        found = iter(self._replay([word for word, rank in zip(words, whole) if rank is None]))
        return [next(found) if rank is None else [rank] for rank in whole]

    def _replay(self, words: list[bytes]) -> list[list[int]]:
        if not words:
            return []
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        lasts = np.cumsum([len(word) for word in words]) - 1
        starts = np.concatenate([[0], lasts[:-1] + 1])
        ids = self.byte_ids[data]
        after, before = np.arange(1, len(data) + 1, dtype=np.int32), np.arange(-1, len(data) - 1, dtype=np.int32)
        after[lasts], before[starts] = -1, -1

        # The inverted index: from a rank to the left positions of its pair.
        ranks = np.full(len(data), _NO_RANK, dtype=np.int32)
        ranks[:-1] = self.byte_pairs[data[:-1], data[1:]]
        ranks[lasts] = _NO_RANK
        index = _Index()
        index.add(ranks, np.arange(len(data), dtype=np.int32))
        while index.heap:
            rank, places = index.pop()
            if len(places) < _TOGETHER or rank in self.in_turn or not self._together(rank, places, ids, after, before, index):
                self._one_by_one(rank, places.tolist(), ids.data, after.data, before.data, index)
        flat = ids
        alive = flat >= 0
        ends = np.cumsum(np.add.reduceat(alive.astype(np.int64), starts)).tolist()
        kept = flat[alive].tolist()
        return [kept[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _together(self, rank, places, ids, after, before, index) -> bool:
        """Merges all positions of a rank at once; False, with nothing done, if some overlap."""
        nexts = after[places]
        at, to = ids[places], ids[nexts]
        there = np.zeros(len(places), dtype=bool)
        for left, right in self.makers[rank]:
            there |= (at == left) & (to == right)
        there &= nexts >= 0
        places, nexts = places[there], nexts[there]
        if (nexts[:-1] == places[1:]).any():
            return False
        followers = after[nexts]
        ids[places], ids[nexts], after[places] = rank, -1, followers
        has = followers >= 0
        before[followers[has]] = places[has]
        if rank in self.rights:
            index.add(_looked_up(self.rights[rank], ids[followers[has]]), places[has])
        if rank in self.lefts:
            leaders = before[places]
            leaders = leaders[leaders >= 0]
            index.add(_looked_up(self.lefts[rank], ids[leaders]), leaders)
        return True

    def _one_by_one(self, rank, places, ids, after, before, index) -> None:
        """Merges positions of a rank from left to right."""
        pairs, shift = self.pairs, self.shift
        for at, left in enumerate(places):
            right = after[left]
            if right < 0 or ids[left] < 0 or pairs.get(ids[left] << shift | ids[right]) != rank:
                continue
            ids[left], ids[right] = rank, -1
            follower = after[left] = after[right]
            lower = False
            if follower >= 0:
                before[follower] = left
                new = pairs.get(rank << shift | ids[follower])
                if new is not None:
                    index.add_one(new, left)
                    lower = new < rank
            leader = before[left]
            if leader >= 0:
                new = pairs.get(ids[leader] << shift | rank)
                if new is not None:
                    index.add_one(new, leader)
                    lower = lower or new < rank
            if lower and at + 1 < len(places):
                # An earlier merge became possible: it goes first, the rest of this rank after it.
                for place in places[at + 1 :]:
                    index.add_one(rank, place)
                return


class _Index:
    """Positions by rank, and the ranks that have some as a heap."""

    def __init__(self):
        self.heap: list[int] = []
        self.many: dict[int, list[np.ndarray]] = {}
        self.single: dict[int, list[int]] = {}

    def add_one(self, rank: int, place: int) -> None:
        if rank in self.single:
            self.single[rank].append(place)
        else:
            if rank not in self.many:
                heapq.heappush(self.heap, rank)
            self.single[rank] = [place]

    def add(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Adds positions with their ranks; positions without a rank are left out."""
        has = ranks != _NO_RANK
        ranks, places = ranks[has], places[has]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts)):
            if rank in self.many:
                self.many[rank].append(part)
            else:
                if rank not in self.single:
                    heapq.heappush(self.heap, rank)
                self.many[rank] = [part]

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.heap)
        parts = self.many.pop(rank, [])
        if rank in self.single:
            parts = [*parts, np.array(self.single.pop(rank), dtype=np.int32)]
        return rank, np.unique(np.concatenate(parts))


def _looked_up(table: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The ranks of pairs with the given other tokens."""
    keys, ranks = table
    at = np.minimum(np.searchsorted(keys, others), len(keys) - 1)
    return np.where(keys[at] == others, ranks[at], _NO_RANK)


def _char_class(prop: str) -> str:
    """The characters of the basic plane with a property, as ranges of a character class."""
    has = regex.compile(prop).match
    spans: list[list[int]] = []
    for code in range(0x10000):
        if not 0xD800 <= code < 0xE000 and has(chr(code)):
            if spans and spans[-1][1] == code - 1:
                spans[-1][1] = code
            else:
                spans.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)


class Splitter:
    """Cuts texts by a pattern with Unicode classes. Texts of the basic plane, nearly all, take the faster engine."""

    def __init__(self, pattern: str):
        self.exact = regex.compile(pattern)
        letters, numbers, spaces = _char_class(r"\p{L}"), _char_class(r"\p{N}"), _char_class(r"\p{White_Space}")
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
        plain = plain.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        plain = plain.replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]")
        self.plain = None if r"\p" in plain else re.compile(plain)
        self.beyond = re.compile("[\U00010000-\U0010ffff]")

    def __call__(self, text: str) -> list[str]:
        if self.plain is None or self.beyond.search(text):
            return self.exact.findall(text)
        return self.plain.findall(text)


class Encoder:
    """Texts to ids and back; remembers a bounded number of pre-tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        self.merges, self.split = Merges(read_ranks(ranks_path)), Splitter(pattern)
        #: By pre-token: its ids; and for digests, its ids as text and the bytes they stand for.
        self.ids: dict[str, list[int]] = {}
        self.shown: dict[str, str] = {}
        self.back: dict[str, bytes] = {}

    def pieces(self, batch: list[str]) -> list[list[str]]:
        """The pre-tokens of each text, all of them known to `ids` afterwards."""
        cut = [self.split(text) for text in batch]
        self.ids.update(self.unknown(cut, self.ids))
        return cut

    def digested(self, batch: list[str]) -> list[list[str]]:
        """The pre-tokens of each text, all of them known to `shown` and `back` afterwards."""
        cut = [self.split(text) for text in batch]
        for word, ids in self.unknown(cut, self.shown, self.back):
            self.shown[word], self.back[word] = " ".join(map(str, ids)), self.decode(ids)
        return cut

    def unknown(self, cut: list[list[str]], *known: dict) -> Iterator[tuple[str, list[int]]]:
        """The pre-tokens that aren't known yet, each with its ids. What is known too much is forgotten."""
        words = set().union(*cut)
        new = [word for word in words if word not in known[0]]
        if len(known[0]) + len(new) > CACHE_WORDS:
            for memory in known:
                kept = {word: memory[word] for word in words if word in memory}
                memory.clear()
                memory.update(kept)
        return zip(new, self.merges.encode([word.encode() for word in new]))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(ranks_path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `ids` (array of ints) of every row; a null or empty text has no ids, repeated rows stay repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path, pattern)
        for block in blocks(batches, 1, _BLOCK):
            ids = [[i for piece in cut for i in coder.ids[piece]] for cut in coder.pieces(texts(block.column(1)))]
            yield pa.record_batch([block.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])

    chosen = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`key` and `decoded` (bytes) of every row; null ids give no bytes, an id that the ranks don't have fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path, pattern)
        for batch in batches:
            out = [coder.decode(row or ()) for row in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["key", "decoded"])

    chosen = df.select(df[key].alias("key"), df[ids].alias("ids"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every text in one pass and returns digests: `key`, `n_tokens`, `ids_sha256`,
    `decoded_sha256`. Null and empty texts: no tokens, the digests of nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path, pattern)
        for block in blocks(batches, 1, _BLOCK):
            counts, ids_sha, decoded_sha = [], [], []
            for cut in coder.digested(texts(block.column(1))):
                ids = " ".join(map(coder.shown.__getitem__, cut))
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(b"".join(map(coder.back.__getitem__, cut))).hexdigest())
            yield pa.record_batch(
                [block.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return chosen.mapInArrow(run, schema).withColumnRenamed("key", key)
