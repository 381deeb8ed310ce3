"""Token counts under a unigram model, by dynamic programming over a trie of the distinct pre-tokens.

A task enters the distinct pre-tokens of a block in a trie, in sorted order: a node is the first of the sorted
pre-tokens that has its prefix, and the prefix's length. All nodes of one depth are scored at once, each only once
however many pre-tokens share it: the best over the pieces that end there, which a trie of the reversed pieces
finds, of the piece's score and the forward score of the node before it. At a node where a pre-token ends, its
token count and score are stored; documents add up the stored counts. Very long pre-tokens are scored one after
another along one path, so that neither their length nor their number needs memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewflow.llm.common import WORD_BLOCK_BYTES, Words, blocks, sums

#: What marks a word's start in the vocabulary.
WORD_START = "▁"
#: A byte that no piece covers costs so much more than the rarest piece.
BYTE_PENALTY = 10.0
#: Longer pre-tokens are scored along one path; so many others are in one trie.
WIDE, TRIE_WORDS = 40, 50_000


class Unigram:
    """Pieces of a public vocabulary, their log-probabilities by Zipf's law from their rank."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        total = math.log(sum(1 / (rank + 1) for rank in range(len(usual))))
        self.scores = {piece: -math.log(rank + 1) - total for rank, piece in enumerate(usual)}
        self.longest = max(map(len, usual))
        self.byte_score = min(self.scores.values()) - BYTE_PENALTY
        self._reversed_trie()

    def count(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """The tokens and the score of the best segmentation of each distinct word; fewest tokens among the best."""
        wide = [word for word in words if len(word) > WIDE or "\0" in word]
        short = sorted(set(words).difference(wide))
        stored = self._along_path(wide)
        for at in range(0, len(short), TRIE_WORDS):
            stored.update(self._by_depth(short[at : at + TRIE_WORDS]))
        return stored

    def _reversed_trie(self) -> None:
        """Moves between states, one for each end of a piece, as sorted keys; a state's piece score or none."""
        states = {"": 0}
        for piece in self.scores:
            for cut in range(len(piece) - 1, -1, -1):
                states.setdefault(piece[cut:], len(states))
        moves = sorted((states[end[1:]] << 21 | ord(end[0]), state) for end, state in states.items() if end)
        self.move_keys, self.move_to = np.array(moves, dtype=np.int64).T.copy()
        self.state_scores = np.full(len(states), -np.inf)
        for piece, score in self.scores.items():
            self.state_scores[states[piece]] = score

    def _by_depth(self, words: list[str]) -> dict[str, tuple[int, float]]:
        if not words:
            return {}
        lengths = np.array([len(word) for word in words])
        width, rows = int(lengths.max()), np.arange(len(words))
        chars = np.array(words).view(np.uint32).reshape(len(words), -1).astype(np.int64)
        # A row owns the node of its prefix of a length if it differs there from the row before.
        differs = np.ones((len(words), width), dtype=bool)
        differs[1:] = np.logical_or.accumulate(chars[1:] != chars[:-1], axis=1)
        owner = np.zeros((len(words), width + 1), dtype=np.int64)
        owner[:, 1:] = np.maximum.accumulate(np.where(differs, rows[:, None], 0), axis=0)
        best = np.zeros((len(words), width + 1))
        tokens = np.zeros((len(words), width + 1), dtype=np.int64)
        for depth in range(1, width + 1):
            nodes = rows[differs[:, depth - 1] & (lengths >= depth)]
            last = chars[nodes, depth - 1]
            n_bytes = 1 + (last > 0x7F) + (last > 0x7FF) + (last > 0xFFFF)
            before = owner[nodes, depth - 1]
            top = best[before, depth - 1] + n_bytes * self.byte_score
            count = tokens[before, depth - 1] + n_bytes
            active, state = np.arange(len(nodes)), np.zeros(len(nodes), dtype=np.int64)
            for start in range(depth - 1, max(-1, depth - 1 - self.longest), -1):
                keys = state << 21 | chars[nodes[active], start]
                at = np.minimum(np.searchsorted(self.move_keys, keys), len(self.move_keys) - 1)
                goes = self.move_keys[at] == keys
                active, state = active[goes], self.move_to[at[goes]]
                if not len(active):
                    break
                before = owner[nodes[active], start]
                score = best[before, start] + self.state_scores[state]
                n = tokens[before, start] + 1
                better = (score > top[active]) | (score == top[active]) & (n < count[active])
                top[active[better]], count[active[better]] = score[better], n[better]
            best[nodes, depth], tokens[nodes, depth] = top, count
        ends = owner[rows, lengths]
        return dict(zip(words, zip(tokens[ends, lengths].tolist(), best[ends, lengths].tolist())))

    def _along_path(self, words: list[str]) -> dict[str, tuple[int, float]]:
        scores, longest, byte = self.scores.get, self.longest, self.byte_score
        stored: dict[str, tuple[int, float]] = {}
        # The path to the current node: score and tokens of the best segmentation of each prefix.
        best, tokens, previous = [0.0], [0], ""
        for word in sorted(words):
            shared = len(commonprefix((previous, word)))
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                n_bytes = len(word[end - 1].encode())
                top, count = best[end - 1] + n_bytes * byte, tokens[end - 1] + n_bytes
                for start in range(end - 1, max(-1, end - 1 - longest), -1):
                    score = scores(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or score == top and tokens[start] + 1 < count:
                            top, count = score, tokens[start] + 1
                best.append(top)
                tokens.append(count)
            stored[word] = (tokens[-1], best[-1])
            previous = word
        return stored


@lru_cache(maxsize=2)
def _unigram(path: str) -> Unigram:
    """One for each Python worker."""
    return Unigram(path)


def token_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_words`, `n_tokens` and `score`, the summed log-probability, of every whole text.

    Words are parted by ASCII white space and start with a mark; a word's score counts in millionths. A null, empty or blank text has no tokens and
    score 0; repeated rows stay repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unigram(path)
        for block in blocks(batches, 1, WORD_BLOCK_BYTES):
            words = Words(block.column(1))
            marked = [WORD_START + word for word in words.distinct.to_pylist()]
            found = model.count(marked)
            of_word = np.array([found[word] for word in marked] or np.empty((0, 2)))
            tokens = sums(of_word[words.numbers, 0].astype(np.int64), words.lengths)
            # Whole millionths: one and the same in any order of addition.
            score = sums(np.rint(of_word[words.numbers, 1] * 1e6).astype(np.int64), words.lengths) / 1e6
            yield pa.record_batch([block.column(0), words.lengths, tokens, score], names=["key", "n_words", "n_tokens", "score"])

    chosen = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words long, n_tokens long, score double"
    return chosen.mapInArrow(run, schema).withColumnRenamed("key", key)
