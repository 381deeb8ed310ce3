"""Languages of a text's words: script ranges narrow the candidates, Viterbi labels spans.

Each word is scored for every learned language by its letter groups (two and three bytes, and the whole word). A
language of which hardly any training word has the word's script is set back. Viterbi finds the labels of all words
of a text with the highest sum of scores, where each change of language costs a penalty. The text's language is the
one of most letters. Texts of a block advance together, one word a step, so that a step is a few array operations.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewflow.llm.common import WORD_BLOCK_BYTES, Words, blocks, sums

#: Training documents of each language, at most but for a chance of about one in a billion.
SAMPLE = 530
#: Cells of hashed letter groups, smoothing, cost of a change, cost of a language of another script.
CELLS, SMOOTH, SWITCH, OTHER_SCRIPT = 1 << 15, 0.5, 6.0, 30.0
#: Least share of a language's training words in a script to be a candidate there.
SCRIPT_SHARE = 0.02
#: Least mean margin of a word (in the logarithm of probability) for a document to be kept.
MARGIN = 0.1
UNKNOWN = "und"
#: First code points of the Unicode ranges of scripts, each up to the next; 0 is any other.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0250, "other"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0900, "devanagari"),
    (0x0980, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
)
_FIRST = [first for first, _ in SCRIPTS]
_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT = [_NAMES.index(name) for _, name in SCRIPTS]


def script_of(word: str) -> int:
    """The script of a word's first letter."""
    return _SCRIPT[bisect_right(_FIRST, ord(word[0])) - 1]


def _letters(words: pa.Array) -> pa.Array:
    """The letters and marks of words that have a letter."""
    bare = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}]+", "")
    return pc.if_else(pc.match_substring_regex(bare, r"\p{L}"), bare, "")


def _cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of the letter groups of words one after another, and how many each has."""
    coded = [b"\x01" + word.encode() + b"\x02" for word in words]
    lengths = np.array([len(c) for c in coded], dtype=np.int64)
    data = np.frombuffer(b"".join(coded) + b"\0\0", dtype=np.uint8).astype(np.uint64)
    two = data[:-2] << np.uint64(8) | data[1:-1]
    three = two << np.uint64(8) | data[2:]
    starts = np.cumsum(lengths) - lengths
    # Of n bytes: n - 1 groups of two, n - 2 of three, one for all of them.
    place = np.arange(len(two)) - np.repeat(starts, lengths)
    rest = np.repeat(lengths, lengths) - place
    mixed = np.uint64(0x9E3779B97F4A7C15)
    whole = np.add.reduceat(data[:-2] * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * mixed, starts) if len(words) else two
    found = np.full((len(two), 3), -1, dtype=np.int64)
    shift = np.uint64(64 - CELLS.bit_length() + 1)
    found[rest > 1, 0] = (two[rest > 1] * mixed) >> shift
    found[rest > 2, 1] = ((three[rest > 2] + np.uint64(1 << 25)) * mixed) >> shift
    found[starts, 2] = (((whole >> np.uint64(7)) ^ whole) * mixed) >> shift
    flat = found.ravel()
    return flat[flat >= 0], lengths - 1 + lengths - 2 + 1


@dataclass
class Model:
    langs: list[str]
    #: By cell and language.
    scores: np.ndarray
    #: By script and language: what a word of the script is set back by.
    set_back: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """By word and language; 0 for a word without a letter."""
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        has = [i for i, word in enumerate(words) if word]
        if has:
            own = [words[i] for i in has]
            cells, n = _cells(own)
            starts = np.cumsum(n) - n
            out[has] = np.add.reduceat(self.scores[cells], starts, axis=0)
            scripts: dict[str, int] = {}
            codes = [scripts[c] if (c := word[0]) in scripts else scripts.setdefault(c, script_of(c)) for word in own]
            out[has] += self.set_back[codes]
        return out

    def spans(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The labels of words (rows of scores, text after text) with the highest sum, changes paid for."""
        n_words, n_langs = scores.shape
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        firsts, sizes = starts[order], lengths[order]
        # How many texts have a word at each step.
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        change = np.zeros((n_words, n_langs), dtype=bool)
        source = np.zeros(n_words, dtype=np.int32)
        best = np.zeros((len(lengths), n_langs), dtype=np.float32)
        for step, k in enumerate(active.tolist()):
            now, at = best[:k], firsts[:k] + step
            if step:
                source[at] = top = now.argmax(axis=1)
                entered = now[np.arange(k), top] - SWITCH
                change[at] = entered[:, None] > now
                np.maximum(now, entered[:, None], out=now)
            now += scores[at]
            # Only differences count: kept small, they stay exact enough over any length.
            now -= now.max(axis=1)[:, None]
        labels = np.zeros(n_words, dtype=np.int32)
        state = best.argmax(axis=1)
        for step in range(len(active) - 1, -1, -1):
            k = int(active[step])
            at, now = firsts[:k] + step, state[:k]
            labels[at] = now
            state[:k] = np.where(change[at, now], source[at], now)
        return labels


def training_rows(docs: DataFrame):
    """Documents with a language whose id's checksum is not divisible by five."""
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & learned)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learned from at most `sample` whole documents of each language, those whose id's hash is small enough for that.

    Of several texts with one id and language the least is taken. No documents of one language meet in one task.
    """
    ids = training_rows(docs).select("doc_id", "lang").distinct()
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))
    most = max(sample - 6 * sample**0.5, 1)
    share = F.when(F.col("n") > sample, most / F.col("n")).otherwise(1.0)
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    chosen = ids.join(F.broadcast(sizes), "lang").filter(place < share)
    texts = training_rows(docs).select("doc_id", "lang", "text").join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"])
    texts = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    # A row for each language and cell or script.
    found = texts.select("lang", "text").mapInArrow(_counted, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    langs = sorted(row.lang for row in found if row.cell < 0)
    number = {lang: i for i, lang in enumerate(langs)}
    both = np.zeros((CELLS + len(_NAMES), len(langs)))
    for row in found:
        if row.cell >= 0:
            both[row.cell, number[row.lang]] = row.n
    counts, scripts = both[:CELLS], both[CELLS:]
    scores = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * CELLS)) if langs else counts
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    candidate = share >= SCRIPT_SHARE
    # A script that no language was learned in has all of them as candidates.
    candidate[~candidate.any(axis=1)] = True
    return Model(langs, scores.astype(np.float32), np.where(candidate, 0.0, -OTHER_SCRIPT).astype(np.float32))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each language's texts have each cell, and from `CELLS` on words of each script; a row at -1."""
    for block in blocks(batches, 1, WORD_BLOCK_BYTES):
        for lang in pc.unique(block.column(0)).to_pylist():
            words = Words(block.column(1).filter(pc.equal(block.column(0), lang)))
            times = np.bincount(words.numbers, minlength=len(words.distinct)).tolist()
            own = [(word, n) for word, n in zip(_letters(words.distinct).to_pylist(), times) if word]
            cells, n = _cells([word for word, _ in own])
            counts = np.bincount(cells, weights=np.repeat([float(t) for _, t in own], n), minlength=CELLS + len(_NAMES)).astype(np.int64)
            for word, t in own:
                counts[CELLS + script_of(word)] += t
            there = np.flatnonzero(counts)
            columns = [[lang] * (len(there) + 1), np.append(there, -1).astype(np.int32), np.append(counts[there], 0)]
            yield pa.record_batch([pa.array(c) for c in columns], names=["lang", "cell", "n"])


def _labelled(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray, pa.Array, np.ndarray]:
    """Language, its share of the letters, the spans (first word, words, language) of each text, and the mean margin of
    a word: by how much the score of its span's language is above that of the next best one for the span."""
    words = Words(column)
    letters = _letters(words.distinct)
    sizes = pc.utf8_length(letters).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = letters.dictionary_encode()
    of_word = model.word_scores(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    # Words without a letter take no part, but keep their places.
    place = np.arange(len(words.numbers)) - np.repeat(np.cumsum(words.lengths) - words.lengths, words.lengths)
    has = sizes[words.numbers] > 0
    lengths = sums(has.astype(np.int64), words.lengths)
    numbers, place = words.numbers[has], place[has]
    scores = of_word[numbers]
    labels = model.spans(scores, lengths)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    weight = np.bincount(rows * len(model.langs) + labels, weights=sizes[numbers], minlength=len(lengths) * len(model.langs))
    weight = weight.reshape(len(lengths), -1)
    total, top = weight.sum(axis=1), weight.argmax(axis=1)
    share = np.where(total > 0, weight.max(axis=1) / np.maximum(total, 1), 0.0)
    langs = [model.langs[t] if n else UNKNOWN for t, n in zip(top.tolist(), lengths.tolist())]
    new = np.ones(len(labels), dtype=bool)
    new[1:] = (labels[1:] != labels[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(labels))
    margin = np.zeros(len(lengths))
    if len(first):
        each = np.add.reduceat(scores, first, axis=0, dtype=np.float64)
        own = each[np.arange(len(first)), labels[first]]
        each[np.arange(len(first)), labels[first]] = -np.inf
        margin = np.bincount(rows[first], weights=own - each.max(axis=1), minlength=len(lengths)) / np.maximum(lengths, 1)
    span = pa.StructArray.from_arrays(
        [
            pa.array(place[first], pa.int64()),
            pa.array(place[ends - 1] - place[first] + 1 if len(first) else [], pa.int64()),
            pa.DictionaryArray.from_arrays(pa.array(labels[first], pa.int32()), pa.array(model.langs, pa.string())).cast(pa.string()),
        ],
        names=["first", "words", "lang"],
    )
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows[first], minlength=len(lengths)))]).astype(np.int32)
    return langs, share, pa.ListArray.from_arrays(pa.array(offsets), span), margin


def labelled(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (all) as struct `row`, `lang_pred`, `score` (its share of the letters), `spans`, `margin` of every row.

    A null text or one without a letter, or any if nothing was learned, is `und` with score 0 and no spans.
    Repeated rows stay repeated.
    """
    bound = df.sparkSession.sparkContext.broadcast(model)  # CELLS by languages: a fixed size
    span = pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bound.value
        for block in blocks(batches, 1, WORD_BLOCK_BYTES):
            if own.langs:
                langs, share, spans, margin = _labelled(own, block.column(1))
            else:
                langs, share, spans, margin = [UNKNOWN] * len(block), np.zeros(len(block)), pa.array([[]] * len(block), pa.list_(span)), np.zeros(len(block))
            columns = [block.column(0), pa.array(langs), pa.array(share), spans, pa.array(margin)]
            yield pa.record_batch(columns, names=["row", "lang_pred", "score", "spans", "margin"])

    chosen = df.select(F.struct(*[df[c] for c in keep or df.columns]).alias("row"), df[text].cast("string").alias("text"))
    kind = chosen.schema["row"].dataType.simpleString()
    schema = f"row {kind}, lang_pred string, score double, spans array<struct<first:bigint,words:bigint,lang:string>>, margin double"
    return chosen.mapInArrow(run, schema)


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, n_spans. A null id is not held out."""
    found = labelled(docs, fit(docs), keep=["doc_id"])
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return found.select("row.doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def spoken(docs: DataFrame, least: float = MARGIN) -> DataFrame:
    """The documents whose languages, one or several, are told with that mean margin, with all columns, `lang` the one of
    most letters."""
    found = labelled(docs, fit(docs)).filter((F.col("lang_pred") != UNKNOWN) & (F.col("margin") >= least))
    columns = [F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return found.select(*columns)
