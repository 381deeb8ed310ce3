"""Documents scored by masked pseudo-likelihood: every token predicted from both sides.

Every word has a code of three digits below `BASE`, from its hash: 64,000 codes, so that two of the frequent words seldom
share one. Its embedding, as context, is the sum of two rows of tables: of its first two digits, and of the first and the
third. As a target it is found digit by digit: the first one's distribution follows from the hidden state, those of the
other two from the state and the first digit, with weights of their own for each first digit. A window network with one
hidden layer adds up the embeddings left and right of the masked word, each scaled by its place. So the network tells all
words apart by code, on both sides, and its weights (0.4 MB) can be broadcast at any size of the corpus.

The network is trained in numpy in each partition, on every token of all its documents; the weights of all partitions are
averaged by the number of their tokens, and a further round would go on from there.

Words of one code are told apart by their shares of it: all words of the corpus are counted, and a word's probability is
its code's times its share of the code's count. The shares are a stored table that grows with the corpus and is joined;
those of the most frequent words go along with the weights. The summed conditional log-probabilities of all its words
score a document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewflow.llm.common import WORD_BLOCK_BYTES, blocks, stored, sums

#: Values of a digit, words seen on each side, hidden units.
BASE, SIDE, HIDDEN = 40, 2, 16
#: Codes, and a code that no word has: beyond a text's ends.
CODES = BASE**3
#: What a code keeps for words that the corpus doesn't have.
UNSEEN = 0.01
#: Words whose shares go along with the weights; all others are joined.
FREQUENT = 16_384
#: Tokens of a step, from the first to the largest; rounds of averaging; step size, which falls with the square root of steps.
FIRST_BATCH, BATCH, ROUNDS, RATE = 1024, 8192, 1, 0.02
#: Tokens scored at a time; units of a weight when weights are summed as whole numbers, in any order.
CHUNK, UNITS = 4096, 1_000_000
_PLACES = [p for p in range(-SIDE, SIDE + 1) if p]
_ONES = np.ones(BASE, dtype=np.float32)
#: Shapes of the weights, one after another in a vector.
_SHAPES = {
    "left": (BASE * BASE, HIDDEN),
    "right": (BASE * BASE, HIDDEN),
    "scale": (len(_PLACES), HIDDEN),
    "hidden": (HIDDEN,),
    "first": (HIDDEN, BASE),
    "first_bias": (BASE,),
    "rest": (BASE, HIDDEN, 2 * BASE),
    "rest_bias": (BASE, 2 * BASE),
}


def _digits(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return codes // (BASE * BASE), codes // BASE % BASE, codes % BASE


def _order(codes: np.ndarray) -> np.ndarray:
    """By the first digit."""
    return np.argsort((codes // (BASE * BASE)).astype(np.int16), kind="stable")


class Network:
    """The window network; all weights in one vector."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        at = 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def new(cls, second: np.ndarray, third: np.ndarray) -> Network:
        """Without any context: the counts of the second and the third digit by the first."""
        rng = np.random.default_rng(0)
        size = sum(int(np.prod(shape)) for shape in _SHAPES.values())
        net = cls((rng.standard_normal(size) * 0.1).astype(np.float32))
        net.hidden[:], net.scale[:] = 0, 1
        for bias, counts in ((net.first_bias, second.sum(axis=1)), (net.rest_bias[:, :BASE], second), (net.rest_bias[:, BASE:], third)):
            bias[:] = np.log((counts + 1) / (counts + 1).sum(axis=-1, keepdims=True))
        return net

    def state(self, stream: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of a stream of codes, and at some places of it, `SIDE` from its ends at least, the hidden states.

        A state's last number is 1, for the bias.
        """
        one, two, three = _digits(np.minimum(stream, CODES - 1))
        embedded = self.left[one * BASE + two] + self.right[one * BASE + three]
        embedded[stream == CODES] = 0
        end = len(stream) - SIDE
        around = sum(self.scale[i] * embedded[SIDE + p : end + p] for i, p in enumerate(_PLACES))
        state = np.ones((len(at), HIDDEN + 1), dtype=np.float32)
        np.tanh(around[at - SIDE] + self.hidden, out=state[:, :-1])
        return embedded, state

    def _outputs(self) -> np.ndarray:
        """For each first digit the weights of all three digits' values, and in a last row their bias."""
        out = np.empty((BASE, HIDDEN + 1, 3 * BASE), dtype=np.float32)
        out[:, :-1, :BASE], out[:, :-1, BASE:] = self.first, self.rest
        out[:, -1, :BASE], out[:, -1, BASE:] = self.first_bias, self.rest_bias
        return out

    @staticmethod
    def _groups(one: np.ndarray) -> list[tuple[int, int, int]]:
        """Runs of the sorted first digits: the digit, start and end."""
        ends = np.cumsum(np.bincount(one, minlength=BASE)).tolist()
        return [(d, low, high) for d, (low, high) in enumerate(zip([0, *ends], ends)) if high > low]

    def _logits(self, state: np.ndarray, groups: list, weights: np.ndarray) -> np.ndarray:
        """A row for each of the three digits of each word, words in order of their first digits."""
        out = np.empty((len(state), 3 * BASE), dtype=np.float32)
        for digit, low, high in groups:
            np.matmul(state[low:high], weights[digit], out=out[low:high])
        out = out.reshape(-1, BASE)
        # Far from where an exponential would be too large; trained weights don't come near it.
        return np.minimum(out, np.float32(80), out=out)

    def gradient(self, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Slopes of the mean loss of the tokens at these places."""
        at = at[_order(stream[at])]
        embedded, state = self.state(stream, at)
        digits = np.stack(_digits(stream[at]), axis=1)
        groups = self._groups(digits[:, 0])
        weights = self._outputs()
        out = Network(np.zeros_like(self.flat))
        part = np.float32(1 / len(at))
        error = self._logits(state, groups, weights)
        np.exp(error, out=error)
        error *= part / (error @ _ONES)[:, None]
        error[np.arange(len(error)), digits.ravel()] -= part
        error = error.reshape(len(at), 3 * BASE)
        below = np.empty_like(state)
        slope = np.zeros_like(weights)
        for digit, low, high in groups:
            own = error[low:high]
            np.matmul(state[low:high].T, own, out=slope[digit])
            np.matmul(own, weights[digit].T, out=below[low:high])
        out.first[:], out.first_bias[:] = slope[:, :-1, :BASE].sum(axis=0), slope[:, -1, :BASE].sum(axis=0)
        out.rest[:], out.rest_bias[:] = slope[:, :-1, BASE:], slope[:, -1, BASE:]
        state, below = state[:, :-1], below[:, :-1] * (1 - state[:, :-1] * state[:, :-1])
        out.hidden[:] = below.sum(axis=0)
        slopes = np.zeros_like(embedded)
        end = len(stream) - SIDE
        placed = np.zeros((end - SIDE, HIDDEN), dtype=np.float32)
        placed[at - SIDE] = below
        for i, p in enumerate(_PLACES):
            out.scale[i] = np.einsum("ij,ij->j", embedded[SIDE + p : end + p], placed)
            slopes[SIDE + p : end + p] += self.scale[i] * placed
        slopes[stream == CODES] = 0
        one, two, three = _digits(np.minimum(stream, CODES - 1))
        for table, row in ((out.left, one * BASE + two), (out.right, one * BASE + three)):
            cells = (row[:, None] * HIDDEN + np.arange(HIDDEN)).ravel()
            table[:] = np.bincount(cells, weights=slopes.ravel(), minlength=table.size).reshape(table.shape)
        return out.flat

    def log_probabilities(self, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the codes at these places of the stream, each from both sides."""
        out = np.empty(len(at))
        weights = self._outputs()
        for start in range(0, len(at), CHUNK):
            own = at[start : start + CHUNK]
            low = own[0] - SIDE
            piece = stream[low : own[-1] + SIDE + 1]
            order = _order(stream[own])
            own = own[order]
            _, state = self.state(piece, own - low)
            digits = np.stack(_digits(stream[own]), axis=1)
            logits = self._logits(state, self._groups(digits[:, 0]), weights)
            chosen = logits[np.arange(len(logits)), digits.ravel()]
            chosen -= np.log(np.exp(logits, out=logits) @ _ONES)
            out[start + order] = chosen.reshape(-1, 3).sum(axis=1)
        return out


def _words(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of the texts in lower case, one text after another, and how many each has."""
    listed = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(column, "")))
    flat = listed.flatten()
    lengths = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
    there = pc.not_equal(flat, "")
    words = flat.filter(there).dictionary_encode()
    return words, sums(there.to_numpy(zero_copy_only=False).astype(np.int64), lengths)


def _codes(words: pa.StringArray) -> np.ndarray:
    """Codes of words: a polynomial of their bytes modulo 2^64, mixed once more."""
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    lengths = np.diff(offsets)
    starts = offsets[:-1] - offsets[0]
    powers = np.multiply.accumulate(np.full(int(lengths.max()), 0x100000001B3, dtype=np.uint64))
    data = (data + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(starts, lengths)]
    mixed = np.add.reduceat(data, starts)
    mixed ^= mixed >> np.uint64(33)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    return (mixed % np.uint64(CODES)).astype(np.int64)


def _stream(words: pa.DictionaryArray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a block's words with gaps before, between and after its texts, and the words' places in it."""
    codes = _codes(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
    stream = np.full(len(codes) + SIDE * (len(lengths) + 1), CODES, dtype=np.int64)
    at = np.arange(len(codes)) + np.repeat(SIDE * np.arange(1, len(lengths) + 1), lengths)
    stream[at] = codes
    return stream, at


@dataclass
class Model:
    weights: np.ndarray
    #: `word` and `share`, the logarithm of its share of its code: a stored table of all words.
    words: DataFrame
    #: The same of the most frequent words.
    frequent: dict[str, float]


def _counted(texts: DataFrame) -> DataFrame:
    """Each word of all texts with its code and its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 0, WORD_BLOCK_BYTES):
            words, _ = _words(block.column(0))
            times = np.bincount(words.indices.to_numpy(zero_copy_only=False), minlength=len(words.dictionary))
            columns = [words.dictionary, pa.array(_codes(words.dictionary), pa.int32()), pa.array(times, pa.int64())]
            yield pa.record_batch(columns, names=["word", "code", "n"])

    return stored(texts.mapInArrow(run, "word string, code int, n long").groupBy("word", "code").agg(F.sum("n").alias("n")))


def _digit_counts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often each second and third digit comes with each first one: two tables of a fixed size."""
    one, out = F.floor(F.col("code") / (BASE * BASE)), []
    for digit in (F.floor(F.col("code") / BASE) % BASE, F.col("code") % BASE):
        found = np.zeros((BASE, BASE))
        for row in counts.groupBy(one.alias("one"), digit.alias("digit")).agg(F.sum("n").alias("n")).collect():
            found[row["one"], row["digit"]] = row["n"]
        out.append(found)
    return out[0], out[1]


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> Model:
    """Counts the words and trains the network on all documents. Without a word the weights stay as they began.

    Null, empty and blank texts have no words; repeated rows count each time.
    """
    texts = docs.select(docs[text].cast("string").alias("text"))
    every = _counted(texts)
    net = Network.new(*_digit_counts(every))
    size = F.sum("n").over(Window.partitionBy("code"))
    words = stored(every.select("word", "n", F.log(F.col("n") / size * (1 - UNSEEN)).alias("share")))
    top = words.orderBy(F.col("n").desc(), "word").limit(FREQUENT).collect()  # a fixed number
    for _ in range(rounds if top else 0):
        net = Network(_round(texts, net.flat))
    return Model(net.flat, words, {row["word"]: row["share"] for row in top})


def _round(texts: DataFrame, start: np.ndarray) -> np.ndarray:
    """The mean of the weights that the partitions arrive at."""
    bound = texts.sparkSession.sparkContext.broadcast(start)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(bound.value.copy())
        mean, square, steps, seen = np.zeros_like(net.flat), np.zeros_like(net.flat), 0, 0
        for block in blocks(batches, 0, WORD_BLOCK_BYTES):
            stream, places = _stream(*_words(block.column(0)))
            first = 0
            while first < len(places):
                at = places[first : first + min(BATCH, FIRST_BATCH + 256 * steps)]
                first += len(at)
                low = at[0] - SIDE
                slope = net.gradient(stream[low : at[-1] + SIDE + 1], at - low)
                steps, seen = steps + 1, seen + len(at)
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                size = RATE * np.sqrt(1 - 0.99**steps) / (1 - 0.9**steps) / np.sqrt(1 + steps / 100)
                net.flat -= (size * mean / (np.sqrt(square) + 1e-6)).astype(np.float32)
        if seen:
            units = np.rint(net.flat.astype(np.float64) * UNITS).astype(np.int64) * seen
            columns = [pa.array(np.arange(len(units)), pa.int32()), pa.array(units), pa.array(np.full(len(units), seen))]
            yield pa.record_batch(columns, names=["place", "units", "seen"])

    trained = texts.mapInArrow(run, "place int, units long, seen long")
    mean = trained.groupBy("place").agg((F.sum(F.col("units").cast("decimal(38,0)")) / F.sum("seen")).cast("double").alias("w"))
    found = mean.toArrow()  # a row for each weight
    weights = start.copy()
    weights[found["place"].to_numpy()] = found["w"].to_numpy() / UNITS
    return weights


def pseudo_likelihood(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_tokens`, `log_prob` (the sum) and `mean_log_prob` of every row.

    A null, empty or blank text has no tokens and 0 for both; repeated rows stay repeated. A word that the model's corpus
    doesn't have takes what its code keeps for such.
    """
    bound = docs.sparkSession.sparkContext.broadcast((model.frequent, model.weights))  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, net = bound.value[0], Network(bound.value[1])
        known_words, known_shares = pa.array(list(frequent), pa.string()), np.array([*frequent.values(), 0.0])
        for block in blocks(batches, 1, WORD_BLOCK_BYTES):
            words, lengths = _words(block.column(1))
            token = words.indices.to_numpy(zero_copy_only=False)
            logs = net.log_probabilities(*_stream(words, lengths))
            place = pc.fill_null(pc.index_in(words.dictionary, value_set=known_words), -1).to_numpy(zero_copy_only=False)
            total = sums(logs + known_shares[place][token], lengths)
            other = place[token] < 0
            coded = words.dictionary.take(pa.array(token[other])).dictionary_encode()
            numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
            # A word's number in the block is its place by first sight: each text brings the numbers that are new in it.
            ends = np.concatenate([[0], np.cumsum(sums(other.astype(np.int64), lengths))])
            known = np.concatenate([[0], np.maximum.accumulate(numbers) + 1])[ends].astype(np.int32)
            own = pa.Array.from_buffers(pa.binary(), len(block), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(numbers)])
            columns = [pa.array([uuid.uuid4().hex] * len(block)), block.column(0), pa.array(lengths), pa.array(total), own]
            columns += [pa.array(known[:-1]), pa.ListArray.from_arrays(pa.array(known), coded.dictionary)]
            yield pa.record_batch(columns, names=["block", "key", "n_tokens", "total", "numbers", "first", "words"])

    chosen = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"block string, key {kind}, n_tokens long, total double, numbers binary, first int, words array<string>"
    # Stored, as a block's name is new each time.
    rows = stored(chosen.mapInArrow(run, schema))
    words = rows.select(F.col("block").alias("of"), "first", F.posexplode("words").alias("at", "word"))
    words = words.select("of", (F.col("first") + F.col("at")).alias("at"), "word")
    shares = words.join(model.words.drop("n"), "word", "left").select("of", "at", F.coalesce("share", F.lit(float(np.log(UNSEEN)))).alias("share"))

    def added(left: pa.Table, right: pa.Table) -> pa.Table:
        share = np.zeros(len(right))
        share[right["at"].to_numpy()] = right["share"].to_numpy()
        numbers = left["numbers"].combine_chunks()
        lengths = pc.binary_length(numbers).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        own = np.frombuffer(b"".join(numbers.to_pylist()), dtype=np.int32)
        n_tokens = left["n_tokens"].to_numpy()
        # Rounded: far above what the size of a chunk changes.
        total = np.round(left["total"].to_numpy() + sums(share[own], lengths), 2)
        mean = np.round(total / np.maximum(n_tokens, 1), 5)
        return pa.table([left["key"], left["n_tokens"], pa.array(total), pa.array(mean)], names=["key", "n_tokens", "log_prob", "mean_log_prob"])

    # A block's texts meet the shares of its words.
    scored = rows.drop("first", "words").groupBy("block").cogroup(shares.groupBy("of"))
    out = scored.applyInArrow(added, f"key {kind}, n_tokens long, log_prob double, mean_log_prob double")
    return out.withColumnRenamed("key", key)


def scored(docs: DataFrame) -> DataFrame:
    """All documents scored by the model of all of them; null, empty and repeated texts as in `pseudo_likelihood`."""
    return pseudo_likelihood(docs, fit(docs))
