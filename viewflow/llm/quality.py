"""Quality rules: counts of a text, and a log-likelihood ratio of hashed n-grams between trusted and raw corpus.

Words and word pairs are hashed to buckets. One pass counts the buckets over all documents (the raw corpus) and
over those labelled good (the trusted target); the smoothed logarithm of the ratio of both multinomials is one
number per bucket, a model of fixed size. A document's score is the mean over its n-grams. The scores of all labelled
documents set the threshold, and every document is then held against it. All of it is column expressions: no Python
on the executors. Texts meet their labels in one shuffle by id; nothing that grows with the labels is broadcast.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewflow.llm.common import stored

#: Buckets of words, and of pairs; least share of good documents to keep; parts of a unit of the score, to sort within.
BUCKETS, KEEP, BINS = 4096, 0.995, 10_000
#: Least words, words of a window, and highest percentage of words in repeated windows.
MIN_WORDS, WINDOW, MAX_REPEATED = 10, 5, 20
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")


def _window(words: Column, at: Column, combine) -> Column:
    return combine(*[F.get(words, at + i) for i in range(WINDOW)])


def _indexes(size: Column, first: int = 0) -> Column:
    """0 (or `first`) up to the size, without it."""
    return F.when(size > first, F.sequence(F.lit(first), size - 1)).otherwise(F.array().cast("array<int>"))


def _repeated(words: Column, n: Column) -> Column:
    """Words in windows that stand in the text twice or more; only a text with equal hashes is looked at closely."""
    hashes = F.transform(_indexes(n - WINDOW + 1), lambda i: _window(words, i, F.xxhash64))
    found = F.transform(
        _indexes(n - WINDOW + 1), lambda i: F.struct(_window(words, i, lambda *w: F.concat_ws(" ", *w)).alias("w"), i.alias("i"))
    )

    def doubled(ordered: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(ordered, i)["w"] == F.get(ordered, j)["w"], F.lit(False))

        places = F.filter(_indexes(F.size(ordered)), lambda j: same(j, j - 1) | same(j, j + 1))
        return F.sort_array(F.transform(places, lambda j: F.get(ordered, j)["i"]))

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), _covers)
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    closely = bound(F.sort_array(found), lambda ordered: bound(doubled(ordered), covered))
    has = bound(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(has, closely).otherwise(F.lit(0).cast("long"))


def _covers(place: Column, following: Column) -> Column:
    """Words that a window covers up to the next one; the last one covers all of its own."""
    return F.when(following.isNull(), F.lit(WINDOW)).otherwise(F.least(following - place, F.lit(WINDOW))).cast("long")


def bound(value: Column, use) -> Column:
    """An expression that uses a value several times and has it computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def base_columns(text: Column, words: Column, n: Column) -> dict[str, Column]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text, given its words."""
    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(filled, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.octet_length(filled) - F.octet_length(F.regexp_replace(filled, _SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeated(words, n),
    }


def _buckets(words: Column, n: Column) -> Column:
    """The buckets of all words and pairs of neighbours."""
    ones = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    twos = F.transform(
        _indexes(n, 1), lambda i: (F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(BUCKETS)) + BUCKETS).cast("int")
    )
    return F.concat(ones, twos)


def _labelled(labels: DataFrame) -> DataFrame:
    """Every labelled id once; `good` is 1 or 0, an id with both labels counts as good."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("good"))


def fit(docs: DataFrame, labels: DataFrame) -> list[float]:
    """The ratio of each bucket, from all documents and all good ones; without a good one all are 0."""
    # Each task hashes its part of the ids: no broadcast that grows, and no texts to sort.
    marked = docs.select("doc_id", "text").join(_labelled(labels).hint("shuffle_hash"), "doc_id", "left")
    buckets = bound(words_of(F.col("text")), lambda words: _buckets(words, F.size(words)))
    grams = marked.select("good", F.explode(buckets).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("target"))
    raw, target = [0] * (2 * BUCKETS), [0] * (2 * BUCKETS)
    for row in counts.collect():  # the model: 2 * BUCKETS rows at most
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not sum(target):
        return [0.0] * (2 * BUCKETS)
    of_raw, of_target = sum(raw) + 2 * BUCKETS, sum(target) + 2 * BUCKETS
    return [round(log((t + 1) / of_target) - log((r + 1) / of_raw), 6) for t, r in zip(target, raw)]


def threshold(found: DataFrame) -> float:
    """Where the `score` of good and bad documents (`good` 1 or 0) tells them apart best, but not above what keeps the
    share `KEEP` of the good ones. Without good and bad ones nothing falls below it.

    Scores are sorted within bins, after the totals of the bins before: a mean of logarithms has few bins at any size.
    """
    of_score = found.groupBy("score").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    of_score = stored(of_score.withColumn("bin", F.floor(F.col("score") * BINS)))
    n_good, n_bad = of_score.agg(F.sum("good"), F.sum("bad")).first()
    if not n_good or not n_bad:
        return float("-inf")

    def before(name: str, window: Window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    bins = of_score.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    starts = bins.select("bin", *[before(name, Window.orderBy("bin")).alias(f"{name}_first") for name in ("good", "bad")])
    inside = Window.partitionBy("bin").orderBy("score")
    below = [(F.col(f"{name}_first") + before(name, inside)).alias(f"{name}_below") for name in ("good", "bad")]
    placed = of_score.join(F.broadcast(starts), "bin").select("score", "good", *below)
    candidates = placed.filter((F.col("good") > 0) & (F.col("good_below") <= int(n_good * (1 - KEEP))))
    best = candidates.orderBy((F.col("bad_below") / n_bad - F.col("good_below") / n_good).desc(), "score").first().score
    # Halfway to the next bad one: both sides get the same room.
    next_bad = of_score.filter((F.col("bad") > 0) & (F.col("score") < best)).agg(F.max("score")).first()[0]
    return best if next_bad is None else (best + next_bad) / 2


def score(words: Column, n: Column, values: list[float]) -> Column:
    """The mean ratio of a text's n-grams, 0 without any."""
    ratios = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")
    total = F.aggregate(_buckets(words, n), F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    return F.when(n > 0, total / (2 * n - 1)).otherwise(0.0)


def _measured(docs: DataFrame, values: list[float]) -> DataFrame:
    """All columns of every row as struct `row`, and its counts, `base_failed` and `score`.

    A null or empty text has no words and fails the rules; repeated rows are measured each.
    """
    text = F.col("row.text")

    # One expression, in which the words are a variable: the optimiser can't put their splitting into a loop.
    def judged(words: Column) -> Column:
        n = F.size(words)
        rules = F.struct(
            n.cast("long").alias("n_words"),
            *[c.alias(name) for name, c in base_columns(text, words, n).items()],
            score(words, n, values).alias("score"),
        )
        return bound(rules, verdict)

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEATED)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
        return F.struct(*[m[name].alias(name) for name in names], failed.alias("base_failed"))

    wrapped = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return wrapped.select("row", bound(words_of(text), judged).alias("rated")).select("row", "rated.*")


def rated(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of every row as struct `row`, its counts, `base_failed`, `score` and `kept`.

    Stored once: the threshold needs the scores of all labelled documents first. A text that isn't asked for isn't stored.
    """
    measured = _measured(docs, fit(docs, labels))
    row = F.struct(*[F.col("row")[c].alias(c) for c in columns]).alias("row")
    doc_id = F.col("row.doc_id").alias("doc_id")
    measured = stored(measured.select(doc_id, row, *measured.columns[1:]))
    scored = measured.filter(F.col("n_words") >= MIN_WORDS).select("doc_id", "score")
    least = threshold(scored.join(_labelled(labels), "doc_id"))
    return measured.drop("doc_id").withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, the four counts, base_failed, kept, score."""
    out = rated(docs.select("doc_id", "text"), labels, ["doc_id"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return out.select("row.doc_id", *names)


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return rated(docs, labels, docs.columns).filter("kept").select("row.*")
