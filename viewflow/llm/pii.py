"""Personal data: base patterns that always count, and wider candidates chosen by gradient-boosted trees.

High-recall generators propose spans that may overlap each other. A candidate's format and context become a short
vector of small whole numbers. For each kind shallow trees are boosted on labelled spans, a fixed set whose labels do not
follow from the base patterns. Each kind's threshold is set on labelled spans kept apart, for the wanted precision,
and a candidate above it that touches no base span is added. The trees become nested conditions: finding, scoring
and redacting are column expressions without any Python on the executors.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewflow.llm.labelled_spans import labelled
from viewflow.llm.quality import bound

KINDS = ("email", "ip", "card", "phone")
#: Trees of a kind, their depth, the step, and the least precision on labelled spans kept apart, one of `APART`.
TREES, DEPTH, RATE, PRECISION, APART = 20, 3, 0.3, 0.98, 5
#: Characters before a candidate that are its context.
CONTEXT = 24

# Possessive repeats and starts at a run's first character find what the plain patterns find, leftmost first, in
# linear time and constant depth. \G is the end of the match before.
_PART = r"(?:\G|(?<![0-9]))[0-9]++"
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _PART + r"\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has none of the base pattern that could be valid.
_HINT = {
    "email": r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
}
#: The generators.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?(?:@|[(\[] ?at ?[)\]]) ?[a-z0-9-]++(?:(?:\.| \. | ?[(\[] ?dot ?[)\]] ?)[a-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"
    r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20. -]{0,3}[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\([0-9]{1,4}\)|(?:\+|00)?[0-9]{1,4})[\x20.()-]{1,2}[0-9]{2,4}\)?[\x20.-]{1,2}[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){0,2}(?![0-9A-Za-z])",
}
_WIDE_HINT = {"email": r"@|(?i)[(\[] ?at ?[)\]]", "ip": r"[0-9] ?\. ?[0-9]|[0-9A-Fa-f]::?[0-9A-Fa-f]", "card": r"[0-9]{2}", "phone": r"[0-9]{2}"}
#: Words before a span that name its kind.
_CUES = {"email": "mail|contact|write", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit|payment", "phone": "phone|tel|call|mobile|fax"}
#: Words before a span that name something else.
_ELSE = r"order|invoice|version|serial|item|isbn|total|date\b|\bref|\bpage|section|chapter|\bpart\b|\bcode"
#: Forms of a span.
_FORMS = (
    r"(?i)[(\[] ?at ?[)\]]",
    r"(?i)[(\[] ?dot ?[)\]]",
    r"(?i)\.(?:com|org|net|edu|gov|mil|info|biz|io|eu|de|fr|es|it|uk|us|ca|ch|at|nl|be|pl|se|no|dk|fi|pt|ru|cn|jp|in|br|au|test|example|invalid)$",
    r"[0-9]$",
    ":",
    r"^[0-9A-Fa-f]{4}:",
    r"^\(",
    r"^00",
    r"^0",
    r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$",
    r"^(?:[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4})$",
    r"^(?:19|20)[0-9]{2}[^0-9][0-9]{1,2}[^0-9][0-9]{1,2}$|^[0-9]{1,2}[^0-9][0-9]{1,2}[^0-9](?:19|20)[0-9]{2}$",
)
_SPANS = "array<struct<start:int,stop:int,hit:string,before:string,after:string>>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass Luhn's check: every second from the right counts as its double's digit sum."""
    padded = F.lpad(digits, 19, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = sum((F.substring(padded if i % 2 else doubled, i, 1).cast("int") for i in range(1, 20)), F.lit(0))
    return total % 10 == 0


def _octets(hit: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        return _octets(hit)
    if kind == "card":
        return n.between(16, 19) & _luhn(_digits(hit))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _found(text: Column, pattern: str, hint: str, valid) -> Column:
    """The valid matches with their places in code points and what stands around them."""

    def listed(gaps: Column, hits: Column) -> Column:
        numbers = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(F.array().cast("array<int>"))
        around = F.transform(
            numbers,
            lambda i: F.struct(
                F.length(F.get(gaps, i)).alias("gap"),
                F.get(hits, i).alias("hit"),
                F.lower(F.right(F.get(gaps, i), F.lit(CONTEXT))).alias("before"),
                F.substring(F.get(gaps, i + 1), 1, 1).alias("after"),
            ),
        )

        def step(seen: Column, x: Column) -> Column:
            start, stop = seen["at"] + x["gap"], seen["at"] + x["gap"] + F.length(x["hit"])
            span = F.struct(start.alias("start"), stop.alias("stop"), x["hit"].alias("hit"), x["before"].alias("before"), x["after"].alias("after"))
            spans = F.when(valid(x["hit"]), F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
            return F.struct(stop.alias("at"), spans.alias("spans"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
        return F.aggregate(around, zero, step, lambda seen: seen["spans"])

    spans = bound(F.split(text, pattern, -1), lambda gaps: bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: listed(gaps, hits)))
    return F.when(text.rlike(hint), spans).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column, kind: str) -> Column:
    return _found(text, BASE[kind], _HINT[kind], lambda hit: _valid(kind, hit))


def candidates(text: Column, kind: str) -> Column:
    return _found(text, WIDE[kind], _WIDE_HINT[kind], lambda hit: F.lit(True))


def _features(kind: str, span: Column) -> Column:
    """Small whole numbers only: the number of distinct vectors is bounded whatever the corpus."""
    hit = span["hit"]
    digits = _digits(hit)
    n = F.length(digits)
    flags = [
        F.when(n.between(13, 19), _luhn(digits)).otherwise(False),
        _octets(F.regexp_replace(hit, " ", "")),
        hit.startswith("+"),
        hit.contains("@"),
        span["before"].rlike(r"[\p{L}\p{N}]$"),
        span["after"].rlike(r"[\p{L}\p{N}]"),
        *(span["before"].rlike(cue) for cue in (*_CUES.values(), _ELSE)),
        *(hit.rlike(form) for form in _FORMS),
    ]
    marks = F.least(F.length(F.regexp_replace(hit, r"[\p{L}\p{N}]", "")), F.lit(6))
    runs = F.least(F.size(F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0))), F.lit(8))
    return F.array(F.lit(KINDS.index(kind)), F.least(n, F.lit(20)), marks, runs, *[F.coalesce(f, F.lit(False)).cast("int") for f in flags])


def _with_spans(df: DataFrame, text: str) -> DataFrame:
    filled = F.coalesce(F.col(text), F.lit(""))
    return df.select("*", *[f(filled, k).alias(f"{n}_{k}") for k in KINDS for n, f in (("base", base_spans), ("wide", candidates))])


def fit(spark: SparkSession) -> tuple[dict[str, list], dict[str, float]]:
    """Each kind's trees and threshold, from the labelled spans. Other candidates in their texts are none of a kind."""
    rows = [(i % APART == 0, text, kind, text.index(span), counts, len(span)) for i, (text, kind, span, counts) in enumerate(labelled())]
    texts = spark.createDataFrame(rows, "apart boolean, text string, kind string, start int, counts boolean, size int").coalesce(1)

    def told(kind: str) -> Column:
        own = F.col("counts") & (F.col("kind") == kind)
        label = lambda s: own & (s["start"] == F.col("start")) & (s["stop"] == F.col("start") + F.col("size"))
        return F.transform(candidates(F.col("text"), kind), lambda s: F.struct(_features(kind, s).alias("x"), label(s).alias("y")))

    seen = texts.select("apart", F.explode(F.concat(*map(told, KINDS))).alias("c"))
    counted = seen.groupBy("c.x", "c.y", "apart").agg(F.count("*").alias("n"))
    rows = sorted((tuple(r.x), int(r.y), r.apart, r.n) for r in counted.collect())  # of the fixed set
    trees = {kind: _boost([(x, y, n) for x, y, held, n in rows if not held and x[0] == k]) for k, kind in enumerate(KINDS)}
    return trees, _thresholds(trees, [(x, y, n) for x, y, held, n in rows if held])


def _boost(rows: list[tuple[tuple[int, ...], int, int]]) -> list:
    """Trees on weighted rows: nested (feature, most, left, right), a leaf being a number."""
    scores, trees = [0.0] * len(rows), []
    if len({y for _, y, _ in rows}) < 2:
        return trees
    for _ in range(TREES):
        slopes = [(y - 1 / (1 + exp(-s))) * n for (_, y, n), s in zip(rows, scores)]
        curves = [n / (1 + exp(-s)) / (1 + exp(s)) for (_, _, n), s in zip(rows, scores)]
        tree = _grow(rows, slopes, curves, list(range(len(rows))), DEPTH)
        trees.append(tree)
        scores = [s + _leaf(tree, x) for (x, _, _), s in zip(rows, scores)]
    return trees


def _grow(rows, slopes, curves, own: list[int], depth: int):
    def gain(slope: float, curve: float) -> float:
        return slope * slope / (curve + 1)

    slope, curve = sum(slopes[i] for i in own), sum(curves[i] for i in own)
    best = (1e-6, None, None)
    for feature in range(len(rows[0][0]) if depth else 0):
        sums: dict[int, list[float]] = {}
        for i in own:
            at = sums.setdefault(rows[i][0][feature], [0.0, 0.0])
            at[0] += slopes[i]
            at[1] += curves[i]
        left = [0.0, 0.0]
        for value in sorted(sums)[:-1]:
            left[0] += sums[value][0]
            left[1] += sums[value][1]
            won = gain(*left) + gain(slope - left[0], curve - left[1]) - gain(slope, curve)
            if won > best[0]:
                best = (won, feature, value)
    _, feature, value = best
    if feature is None:
        return round(RATE * slope / (curve + 1), 6)
    parts = [i for i in own if rows[i][0][feature] <= value], [i for i in own if rows[i][0][feature] > value]
    return (feature, value, *(_grow(rows, slopes, curves, part, depth - 1) for part in parts))


def _leaf(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def _thresholds(trees: dict[str, list], held: list[tuple[tuple[int, ...], int, int]]) -> dict[str, float]:
    """The lowest score, of those that speak for the kind, from which on candidates kept apart are right often enough."""
    out = {}
    for number, kind in enumerate(KINDS):
        scored = sorted(((sum(_leaf(t, x) for t in trees[kind]), y, n) for x, y, n in held if x[0] == number), reverse=True)
        all_, right, least = 0, 0, float("inf")
        for i, (s, y, n) in enumerate(scored):
            all_, right = all_ + n, right + n * y
            last = i + 1 == len(scored) or scored[i + 1][0] < s
            if last and s > 0 and right >= PRECISION * all_:
                least = s
        out[kind] = round(least - 1e-6, 6) if least < float("inf") else least
    return out


def _tree_column(tree, x: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, most, left, right = tree
    return F.when(F.get(x, F.lit(feature)) <= most, _tree_column(left, x)).otherwise(_tree_column(right, x))


def detected(df: DataFrame, model: tuple[dict[str, list], dict[str, float]], text: str = "text") -> DataFrame:
    """All columns, `base_<kind>` and `all_<kind>`: spans (start, stop), the latter with those that the trees add."""
    trees, least = model
    found = _with_spans(df, text)
    base = F.concat(*[F.col(f"base_{kind}") for kind in KINDS])

    def chosen(kind: str) -> Column:
        if not trees[kind] or least[kind] == float("inf"):
            return F.col(f"base_{kind}")

        def picked(s: Column, base: Column) -> Column:
            free = ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
            total = bound(_features(kind, s), lambda x: sum((_tree_column(t, x) for t in trees[kind]), F.lit(0.0)))
            return free & (total >= least[kind])

        added = bound(base, lambda own: F.filter(f"wide_{kind}", lambda s: picked(s, own)))
        return F.sort_array(F.concat(F.col(f"base_{kind}"), added))

    return found.select(*[found[c] for c in df.columns], *[f"base_{k}" for k in KINDS], *[chosen(k).alias(f"all_{k}") for k in KINDS])


def _listed(prefix: str) -> Column:
    def named(kind: str) -> Column:
        return F.transform(f"{prefix}_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")))

    return F.array_join(F.concat(*map(named, KINDS)), ",")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, the number of base spans of each kind, `base_sha256` and `spans` of every row.

    A null or empty text has no spans (the digest of nothing, an empty list); repeated rows stay repeated.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = detected(rows, fit(docs.sparkSession))
    counts = [F.size(f"base_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return out.select(F.col("key").alias(key), *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("all").alias("spans"))


def _redacted(text: Column) -> Column:
    def placed(kind: str) -> Column:
        by = F.lit(f"[{kind.upper()}]").alias("by")
        return F.transform(f"all_{kind}", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), by))

    def step(seen: Column, s: Column) -> Column:
        new = F.array(F.substring(text, seen["at"] + 1, s["start"] - seen["at"]), s["by"])
        parts = F.when(s["start"] >= seen["at"], F.concat(seen["parts"], new)).otherwise(seen["parts"])
        return F.struct(F.greatest(seen["at"], s["stop"]).alias("at"), parts.alias("parts"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(
        F.sort_array(F.concat(*map(placed, KINDS))),
        zero,
        step,
        lambda seen: F.concat(F.array_join(seen["parts"], ""), F.substring(text, seen["at"] + 1, F.length(text))),
    )


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of every row, each span of the text replaced by its kind's name, and `n_chars`, if there, by the
    new length."""
    wrapped = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    out = detected(wrapped, fit(docs.sparkSession)).withColumn("new", F.when(F.col("text").isNotNull(), _redacted(F.col("text"))))
    new = {text: F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("new").isNotNull(), F.length("new")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
