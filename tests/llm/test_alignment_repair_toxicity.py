"""Toxicity, conversation repair and tokenizer alignment, against brute force and held-out labels."""

import hashlib
import heapq
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import TEXTS, prose
from viewflow.llm import align, repair, toxicity

DATA = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
given = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Toxicity


def insulted(n):
    """Texts with and without one of three words, in a language of their own."""
    bad = ["gromplax", "vilzeek", "snarfud"]
    rows = []
    for i in range(n):
        text = prose(i % 40 + 1, 30 + i % 50)
        toxic = i % 4 == 0
        rows.append((i, f"{text} {bad[i % 3]}, {text}" if toxic else text, int(toxic)))
    return rows


def test_toxic_words_are_learned(spark):
    rows = insulted(400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumns({"score": F.lit("x"), "at": F.lit(1), "toxic": F.lit(9)})
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int").withColumn("text", F.lit("no"))
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == 400
    for i, _, toxic in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert found[i].predicted == toxic == int(found[i].score >= 0.3)


def test_held_out_labels_are_not_learned(spark):
    """Turned round on the held-out documents, they change nothing."""
    rows = insulted(200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    plain = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    turned = spark.createDataFrame([(i, 1 - t if i in held else t) for i, _, t in rows], "doc_id long, toxic int")
    assert sorted_rows(toxicity.toxicity(docs, plain)) == sorted_rows(toxicity.toxicity(docs, turned))


def test_toxicity_of_odd_rows(spark, docs, empty, labels):
    for known in (labels, labels.limit(0), labels.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))):
        out = toxicity.toxicity(docs, known).collect()
        assert Counter(r.doc_id for r in out) == Counter(i for i, _ in TEXTS)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
        texts = {i: t for i, t in TEXTS}
        assert len({r.score for r in out if not (texts[r.doc_id] or "").strip()}) == 1
    assert toxicity.toxicity(empty, labels).count() == 0


def test_ngrams_of_a_text():
    """Cells of a text are those of its words' n-grams, each once."""
    column = pa.array(["Some words, some WORDS here", None, "", "é"])
    cells, n = toxicity.features(column)
    assert n[1] == n[2] == 0 and n[3] == 0  # a mark, a letter and a mark are too short
    grams = {f"\x02{w}\x03"[i : i + k] for w in ("some", "words", "here") for k in (4, 5, 6) for i in range(len(w) + 3 - k)}
    assert n[0] == len(grams) == len(set(cells[: n[0]].tolist()))
    both, m = toxicity.features(pa.array(["some words here"]))
    assert both.tolist() == cells[: n[0]].tolist()


def test_training_sample_is_bounded(spark):
    rows = [(i, f"text {i}", i % 2) for i in range(4000)]
    docs = spark.createDataFrame([r[:2] for r in rows] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    sample, sizes = toxicity.training_texts(docs, labels, labelled=400)
    counts = Counter(r.toxic for r in sample.collect())
    assert all(200 < counts[k] <= 400 for k in (0, 1)) and sum(sizes.values()) > 2500


@given
def test_held_out_toxicity(spark):
    folder = DATA.replace("0.001", "0.1") if os.path.isdir(DATA.replace("0.001", "0.1")) else DATA
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id")
    toxic, clean = held.where("toxic = 1"), held.where("toxic = 0")
    assert toxic.where("predicted = 1").count() >= 0.75 * toxic.count()
    assert clean.where("predicted = 0").count() >= 0.98 * clean.count()


# Conversations


def brute_repair(rows):
    """A search of all edits by cost and then by the edits' initials."""
    space = " \t\n\x0b\x0c\r"
    by = {}
    for conv, turn, role, text in rows:
        own = by.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {t for t, _, _ in own if t is not None}
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(space)
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, at, state, kept = heapq.heappop(heap)
            if (at, state) in done:
                continue
            done.add((at, state))
            if at == len(own) and state in ("", "a"):
                break
            for role in ("user", "assistant"):
                if (state, role[0]) in goes:
                    heapq.heappush(heap, (cost + 2, audit + "I", at, goes[state, role[0]], (*kept, (role, ""))))
            if at < len(own):
                heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, kept))
                _, role, text = own[at]
                if faults[at] not in ("b", "d"):
                    more = cost + (faults[at] == "t")
                    if (state, role[:1]) in goes:
                        heapq.heappush(heap, (more, audit + "K", at + 1, goes[state, role[:1]], (*kept, (role, text))))
                    for other in ("user", "assistant"):
                        if (state, other[0]) in goes:
                            heapq.heappush(heap, (more + 2, audit + "R", at + 1, goes[state, other[0]], (*kept, (other, text))))
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def odd_conversations(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "useful"]
    texts = ["Hi.", "ok", "Yes! ", None, "", " \t", "what?", "é\x85", "a\nb.", "\x1c", "y" * 50]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.choice([1, 2, 5, 9, 30])):
            other = rng.choice([turn, turn, turn + rng.randint(0, 3), None]) if rng.random() < 0.2 else turn
            rows += [(conv, other, rng.choice(roles), rng.choice([*texts, f"x{rng.random()}."]))] * rng.choice([1, 1, 1, 2])
    # One conversation over many parts, one of equal rows, one that damage leaves without a row.
    rows += [(999, t, ["user", "assistant", "assistant"][t % 3], f"Turn {t % 7}.") for t in range(300)]
    rows += [(998, 1, "user", "same.")] * 200
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Gone.")]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_of_odd_conversations(spark, seed):
    rows = odd_conversations(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumns({"at": F.lit("x"), "part": F.lit(1), "digest": F.lit(2), "fault": F.lit(None).cast("int"), "cost": F.lit(1.0)})
    assert sorted_rows(repair.repaired_conversations(df)) == brute_repair(rows)
    assert repair.repaired_conversations(df.limit(0)).count() == 0
    whole = repair.repair(repair.damaged(df))
    assert whole.where("conv_id = 999").count() > 1  # it lies in several parts
    again = whole.select("conv_id", "part", F.posexplode("repaired")).select("conv_id", "part", "pos", "col.role").collect()
    forms = {}
    for r in sorted(again, key=lambda r: (repr(r.conv_id), r.part, r.pos)):
        forms[r.conv_id] = forms.get(r.conv_id, "") + r.role[:1]
    assert all(re.fullmatch("(s?(ua)+)?", form) for form in forms.values())


@given
def test_repair_of_the_table(spark):
    df = spark.read.parquet(f"{DATA}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted_rows(repair.repaired_conversations(df)) == brute_repair(rows)


def test_checkpoints_give_the_costs_of_all_vectors():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 17, 100):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.randint(0, 1)) for _ in range(n)]
        audit, end = repair.walk(rows, 0)
        cost, at = 0, 0
        for edit in audit:
            cost += {"D": 3, "I": 2, "K": 0, "R": 2}[edit] + (rows[at][2] if edit in "KR" else 0)
            at += edit != "I"
        assert at == n and cost == repair.costs(rows, repair._END)[0] and end in (0, 3)


# Alignment


def brute_links(rows):
    a, b = align.byte_level(BYTES), align.piece_level(PIECES)
    aligned = []
    for key, text in rows:
        groups, n_a, n_b = [], 0, 0
        if text:
            ids = [t.encode([text])[0] for t in (a, b)]
            pieces = [[t.pieces[i].as_py() for i in own] for t, own in zip((a, b), ids)]
            if all(b"".join(p) == b" " + text.encode() for p in pieces):
                n_a, n_b = map(len, ids)
                ends = [np.cumsum([len(x) for x in p]).tolist() for p in pieces]
                start = [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    stop = [e.index(cut) + 1 for e in ends]
                    groups.append([i[s:e] for i, s, e in zip(ids, start, stop)])
                    start = stop
        shown = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        aligned.append((key, n_a, n_b, len(groups), links, digest))
    held = Counter(pair for row in aligned for pair in row[4])
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    return sorted(
        (
            (key, n_a, n_b, n, sum(links.values()), sum(m for p, m in links.items() if held[p] == top[p[0]]), sum(m * held[p] for p, m in links.items()), digest)
            for key, n_a, n_b, n, links, digest in aligned
        ),
        key=repr,
    )


def aligned_rows(df):
    return sorted_rows(align.links(df, BYTES, PIECES).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def test_links_of_odd_texts(spark, docs, empty):
    assert aligned_rows(docs) == brute_links(TEXTS)
    assert align.links(empty, BYTES, PIECES).count() == 0
    more = [(1, "a ▁ b"), (2, "<s> <unk> <|endoftext|> ▁x"), (3, "x" * 3000), (4, " " * 500), (5, "\x00 a"), (6, "漢字かな交じり文😀😀"), (7, "<0x41>A"), (8, "ab" * 700)]
    df = spark.createDataFrame(more, "doc_id long, text string").withColumns({"pair": F.lit(1), "of": F.lit("x"), "count": F.lit(2), "block": F.lit(0)})
    assert aligned_rows(df) == brute_links(more)


@given
def test_links_of_the_table(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    assert aligned_rows(df) == brute_links([(r.doc_id, r.text) for r in df.collect()])


def test_words_are_encoded_in_runs():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    tokenizer, asked = align.byte_level(BYTES), []
    odd = ["a", "b\n", "", " c", "  ", "x\x1c", "don't", "'s", "\u0301e", "9", "12", "!", "<|endoftext|>", "漢字", "😀", "\u200b", "tab\t", "\n\nz", "q\0 r"]
    rng = random.Random(5)

    def encode(texts):
        asked.append(len(texts))
        return [found.ids for found in library.encode_batch_fast(texts, add_special_tokens=False)]

    sizes = np.array([len(piece) for piece in tokenizer.pieces.to_pylist()])
    for words in ([], [""], odd, [rng.choice(odd) for _ in range(1000)]):
        alone = [library.encode(" " + word, add_special_tokens=False).ids for word in words]
        for flat, lengths in (tokenizer.encode(words), align._in_runs(words, encode, sizes), align._in_runs(words, encode, sizes + 1)):
            assert flat.tolist() == [i for ids in alone for i in ids] and lengths.tolist() == [len(ids) for ids in alone]
    asked.clear()
    align._in_runs([f"word{i}" for i in range(320)], encode, sizes)
    assert asked == [10]


def test_products_of_rows(monkeypatch):
    """Against dense products, with expansions cut into many pieces."""
    monkeypatch.setattr(align, "EXPANDED", 7)
    rng = np.random.default_rng(6)
    for _ in range(20):
        x, y = rng.integers(0, 3, (6, 8)) * rng.integers(0, 2, (6, 8)), rng.integers(0, 3, (8, 5)) * rng.integers(0, 2, (8, 5))

        def sparse(dense):
            rows, columns = np.nonzero(dense)
            return align.Csr(np.searchsorted(rows, np.arange(len(dense) + 1)), columns, dense[rows, columns], dense.shape[1])

        def dense(csr):
            out = np.zeros((len(csr.starts) - 1, csr.width), dtype=np.int64)
            out[np.repeat(np.arange(len(out)), np.diff(csr.starts)), csr.columns] = csr.values
            return out

        assert (dense(sparse(x).times(sparse(y))) == x @ y).all()
        assert (dense(sparse(x).transposed()) == x.T).all()


def test_overlaps_are_shared_bytes():
    a, b = align.byte_level(BYTES), align.piece_level(PIECES)
    found = align.align(["Some überlong wörds 123"], a, b).overlaps[0]
    ends = [np.cumsum([0] + [len(t.pieces[i].as_py()) for i in t.encode(["Some überlong wörds 123"])[0]]) for t in (a, b)]
    for row in range(len(ends[0]) - 1):
        own = {int(c): int(v) for c, v in zip(found.columns[found.starts[row] : found.starts[row + 1]], found.values[found.starts[row] : found.starts[row + 1]])}
        shared = {j: min(ends[0][row + 1], ends[1][j + 1]) - max(ends[0][row], ends[1][j]) for j in range(len(ends[1]) - 1)}
        assert own == {j: n for j, n in shared.items() if n > 0}
