"""Each operator against a brute-force version, on odd cases and on the smallest tables."""

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import TEXTS, prose
from viewflow.llm import bpe, counts, html, langid, lm, neardup, packing, pii, quality, topk

DATA = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD_BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPACE = r"[^\x20\x09-\x0D]+"
given = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")


def by_text(rows, columns):
    """Results as a multiset of ids and values."""
    return Counter(tuple(row[c] for c in columns) for row in rows)


# Pages


def test_pages(spark):
    page = (
        '<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="x"><nav><ul><li><a href="/">Home</a></li></ul></nav>'
        '<div class="cookie-banner"><p>We use cookies here.</p></div><!-- no <p>no</p> --><article><h1>Head&amp;line</h1>'
        '<p>First  part<br>of\n it.</p><script>var t="</p>";</script><p><b>Bold &#233;t&eacute;<br><p>Open end</article>'
        '<section class="comments"><p>Reader says something long enough to be a paragraph.</p></section><aside><p>More to read elsewhere.</p></aside>'
        '<form><label>Mail</label><button>Go</button></form><footer>&copy; us</footer></body></html>'
    )
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "plain < text &am"), (4, "x", "<p>cut<di"), (5, "y", "<div>" * 3000 + "deep")]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("z"))).collect()
    texts = [row.text for row in out]
    assert texts[0] == texts[1] == "Head&line\n\nFirst part of it.\n\nBold été\n\nOpen end"
    assert texts[2:4] == ["", ""] and texts[4] == "plain < text &am" and texts[5] == "cut" and texts[6] == "deep"
    assert [row.n_chars for row in out] == list(map(len, texts))
    assert html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").limit(0)).count() == 0


def test_a_missing_body_is_opened():
    """The same text with and without the tags that a page may leave out."""
    model = html.trained()
    long = "This text goes on for a while, with commas and an end, as the texts of articles do."
    article = f"<article><h1>Headline</h1><p>{long}</p></article><div class='next-prev'><a href='/1'>Before</a> <a href='/2'>Next</a></div>"
    wanted = html.main_texts([f"<html><head><title>t</title></head><body>{article}</body></html>"], model)
    assert long in wanted[0]
    for page in (
        article,
        f"<!DOCTYPE html>\n<title>t</title>\n{article}",
        f"<html><head><title>t</title><meta charset=utf-8></head>{article}</html>",
        f"<html><head><title>t</title><style>p {{}}</style>{article}",
        f"<head><script>var a = '<p>';</script></head>\n{article}<body>",
    ):
        assert html.main_texts([page], model) == wanted, page
    assert html.main_texts([long, f"<html>{long}", "", " \n", "<head></head>"], model) == [long, long, "", "", ""]


def test_only_raw_text_is_cut_from_a_page():
    """Elements that close themselves, names that begin like raw ones, and elements without an end tag cut nothing."""
    model = html.trained()
    one, two = "A first sentence stands here, with some words.", "A second one stands here, with more words."
    closed = ['<svg viewBox="0 0 1 1"/>', "<math/>", '<object data="x" />', "<iframe src='x'/>", "<canvas/>", "<select/>", '<script src="x"/>', "<style />"]
    custom = ["<svg-icon></svg-icon>", '<title-block a="b"></title-block>', "<select-all></select-all>", "<script-x>"]
    open_ = ["<div><script>var a = 1;</div>", '<div><object data="x"></div>', '<div><iframe src="x"></div>', "<div><canvas></div>", "<div><title></div>"]
    raw = ["<script>var a = '<p>no</p>';</script >", "<style>p{}</style>", "<template><p>no</p></template>", "<textarea>no</textarea>", "<title>no</title>"]
    for piece in [*closed, *custom, *open_, *raw]:
        page = f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Head</h1><p>{one}</p>{piece}<p>{two}</p></article></body></html>"
        assert html.main_texts([page], model) == [f"Head\n\n{one}\n\n{two}"], piece
    inner = "<p>The sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> is <object>two</object> or <canvas>three</canvas> here.</p>"
    page = f"<html><body><article><h1>Head</h1>{inner}<noscript><p>{two}</p></noscript></article></body></html>"
    assert html.main_texts([page], model) == [f"Head\n\nThe sum x+1 is two or three here.\n\n{two}"]
    many = "<article>" + "<script>" * 20_000 + f"</article><p>{one}</p>" + "<title>" * 20_000
    assert html.main_texts([many], model) == [one]


def test_marginals_are_those_of_all_states():
    """Messages against the sum over all states of a small tree."""
    forest = html.Forest()
    forest.add('<div class="menu"><p>a</p><ul><li>b</ul></div><p>Some sentence here.</p>')
    graph = html.Graph(forest)
    rng = np.random.default_rng(1)
    weights, edge = rng.normal(size=len(html._COLUMNS)), rng.normal(size=(2, 2))
    content, joint = graph.marginals(weights, edge)
    n = len(graph.parent)
    unary = np.bincount(graph.at, weights=weights[graph.column], minlength=n)
    total, on, pair = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for state in range(2**n):
        bits = [state >> i & 1 for i in range(n)]
        value = np.exp(sum(unary[i] * bits[i] for i in range(n)) + sum(edge[bits[p], bits[i]] for i, p in enumerate(graph.parent) if p >= 0))
        total += value
        on += value * np.array(bits)
        for i, p in enumerate(graph.parent):
            if p >= 0:
                pair[i, bits[p], bits[i]] += value
    assert np.allclose(content, on / total) and np.allclose(joint[1:], pair[1:] / total)


@given
def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    for row in html.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", row.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(x for x in parts if x)


# Languages


def test_languages(docs, empty):
    out = langid.languages(docs).collect()
    assert len(out) == len(TEXTS)
    learned = {"en", "de"}
    for row in out:
        text = dict((i, t) for i, t in TEXTS)[row.doc_id]
        has = bool(text and re.search(r"[^\W\d_]", text))
        assert (row.lang_pred == "und") == (not has) and 0 <= row.score <= 1 and (not has or row.lang_pred in learned)
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
    assert langid.languages(empty).count() == 0
    kept = langid.spoken(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(TEXTS)


def test_spans_are_the_best_of_all_labels():
    rng = np.random.default_rng(2)
    model = langid.Model(["a", "b", "c"], np.zeros((1, 3)), np.zeros((1, 3)))
    lengths = np.array([0, 1, 6, 4, 0])
    scores = (rng.normal(size=(11, 3)) * 6).astype(np.float32)
    found = model.spans(scores, lengths)
    start = 0
    for n in lengths.tolist():
        own = scores[start : start + n]

        def total(labels):
            return sum(own[i, x] for i, x in enumerate(labels)) - langid.SWITCH * sum(a != b for a, b in zip(labels, labels[1:]))

        every = [[k // 3**i % 3 for i in range(n)] for k in range(3**n)]
        assert np.isclose(total(found[start : start + n].tolist()), max(map(total, every)), atol=1e-3)
        start += n


def test_mixed_text_is_cut_where_the_language_changes(spark):
    german = "der Hund und die Katze gehen nicht mit dem Mann über die Straße"
    english = "the dog and the cat do not walk with the man over the street"
    rows = [(i, (german if i % 2 else english) + f" {i}", "de" if i % 2 else "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    mixed = spark.createDataFrame([(1, english + " " + german + " " + german)], "doc_id long, text string")
    row = langid.labelled(mixed, langid.fit(docs)).first()
    assert [s.lang for s in row.spans] == ["en", "de"] and row.lang_pred == "de" and 0.5 < row.score < 0.9
    assert (row.spans[0].first, row.spans[1].first) == (0, 14)


@given
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = langid.languages(docs).join(docs, "doc_id").where("held_out")
    assert out.where("lang_pred = lang").count() >= 0.97 * out.count()


def test_marks_alone_are_no_letters(spark):
    docs = spark.createDataFrame([(i, "the dog and the cat", "en") for i in range(20)], "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(1, "\u0301\u0308 \u20dd"), (2, "e\u0301")], "doc_id long, text string")
    assert {(r.row.doc_id, r.lang_pred) for r in langid.labelled(odd, langid.fit(docs)).collect()} == {(1, "und"), (2, "en")}


def test_language_sample_is_bounded(spark):
    """One language over many partitions: no task gathers its ids, and the least text of an id counts."""
    docs = spark.range(3000).selectExpr("id % 2500 as doc_id", "concat('wort ', id) as text", "if(id % 10 = 0, 'de', 'en') as lang").repartition(200)
    model = langid.fit(docs, 100)
    again = langid.fit(docs.repartition(3), 100)
    assert model.langs == ["de", "en"] and (model.scores == again.scores).all()


def test_whole_texts_are_learned_from(spark):
    """Two languages that differ only behind a long beginning of the same words."""
    head = "site menu home page search " * 100
    own = {"aa": "bela mora tiku sano rumi", "bb": "krath vund skelt droth grimp"}
    rows = [(i, head + own[lang], lang) for i in range(40) for lang in [["aa", "bb"][i % 2]]]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = langid.labelled(spark.createDataFrame(list(own.items()), "lang string, text string"), model)
    assert {(r.row.lang, r.lang_pred) for r in found.collect()} == {("aa", "aa"), ("bb", "bb")}


def test_documents_of_several_languages_stay(spark):
    """Whatever the shares of the languages; text that tells nothing goes."""
    own = {"aa": "bela mora tiku sano rumi lipa", "bb": "krath vund skelt droth grimp wolch", "cc": "zezo qix yuxu jozi xaqu quzy"}
    rows = [(i * 3 + k, " ".join([text] * 5), lang) for i in range(30) for k, (lang, text) in enumerate(own.items())]
    a, b, c = (text + " " for text in own.values())
    mixed = [(1000, a * 4 + b * 3 + c * 3, None), (1001, a * 10 + b * 9 + c, None), (1002, a, None), (1003, "12 34 !!", None)]
    kept = langid.spoken(spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string"))
    assert {r.doc_id for r in kept.where("doc_id >= 1000").collect()} == {1000, 1001, 1002}
    same = [(i, "bela mora tiku", ["aa", "bb"][i % 2]) for i in range(40)]
    docs = spark.createDataFrame(same, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    model.scores[:, 1] = model.scores[:, 0]
    assert all(r.margin == 0 for r in langid.labelled(docs, model).collect())


# Byte-level BPE


@pytest.fixture(scope="module")
def tiktoken_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_the_librarys(docs, empty, tiktoken_encoding):
    wanted = [(i, tiktoken_encoding.encode_ordinary(t or "")) for i, t in TEXTS]
    encoded = bpe.encode(docs, RANKS, PATTERN)
    # The rows of the two files come in any order.
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((i, tuple(ids)) for i, ids in wanted)
    assert Counter(bytes(r.decoded).decode() for r in bpe.decode(encoded, RANKS, PATTERN).collect()) == Counter(t or "" for _, t in TEXTS)
    digests = [
        (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for (i, ids), (_, t) in zip(wanted, TEXTS)
    ]
    assert Counter(map(tuple, bpe.round_trip(docs, RANKS, PATTERN).collect())) == Counter(digests)
    assert bpe.round_trip(empty, RANKS, PATTERN).count() == 0


def test_merges_of_random_texts(tiktoken_encoding):
    coder = bpe.encoder(RANKS, PATTERN)
    rng = random.Random(3)
    parts = ["a", "b", "aa", "é", " ", "  ", "\n", "1", "ü", "the", "😀", "'s", "!!", "xxxxx", " ", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(500)] + ["ab" * 5000, "a" * 3001]
    for text, cut in zip(texts, coder.pieces(texts)):
        assert [i for piece in cut for i in coder.ids[piece]] == tiktoken_encoding.encode_ordinary(text)


def test_common_pre_tokens_stay_known(monkeypatch):
    coder, asked = bpe.Encoder(RANKS, PATTERN), []
    encode = coder.merges.encode
    monkeypatch.setattr(bpe, "CACHE_WORDS", 4)
    monkeypatch.setattr(coder.merges, "encode", lambda words: asked.extend(words) or encode(words))
    for text in ("a b c", "a b d", "a b e f", "a b g"):
        cuts = coder.pieces([text]), coder.digested([text])
        assert cuts[0] == cuts[1] and b"".join(map(coder.back.__getitem__, cuts[1][0])).decode() == text
        assert all(" ".join(map(str, coder.ids[word])) == coder.shown[word] for word in cuts[0][0])
        assert len(coder.ids) <= 4 and coder.shown.keys() == coder.back.keys() == coder.ids.keys()
    assert Counter(asked)[b"a"] == Counter(asked)[b" b"] == 2  # once for each kind of memory


# Top-k


def brute_top(vectors, k):
    clean = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for row, (q, a) in enumerate(clean):
        if q % 100 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for at, (i, b) in enumerate(clean) if at != row and len(a) == len(b))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 2]) for i in range(330)]
    vectors += [(500, [0.0] * 5), (501, vectors[7][1]), (502, vectors[7][1]), (600, None), (601, [1.0, None, 1.0, 1.0, 1.0])]
    vectors += [(700, [float("nan")] * 5), (701, [float("inf")] + [0.0] * 4), (None, [1.0] * 5), (800, [1.0, 2.0]), (801, [3.0, 4.0]), (900, [])]
    vectors += [(100, vectors[100][1]), (3, vectors[3][1]), (1000, [2.0**24] * 3), (1001, [-(2.0**10)] * 3)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(3)
    found = topk.neighbours(df, 4).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == brute_top(vectors, 4)
    assert topk.neighbours(df.limit(0)).count() == 0


def test_top_k_in_small_blocks(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(500)]
    df = topk.quantised(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    found = topk.search(df, df.where(topk.is_query(F.col("key"))), 10, block=70, per_block=2, pairs=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == brute_top(vectors, 10)


# Near copies


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode("utf-8"))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    own = sorted(root)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    return {p: find(p) for p in root}


def check_near_copies(rows, texts):
    prints = [brute_fingerprint(t) for _, t in texts]
    roots = brute_components(set(prints))
    least = defaultdict(list)
    for (i, _), p in zip(texts, prints):
        least[roots[p]].append(i)
    names = {root: min((i for i in ids if i is not None), default=None) for root, ids in least.items()}
    wanted = Counter((i, f"{p:016x}", names[roots[p]]) for (i, _), p in zip(texts, prints))
    assert by_text(rows, ("doc_id", "fingerprint", "component_id")) == wanted


def test_near_copies(docs, empty):
    check_near_copies(neardup.near_copies(docs).collect(), TEXTS)
    assert neardup.near_copies(empty).count() == 0
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    roots = brute_components({brute_fingerprint(t) for _, t in TEXTS})
    assert kept.count() == len({roots[brute_fingerprint(t)] for _, t in TEXTS})
    assert neardup.one_of_each(empty).count() == 0


@given
def test_near_copies_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    check_near_copies(neardup.near_copies(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("group", [3, 1000])
def test_links_join_all_that_are_close(spark, group):
    """Chains and a dense group, taken at once or cut further."""
    rng = random.Random(6)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for start in list(prints)[:6]:
        for _ in range(12):  # steps of up to two bits
            start ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(start)
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << rng.randrange(64)) for _ in range(25)}
    signed = [(neardup._signed(p),) for p in prints]
    edges = neardup.links(spark.createDataFrame(signed, "bits long"), group=group)
    for a, b in edges.collect():
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 2
    found = {r.node & (1 << 64) - 1: r.root for r in neardup.components(edges).collect()}
    groups, wanted = defaultdict(set), defaultdict(set)
    for p in prints:
        groups[found.get(p, ("alone", p))].add(p)
    for p, root in brute_components(prints).items():
        wanted[root].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


# Packing


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    wanted = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in TEXTS]
    rows = packing.pack(docs, WORD_BPE, sequence=64).collect()
    by_sequence = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for number, pieces in by_sequence.items():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] == 64 or number == max(by_sequence) and ends[-1] <= 64
    assert len(by_sequence) == -(-sum(len(ids) for _, ids in wanted) // 64)
    # Pieces, put together in order, are the documents.
    found, open_ = [], []
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        if r.start == 0:
            open_ = []
            found.append((r.doc_id, open_))
        assert r.start == len(open_)
        open_ += np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert len(open_) <= r.doc_tokens
    assert Counter((i, tuple(ids)) for i, ids in found) == Counter((i, tuple(ids)) for i, ids in wanted)
    assert packing.pack(empty, WORD_BPE).count() == 0


# Personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        luhn = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in BASE.items() for m in re.finditer(p, text or "") if valid(kind, m[0])]


def check_personal_data(rows, texts):
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    for i, text in texts:
        spans = brute_spans(text)
        r = found[i].pop()
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in spans) for k in BASE]
        assert set(spans) <= set(r.spans.split(","))
    assert not any(found.values())


def test_personal_data(docs, empty):
    check_personal_data(pii.personal_data(docs).collect(), TEXTS)
    assert pii.personal_data(empty).count() == 0


def test_base_patterns_on_random_texts(spark):
    rng = random.Random(7)
    parts = ["a@b.c", "@", ".", "a", "_", "é😀", " ", "-", "1", "23", "255", "256", "0", "+", "(", ")", "4111111111111111", "10.0.0.1", "\n", "x@y.z_q@r.s"]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(800)]
    check_personal_data(pii.personal_data(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts)


@given
def test_personal_data_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    check_personal_data(pii.personal_data(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_redaction(spark, docs):
    out = pii.redacted(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    row = out.where("doc_id = 11").first()
    assert row.text == "mail me [EMAIL] or x@y [EMAIL] [IP] 999.1.1.1 card [CARD] [PHONE]".replace("[EMAIL] or", "[EMAIL]. or") and row.n_chars == len(row.text)
    assert not any(brute_spans(r.text) for r in out.collect())
    assert out.where("doc_id = 4 AND text IS NULL").count() == 1


def test_trees_add_what_looks_the_same(spark):
    """Cards in a format that the base pattern misses, among many that it finds and numbers that are none."""
    rng = random.Random(8)

    def card(good):
        digits = [4, *(rng.randrange(10) for _ in range(14))]
        total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits))
        return "".join(map(str, digits)) + str((10 - total % 10 + (0 if good else 5)) % 10)

    texts = [(i, f"pay by card {card(i % 2 == 0)} today") for i in range(1000)]
    number = card(True)
    texts.append((5000, "pay by card " + ".".join(number[i : i + 4] for i in (0, 4, 8, 12)) + " today"))
    found = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found[5000].spans == "card:12:31" and found[5000].n_card == 0
    assert all(found[i].spans == "" for i in range(1, 1000, 2))


def test_trees_add_what_no_base_pattern_has(spark):
    """Spelled-out addresses, national numbers and IPv6, on few documents; numbers and words that look alike stay."""
    texts = [
        "Write to jane.doe (at) example (dot) com. Thanks",
        "joe [at] example.org is away",
        "Reach max @ example.net, please",
        "Call (555) 123-4567 today",
        "Our number is 555-123-4567 and no other.",
        "from abroad 0049 30 1234 5678 works",
        "tel. 030 1234 5678 in the week",
        "the host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 is down",
        "ping fe80::1ff:fe23:4567:890a or wait",
        "Potatoes @ 3.50 each, we met @ home . then it rained",
        "On 2024-01-15 and 15.01.2024 we sold 1 234 567 of them, 12 34 56 a day",
        "order 555-123-4567 of version 1.2.3 at 12:30:45 uses std::f and ab::cd",
        "see 999.1.1.1 or card 4111.1111.1111.1112",
    ]
    spans = ["jane.doe (at) example (dot) com", "joe [at] example.org", "max @ example.net", "(555) 123-4567", "555-123-4567", "0049 30 1234 5678", "030 1234 5678"]
    spans += ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1ff:fe23:4567:890a"]
    kinds = ["email"] * 3 + ["phone"] * 4 + ["ip"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    wanted = [f"{k}:{t.index(s)}:{t.index(s) + len(s)}" for k, t, s in zip(kinds, texts, spans)]
    assert [found[i] for i in range(len(texts))] == wanted + [""] * (len(texts) - len(wanted))
    new = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert new[0] == "Write to [EMAIL]. Thanks" and new[3] == "Call [PHONE] today" and new[8] == "ping [IP] or wait"


# Token counts


def brute_count(model, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        tried = [(best[end - 1][0] + n * model.byte_score, best[end - 1][1] + n)]
        tried += [(best[s][0] + model.scores[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in model.scores]
        best.append(max(tried, key=lambda x: (x[0], -x[1])))
    return best[-1]


def test_token_counts(docs, empty):
    model = counts.Unigram(PIECES)
    short = [(i, t) for i, t in TEXTS if len(t or "") < 2_000]
    rows = counts.token_counts(docs, PIECES).collect()
    assert len(rows) == len(TEXTS)
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add((r.n_words, r.n_tokens, r.score))
    for i, t in short:
        words = re.findall(SPACE, t or "")
        each = [brute_count(model, "▁" + w) for w in words]
        (own,) = found[i]
        assert own[:2] == (len(words), sum(n for _, n in each)) and np.isclose(own[2], sum(s for s, _ in each), atol=1e-4)
    assert counts.token_counts(empty, PIECES).count() == 0


def test_the_trie_and_the_path_agree():
    model = counts.Unigram(PIECES)
    rng = random.Random(9)
    words = list({"▁" + "".join(rng.choice("theinga😀é\x00zq") for _ in range(rng.randint(0, 60))) for _ in range(2000)})
    assert model.count(words) == model._along_path(words)
    assert model.count([]) == {}


# Quality rules


def brute_quality(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


NAMES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality(docs, labels, empty):
    rows = quality.quality(docs, labels).collect()
    assert by_text(rows, NAMES) == Counter((i, *brute_quality(t)) for i, t in TEXTS)
    assert not any(r.kept and r.base_failed for r in rows)
    kept = quality.kept(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert quality.quality(empty, labels).count() == 0
    # Without labels nothing but the rules decides.
    assert all(r.kept != r.base_failed for r in quality.quality(docs, labels.limit(0)).collect())


@given
def test_quality_of_the_table(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))
    rows = quality.quality(docs, labels).collect()
    assert by_text(rows, NAMES) == Counter((r.doc_id, *brute_quality(r.text)) for r in docs.collect())
    judged = {r.doc_id: r for r in rows if not r.base_failed}
    verdicts = [(r.quality, judged[r.doc_id].kept) for r in labels.collect() if r.doc_id in judged]
    good, bad = ([kept for label, kept in verdicts if label == x] for x in (1, 0))
    assert np.mean(good) >= 0.98 and (not bad or np.mean(bad) <= 0.2)


def test_quality_model_counts_every_label(spark):
    # All documents are good: target and corpus are the same, however many there are.
    docs = spark.range(41_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert set(quality.fit(docs, labels)) == {0.0}


def brute_threshold(found):
    good, bad = (sorted(x for x, label in found if label == kind) for kind in (1, 0))
    if not good or not bad:
        return float("-inf")
    at_most = good[int(len(good) * (1 - quality.KEEP))]
    best = max((x for x in good if x <= at_most), key=lambda x: (sum(y < x for y in bad) / len(bad) - sum(y < x for y in good) / len(good), -x))
    below = [y for y in bad if y < best]
    return (best + below[-1]) / 2 if below else best


@pytest.mark.parametrize("seed", range(4))
def test_quality_threshold(spark, seed):
    draw = random.Random(seed)
    found = [(round(draw.gauss(0.3 * label - 0.2, 0.1), 2 + seed), label) for label in (0, 1, 1) for _ in range(500)]
    df = spark.createDataFrame(found, "score double, good int")
    assert quality.threshold(df) == brute_threshold(found)
    for label in (0, 1):
        assert quality.threshold(df.filter(F.col("good") == label)) == float("-inf")
    low = [(0.5, 1), (0.5, 0), (0.75, 1), (0.75, 0), (1.0, 1)]
    assert quality.threshold(spark.createDataFrame(low, "score double, good int")) == brute_threshold(low)


def test_scores_are_mean_ratios(spark):
    values = [((i * 37) % 101 - 50) / 10 for i in range(2 * quality.BUCKETS)]
    df = spark.createDataFrame([("a b c",), ("a",), ("",), (None,)], "text string").withColumn("words", quality.words_of(F.col("text")))
    hashed = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None)], "x string, y string").select("x", F.pmod(F.xxhash64("x"), F.lit(quality.BUCKETS)).alias("one"), (F.pmod(F.xxhash64("x", "y"), F.lit(quality.BUCKETS)) + quality.BUCKETS).alias("two")).collect()
    one, two = [values[r.one] for r in hashed], [values[r.two] for r in hashed[:2]]
    found = [r.s for r in df.select(quality.score(F.col("words"), F.size("words"), values).alias("s")).collect()]
    assert np.allclose(found, [(sum(one) + sum(two)) / 5, one[0], 0, 0])


# Language model


def lm_code(word):
    return int(lm._codes(pa.array([word]))[0])


def test_pseudo_likelihood(docs, empty):
    model = lm.fit(docs, rounds=1)
    rows = lm.pseudo_likelihood(docs, model).collect()
    net = lm.Network(model.weights)
    counts = Counter(w for _, t in TEXTS for w in re.findall(SPACE, (t or "").lower()))
    sizes = Counter()
    for word, n in counts.items():
        sizes[lm_code(word)] += n

    def log_softmax(z, chosen):
        z = z.astype(np.float64)
        return z[chosen] - np.log(np.exp(z).sum())

    def embedding(code):
        if code is None:
            return np.zeros(lm.HIDDEN)
        one, two, three = code // lm.BASE**2, code // lm.BASE % lm.BASE, code % lm.BASE
        return net.left[one * lm.BASE + two] + net.right[one * lm.BASE + three]

    def score(text):
        words = re.findall(SPACE, (text or "").lower())
        own = [lm_code(w) for w in words]
        padded, total = [None, None, *own, None, None], 0.0
        for i, code in enumerate(own):
            around = padded[i], padded[i + 1], padded[i + 3], padded[i + 4]
            h = np.tanh(net.hidden + sum(net.scale[p] * embedding(c) for p, c in enumerate(around)))
            one, two, three = code // lm.BASE**2, code // lm.BASE % lm.BASE, code % lm.BASE
            rest = h @ net.rest[one] + net.rest_bias[one]
            total += log_softmax(h @ net.first + net.first_bias, one)
            total += log_softmax(rest[: lm.BASE], two) + log_softmax(rest[lm.BASE :], three)
            total += np.log(counts[words[i]] / sizes[code] * (1 - lm.UNSEEN))
        return len(own), total

    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add((r.n_tokens, r.log_prob))
    for i, t in TEXTS:
        if len(t or "") < 2_000 and not (t and "İ" in t):
            ((n, total),) = found[i]
            wanted = score(t)
            assert n == wanted[0] and np.isclose(total, wanted[1], atol=0.02)
    assert len(rows) == len(TEXTS)
    assert lm.scored(empty).count() == 0


def test_words_beyond_the_frequent_ones_are_joined(docs, monkeypatch):
    model = lm.fit(docs, rounds=0)
    wanted = by_text(lm.pseudo_likelihood(docs, model).collect(), ["doc_id", "n_tokens", "log_prob"])
    for some in ({}, dict(list(model.frequent.items())[:7])):
        joined = lm.pseudo_likelihood(docs, lm.Model(model.weights, model.words, some))
        assert by_text(joined.collect(), ["doc_id", "n_tokens", "log_prob"]) == wanted


def lm_places(rng, n=60):
    """A stream of codes of two texts, and the places of the words."""
    stream = np.full(n + 6, lm.CODES)
    at = np.concatenate([np.arange(2, 2 + n // 2), np.arange(4 + n // 2, 4 + n)])
    stream[at] = rng.integers(0, lm.CODES, n)
    return stream, at


def test_gradient_is_the_slope():
    rng = np.random.default_rng(10)
    net = lm.Network.new(np.ones((lm.BASE, lm.BASE)), np.ones((lm.BASE, lm.BASE)))
    stream, at = lm_places(rng)
    slope = net.gradient(stream, at)
    step = rng.standard_normal(len(net.flat)).astype(np.float32) * 1e-3

    def loss(flat):
        return -lm.Network(flat.astype(np.float32)).log_probabilities(stream, at).mean()

    assert np.isclose(loss(net.flat + step) - loss(net.flat - step), 2 * float(slope @ step), rtol=0.02)
    # Every kind of weight by itself.
    for name in lm._SHAPES:
        one = lm.Network(np.zeros_like(net.flat))
        getattr(one, name)[:] = rng.standard_normal(lm._SHAPES[name]) * 1e-2
        change = loss(net.flat + one.flat) - loss(net.flat - one.flat)
        assert np.isclose(change, 2 * float(slope @ one.flat), rtol=0.05, atol=1e-6), name


def test_probabilities_of_all_codes_have_the_sum_one():
    rng = np.random.default_rng(11)
    net = lm.Network.new(rng.integers(0, 50, (lm.BASE, lm.BASE)), rng.integers(0, 50, (lm.BASE, lm.BASE)))
    stream = np.array([lm.CODES, 5, 0, 77_000, lm.CODES])
    chunks = []
    for code in rng.permutation(lm.CODES)[:0:-1][:2_000]:
        stream[2] = code
        chunks.append(np.exp(net.log_probabilities(stream, np.array([2])))[0])
    # 2,000 of all codes, so about their part of it.
    assert 0.3 < sum(chunks) * lm.CODES / 2_000 < 3


def test_training_beats_the_frequencies_and_repeats(spark):
    texts = [(i, prose(i % 5, 400)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3, "doc_id")
    trained = lm.fit(docs)
    plain = lm.fit(docs, rounds=0)
    shuffled = docs.withColumn("text", F.concat_ws(" ", F.array_sort(F.split("text", " "))))
    score = [lm.pseudo_likelihood(df, m).agg({"log_prob": "sum"}).first()[0] for df, m in ((docs, trained), (docs, plain), (shuffled, trained))]
    assert score[0] > score[1] and score[0] > score[2]
    assert (lm.fit(docs).weights == trained.weights).all()


def test_every_word_is_seen_as_context_and_as_target(spark):
    """Words as frequent as each other, which keep other company: each fits its own, on both sides."""
    texts = [(i, prose(i % 7, 100) + " aa keit bb . cc hewh dd ." * 200) for i in range(20)]
    model = lm.fit(spark.createDataFrame(texts, "doc_id long, text string"))
    swaps = ["aa keit bb", "cc hewh dd", "aa hewh bb", "cc keit dd"]
    tries = spark.createDataFrame([(t, t) for t in swaps], "doc_id string, text string")
    found = {r.doc_id: r.log_prob for r in lm.pseudo_likelihood(tries, model).collect()}
    assert len(set(found.values())) == len(swaps)
    assert found["aa keit bb"] + found["cc hewh dd"] > found["aa hewh bb"] + found["cc keit dd"] + 1


def test_words_of_one_code_have_their_shares(spark):
    codes = defaultdict(list)
    for i in range(3_000):
        codes[lm_code(f"w{i}")].append(f"w{i}")
    a, b = next(words for words in codes.values() if len(words) > 1)[:2]
    model = lm.fit(spark.createDataFrame([(f"{a} " * 9,), (f"{b} " * 4,)], "text string"), rounds=0)
    tries = spark.createDataFrame([(0, f"x {a} y"), (1, f"x {b} y"), (1, f"x {b} y")], "doc_id long, text string")
    found = by_text(lm.pseudo_likelihood(tries, model).collect(), ["doc_id", "log_prob"])
    assert sorted(found.values()) == [1, 2]
    (_, high), (_, low) = sorted(found)
    assert np.isclose(high - low, np.log(9 / 4), atol=0.02)


def test_each_token_is_trained_on(spark):
    """The weight of a first digit that is a target rises from a uniform start, late ones in a partition too."""
    for texts in ([" ".join(f"w{i}" for i in range(8)) + " "] * 600, ["w5 w6 "] * 2000, ["w1 " * 9_000, "w2 " * 9_000]):
        docs = spark.createDataFrame([(t * 2,) for t in texts], "text string").coalesce(1)
        seen = {lm_code(w) // lm.BASE**2 for t in texts for w in t.split()}
        start = lm.Network.new(np.ones((lm.BASE, lm.BASE)), np.ones((lm.BASE, lm.BASE)))
        after = lm.Network(lm._round(docs, start.flat))
        other = max(after.first_bias[d] for d in range(lm.BASE) if d not in seen)
        assert all(after.first_bias[d] > other for d in seen)
