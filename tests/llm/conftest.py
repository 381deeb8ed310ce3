import pytest
from pyspark.sql import functions as F

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix strong potions near old castles".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] for i in range(n))


#: Null, empty and blank texts, ties, repeated rows, a null id, very long texts, odd characters.
TEXTS = [
    (1, prose(1, 60)),
    (2, prose(1, 60)),
    (3, prose(3, 80) + "."),
    (3, prose(3, 80) + "."),
    (4, None),
    (5, ""),
    (6, " \t\n\r\x0b\x0c "),
    (None, prose(9, 40)),
    (7, prose(7, 20_000)),
    (8, "x" * 50_000),
    (9, "Émile's café — naïve 😀 <|endoftext|> \x1c a\x85b c ΑΒΓ слово 漢字 İstanbul don't!!"),
    (10, "\n".join(["one line here", "one line here", "", "one line here", "other"])),
    (11, "mail me a.b@c.example.com. or x@y z@w.org 10.0.0.1 999.1.1.1 card 4111 1111 1111 1111 +1 (555) 010-9999"),
    (12, "1" * 30_000 + " " + "12 " * 2_000),
    (13, "9 words are not enough for any rule"),
    (14, " ".join(["a b c d e f g h"] * 10)),
    (15, "12345 !!! 67"),
]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """Documents with every odd case, and extra columns named like what operators make; a stored table."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    rows = [(i, t, ["en", "de", None][k % 3], "src0", k, "x", 1.0) for k, (i, t) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bits string, score double")
    df = df.withColumns({"key": F.lit("k"), "ids": F.lit(0), "words": F.lit("w"), "row": F.lit("r"), "n": F.lit(None).cast("int")})
    df.coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (3, 0, 0), (7, 1, 0), (14, 0, 0), (None, 1, 0), (15, None, None)], "doc_id long, quality int, toxic int")
