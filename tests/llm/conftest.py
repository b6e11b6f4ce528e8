import pytest

LONG = "lorem ipsum dolor " * 20_000

#: Nulls, empty and very long texts, ties and repeated rows, next to columns named like internal ones.
ROWS = [
    (1, "a b c d e f g h", "en", "s0"),
    (2, "a b c d e f g h", "en", "s0"),
    (3, None, "en", "s0"),
    (4, "", None, "s0"),
    (5, "  \n\t ", "de", None),
    (6, LONG, "en", "s1"),
    (6, LONG, "en", "s1"),
    (7, LONG + "x", "en", "s1"),
    (None, "nobody's text", "fr", "s1"),
    (None, None, None, None),
    (8, "mail bob@mail.example.com or +1 (256) 555-6953, 10.0.0.1", "en", "s2"),
    (9, "the same <|endoftext|> twice  over\r\n日本語 ÄÖ", "de", "s2"),
]
EXTRA = (
    "key long, hash long, body string, digest string, node long, count long, score double, kept boolean, size int, "
    "_key string, _toxicity double, mask int, part string, bucket int, place long, rank int"
)


@pytest.fixture(scope="module")
def odd(spark):
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    rows = [(*r, 0, 1, 2, "x", "y", 3, 4, 0.5, True, 7, "keep", 0.25, 8, "z", 9, 10, 11) for r in ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
