import pytest

from caselog.llm.common import prepare

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, k1 int, fp int, score int, spans int, _row int"


@pytest.fixture(scope="session")
def small(spark):
    prepare(spark)
    return SMALL


@pytest.fixture(scope="session")
def texts(spark, small):
    """Texts by id of the smallest test table."""
    return dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "one two"),
    (6, "Same text in two rows, word by word."),
    (6, "Same text in two rows, word by word."),
    (7, "Same text in two rows, word by word."),
    (None, "Same text in two rows, word by word."),
    (None, None),
    (8, "é😀 ß x " * 40),
    (9, "abc" * 3000),
    (10, "9" * 20_000),
    (11, "token = " + "a1B2" * 10 + " and a.b@c.de and 4111 1111 1111 1111, " + "x@y.z." * 50),
    (12, "The same line.\n" * 300),
    (13, " ".join(f"w{i}" for i in range(20_000))),
]


@pytest.fixture(scope="session")
def odd(spark, small):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names operators use."""
    rows = [(i, t, None, "s", len(t or ""), 1, 2, 3, 4, 5) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark, small):
    return spark.createDataFrame([], SCHEMA)
