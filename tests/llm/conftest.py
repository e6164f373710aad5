import pytest

from tests.conftest import SMALL
from tests.llm.brute import WORDS

# Extra columns whose names the operators use inside.
EXTRA = "key string, bucket long, slot int, anchor string, n int, spans string, shingles int, features int, `from` int"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty, very short and very long texts, copies, repeated rows and ids, odd spaces and characters."""
    long = " ".join(WORDS(3000, 1))
    near = long.split(" ")
    near[1500] = "changed"
    texts = [
        (1, long, "a"), (2, " ".join(near), "a"), (3, long, None), (4, None, "b"), (5, "", "b"), (6, " \t\n ", None),
        (7, "one", "a"), (8, "One", "a"), (9, "one two three", "b"), (10, "été 中文 x y z", "c"), (11, long + " tail " + long, "a"),
        (12, " ".join(WORDS(60, 2)), "c"), (12, " ".join(WORDS(60, 2)), "c"), (12, " ".join(WORDS(60, 3)), "c"), (None, " ".join(WORDS(60, 2)), "c"),
        (None, None, None), (13, "same " * 400, "a"), (14, "x" * 5000, "a"), (15, "x" * 399, "a"), (16, "a\x00b\x1fc " * 50, "b"),
        (17, "  lead and trail  ", "b"), (-3, " ".join(WORDS(30, 2)), "b"),
    ]
    rows = [(i, t, "en", s, None if t is None else len(t), "k", 1, 2, "a", 3, "s", 4, 5, 6) for i, t, s in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
