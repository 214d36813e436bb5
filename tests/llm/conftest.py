import pytest

LONG = "the quick brown fox jumps over the lazy dog and " * 3000

# Nulls, empty and blank texts, ties and repeated rows, odd characters, a very long text.
ROWS = [
    (1, "hello wörld  \n\n x", "en"), (2, None, "en"), (3, "", None), (4, "  \t\n ", "fr"), (5, LONG, "en"),
    (6, "same text here", "en"), (7, "same text here", "de"), (7, "same text here", "de"), (None, "no id", "en"),
    (8, "\U0001f600 中文 mixed blank \x1c\x85 <|endoftext|> é", "fr"), (9, "&&& ### 123", None),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents of every awkward kind, with further columns whose names clash with those of operators."""
    clash = "ids INT, decoded INT, n_tokens INT, Fingerprint INT, component_id INT, start INT, id INT, mark INT, lines INT"
    rows = [(*row, *range(9)) for row in ROWS]
    return spark.createDataFrame(rows, f"doc_id BIGINT, text STRING, lang STRING, {clash}").repartition(3)


@pytest.fixture(scope="session")
def none(awkward):
    """The same table without rows."""
    return awkward.limit(0)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
