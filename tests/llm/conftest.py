import pytest

LONG = "wörd " * 40_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with null, empty, blank, short, very long, equal and repeated texts, and columns of clashing names."""
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "One two.", "b"), (5, LONG, "b"), (6, "same text of seven words in all", "a"),
            (7, "same text of seven words in all", None), (8, "same text of seven words in al", "a"), (9, "x", "c"), (9, "x", "c"),
            (None, "no id here at all", "c"), (10, "wide 字 <|endoftext|> İ Σας \x1c end", "c"), (11, " ".join(f"w{i}" for i in range(3000)), "a")]
    return spark.createDataFrame([(*r, i, "t", "s", 0.5) for i, r in enumerate(rows)],
                                 "doc_id long, text string, source string, n int, words string, size string, score double")


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def bundled(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
