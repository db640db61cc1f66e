import pytest

# columns whose names clash with those that the operators make inside
EXTRA = "doc long, slot string, n_words double, size string, id string, same int, host string, score string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls in any column, empty and long texts, repeated rows, and clashing extra columns."""
    copy = "The committee met again on the third of May to settle the question of the water supply for the town."
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
    extra = (1, "s", 1.5, "z", "k", 3, None, "q")
    rows = [
        (0, copy, "a"), (1, copy, None), (2, None, "a"), (None, "A text without an id, which is seven.", "b"), (3, "", "b"),
        (4, copy + " It rained.", "a"), (5, long, "c"), (5, long, "c"), (6, long + " end", None), (7, " \n\t ", ""),
        (8, "x" * 30_000, "c"), (None, None, None), (9, copy, "a"),
    ]
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, source string, {EXTRA}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
