import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, dealt over a few partitions, with extra columns of clashing names."""

    def make(rows, partitions=3):
        df = spark.createDataFrame(list(rows), DOCS)
        return df.selectExpr(
            "doc_id", "text", "'x' AS key", "1 AS n", "'y' AS block", "2.0 AS score", "array(1) AS places", "'z' AS kept").repartition(partitions)

    return make


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    """(doc_id, text) of the smallest table of documents."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


#: Nulls, empty and blank texts, one word, repeated rows, null ids, odd characters.
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "Word"), (5, "word"), (6, "two words"), (6, "two words"), (None, "a text without id"), (None, None),
    (7, "ÀÉ ß Σ x\x0by\x1cz"), (8, "\n\n\n"), (2**60, "an id beyond every float, an id beyond every float"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
