import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def edge_documents(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and columns that clash with the operators' own."""
    long_text = " ".join(f"w{i % 977} the" for i in range(30_000))
    rows = [
        (1, "a b c d e f g", "en", "s1", 7),
        (2, None, None, None, None),
        (3, "", "en", "s1", 0),
        (4, " \t\n\x0b\x0c\r ", "en", None, 5),
        (5, "a b c d e f g", "en", "s2", 7),
        (5, "a b c d e f g", "en", "s2", 7),
        (None, "a b c d e f g", "en", "s2", 7),
        (None, None, None, None, None),
        (7, "A b ÉTÉ mail x@y.org +1 (212) 555-0148 the MIT License.", "fr", "s3", 50),
        (8, long_text, "en", "s1", len(long_text)),
        (9, "one", "en", "\U0001f600", 3),
    ]
    table = [(*r, 0, True, "x", -1) for r in rows]
    return spark.createDataFrame(
        table, "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, _w string, size long"
    )


@pytest.fixture
def no_documents(edge_documents):
    return edge_documents.where("doc_id = -1")
