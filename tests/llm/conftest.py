import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, digest string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of (id, text), with columns whose names clash with those that operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", 1, 0.5, 7, "x") for i, t in rows], SCHEMA)

    return make


#: Null ids and texts, empty, blank and repeated rows, ties, a very long text.
ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d e"), (None, None), (5, "a b c d e"), (5, "a b c d e"), (6, "A b  c\nd e"), (7, "x " * 30000), (8, "é ß İ 中文 \U0001f600 a\x85b")]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
