import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from texts, with columns whose names clash with results."""

    def rows(texts, langs=None, ids=None):
        n = len(texts)
        data = [(i, t, g, "s", 0, None, 0.5) for i, t, g in zip(ids or range(n), texts, langs or ["en"] * n, strict=True)]
        return spark.createDataFrame(data, SCHEMA).repartition(3)

    return rows


ODD = [None, "", " \n\t ", "!!!", "one", "a b c d", "Ünï çödé 日本語 😀", "a\x01b\x02\x0b\x0cc\r\n\r\n", "word " * 30_000, "x" * 100_000, "same text here for ties", "same text here for ties"]


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and very long texts, ties, repeated rows, a null id."""
    return make([*ODD, ODD[-1], "null id"], langs=[None, "", "en", "de", *["en"] * 10], ids=[*range(12), 11, None])
