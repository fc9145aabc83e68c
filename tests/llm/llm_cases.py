import pytest

from motorlake.llm.common import ship


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package at hand for the workers."""
    ship(spark)
    return spark


DOCS = "doc_id bigint, text string"
#: Nulls, empty texts, blanks, a repeated row, a null key, ties, a very long text.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "one"), (5, "one two"), (None, None), (6, "über straße " * 30_000)]


@pytest.fixture()
def odd(llm):
    """Odd rows, with further columns whose names clash with results."""
    df = llm.createDataFrame(ODD, DOCS)
    names = ["row", "digest", "keep_id", "kept", "n", "set_id", "id", "place", "length", "_row", "_uid", "rate", "score", "n_tokens"]
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


@pytest.fixture()
def none(llm):
    return llm.createDataFrame([], DOCS + ", lang string")
