import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from texts; doc_id is the place unless pairs are given."""

    def make(texts, extra=()):
        rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in (x if isinstance(x, tuple) else (k, x) for k, x in enumerate(texts))]
        df = spark.createDataFrame(rows, DOC)
        return df.selectExpr("*", *extra) if extra else df

    return make


#: Texts that every operator must take: null, empty, blank, one word, repeats, a very long one, odd characters.
ODD = [None, "", "   \n\t ", "x", "same text here", "same text here", "word " * 30000, "a" * 70000, "é ß 中文\x1f\x85 tab\tend ", "\\[INST] </s> <s>", "\U0001f600 \U0001f600"]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs([*ODD, (None, "no id at all"), (3, "repeated id")])


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])
