import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) pairs, or of texts numbered from 0."""

    def build(rows, lang="en"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, lang, "src0", None if t is None else len(t)) for i, t in rows], DOCS
        ).repartition(3)

    return build


ODD_TEXTS = [None, "", "   ", "a", "a b c", "word " * 30_000, "é È ß 日本語 İ 😀", "same text here again and again",
             "same text here again and again", "don't we'll <|endoftext|> 3.14 __x__\x85\x1c"]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD_TEXTS)
