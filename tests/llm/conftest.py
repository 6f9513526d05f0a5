import pytest

TEXTS = ["Of the er and thing.", None, "", "  \t\n", "12 34 !!", "wort " * 3000, "É çà ê", "Of the er and thing."]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns with clashing names."""
    rows = [(i, t, ("en", "de", None)[i % 3], "s", len(t or ""), "x", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "of the er", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "`key` string, n_words int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]
