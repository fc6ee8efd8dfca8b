import random

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def edge_rows():
    """Null, empty, blank, very long, tied and repeated rows; ids with null."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "The same words here."), (5, "The same words here."), (6, "The same words here."),
            (None, "no id at all"), (None, None), (7, "x"), (8, "naïve café 漢字 😀 \x00 tab\tend"), (9, "<s> <|endoftext|> ▁ </s>")]
    return [(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]


@pytest.fixture
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def rng():
    return random.Random(7)
