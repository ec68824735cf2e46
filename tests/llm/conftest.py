import os

import pytest

from weekfold.session import ship_package

SMALL = "/root/testdata/sf0.001"
LONG = "the end of this long text is near and yet not here " * 3000


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, source): nulls, empty and very long texts, ties, repeated rows."""
    return [
        (1, "one two three four five six seven", "a"),
        (2, "one two three four five six seven", "a"),
        (2, "one two three four five six seven", "a"),  # a repeated row
        (3, None, "b"),
        (4, "", None),
        (None, "no id here", "b"),
        (None, None, None),
        (5, LONG, "c"),
        (6, LONG + "at last", "c"),
        (7, "One\ttwo THREE four five six seven", "a"),
        (7, "another text of the same id", "b"),  # an id with two texts
        (8, "   \n\t ", "a"),
        (9, "naïve 日本語 \U0001f600 <|endoftext|> x  y", "d"),
    ]


CLASHING = ("digest", "kept", "node", "component_id", "text_key", "size", "taken", "u", "row", "bucket", "score")


@pytest.fixture(scope="session")
def odd_docs(llm, odd_rows):
    """The rows above with extra columns named like those the operators use."""
    kinds = ", ".join(f"{c} string" for c in CLASHING)
    return llm.createDataFrame(
        [(*r, *("x" for _ in CLASHING)) for r in odd_rows], f"doc_id long, text string, source string, {kinds}"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small(llm):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL
