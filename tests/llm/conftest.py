import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_helpers import sentence  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, h1 string, copy int,"
    " n_words string, carried int, marks string, fp string, kept int, failures string"
)


@pytest.fixture(scope="session")
def odd_rows():
    """(id, text): nulls, empties, ties, repeats, near copies, shared passages, a long text."""
    passage = sentence(1, 60)
    base = sentence(2, 200)
    rows = [
        (0, base), (1, base), (2, base.replace("w1", "w9", 1)), (3, None), (4, ""), (5, " \n\t "),
        (6, f"{sentence(3, 30)} {passage} {sentence(4, 30)}"), (7, f"{passage}\n{sentence(5, 50)}"),
        (8, f"Ünïcödé 日本 {passage}"), (9, passage), (9, passage), (10, f"{passage} {passage}"),
        (11, "ab" * 600), (12, "ab" * 500 + sentence(6, 40)), (13, "word"), (14, "Word"),
        (None, passage), (None, None), (15, sentence(7, 25)), (15, f"{sentence(8, 40)} {base}"),
        (16, sentence(9, 3000) + " " + passage), (17, "x" * 49), (18, "x" * 49), (19, "x" * 50),
        (20, "x" * 51), (-1, passage + " tail"), (21, "é" * 40 + "è" * 3), (22, "é" * 40 + "ê" * 3),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows):
    return spark.createDataFrame(
        [(k, t, "xx", None, None, "name", 1, "many", 2, "m", "f", 3, "no") for k, t in odd_rows], SCHEMA
    )


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def scratch(spark):
    from tidemark.llm.scratch import Scratch

    with Scratch(spark) as stage:
        yield stage
