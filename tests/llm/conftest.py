import os
from pathlib import Path

import pytest

# Python workers must find the package wherever the tests are started from.
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), *filter(None, [os.environ.get("PYTHONPATH")])])

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, _row string, n_words string, doc int, starts string, keys int, `a.b` int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with further columns of awkward names."""

    def make(pairs):
        rows = [(i, t, "en", "s", len(t or ""), 0.5, "r", "n", 1, "x", 2, 3) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty, blank and very long texts, repeated rows and shared passages."""
    passage = " ".join(f"word{i}" for i in range(30))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "One line that is shared by all of them\nand another"), (5, f"start {passage} end"),
        (5, f"start {passage} end"), (6, f"other {passage} text"), (None, f"no id {passage}"), (7, "x" * 200_000), (8, "ab cd " * 30_000),
        (9, "One line that is shared by all of them\r\nmore"), (10, "  ONE line that is shared by all of them"), (11, passage), (12, passage), (None, None),
        (13, "héé ☃ \x00 ünï"), (-4, "A"),
    ]
