import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, a very long text, odd characters and a column named like outputs."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "  \t\n ", None, None, 5), (4, "one", "en", None, 3),
        (5, "the same words here again and again for all of us", "en", "a", 1), (5, "the same words here again and again for all of us", "en", "a", 1),
        (6, "the same words here again and again for all of us", "de", "b", 1), (7, long_text, "en", "a", 1),
        (8, "x" * 3000, "en", "a", 1), (9, "café \U0001f600 naïve 你好  don't 123 á", "fr", "a", 1),
        (None, "no id here at all", "en", "a", 1), (10, "line one of the text\nline one of the text\n\nother", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty(df):
    return df.where("1 = 0")
