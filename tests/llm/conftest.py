from __future__ import annotations

import random

import pytest
from conftest_llm import prose

#: Names that the operators use inside must not clash with a table's own.
CLASHING = ["id", "key", "n", "words", "lines", "spans", "shard", "slot", "bucket", "fp", "body", "blob", "path", "hash", "seq", "bin", "label", "kept", "n_words", "row"]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank texts, a very long one, ties, repeated rows."""
    rng = random.Random(3)
    long = "\n".join(prose(rng, 30) for _ in range(900))
    common = "\n".join(prose(random.Random(4), 12) for _ in range(4))
    rows = [(0, "", "en", "a"), (1, None, None, None), (2, " \t\n \r\n", "en", "a"), (3, long, "en", "b"), (4, common, "en", "b"), (5, common, "fr", "b"), (6, prose(rng, 40) + "\n" + common, "fr", None)]
    rows += [(7, prose(rng, 60), "de", "a")] * 3 + [(7, prose(rng, 50), "de", "a"), (None, prose(rng, 45), "de", "c"), (None, None, "de", "c")]
    rows += [(8, "one two", "en", "a"), (9, "é" * 40 + " ß 漢字 🙂 " + prose(rng, 20), "xx", "d"), (10, common + "\n" + common, "en", "b"), (11, "a b c d e f g h i j " * 30, "en", "a")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    names = ["doc_id", "text", "lang", "source"]
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string")
    return docs.selectExpr(*names, "cast(length(text) as long) as n_chars", *[f"'x' as `{c}`" for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
