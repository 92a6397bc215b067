from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, source[, lang]]) tuples, with columns whose names the operators use inside."""

    def make(*rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 1, "y") for r in rows]
        return spark.createDataFrame(full, DOC + ", row string, words long, host string").repartition(2)

    return make


@pytest.fixture
def many(documents):
    """Null, empty, blank, very long, repeated and odd texts."""
    long = "\n".join(f"Line {i} of a very long text with number {i * i} and more words." for i in range(4000))
    return documents(
        (1, None), (2, ""), (3, " \n\t "), (4, long, None), (5, "one"), (6, "one"), (6, "one"), (None, "null id here"), (8, "\x00 <|x|> ~1 [INST] é 漢字   a", "")
    )
