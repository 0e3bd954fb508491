import hashlib

import pytest


@pytest.fixture
def docs(spark):
    """Rows of documents from (doc_id, text[, lang]) tuples, with columns that clash with the operators' own."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 1, 2, "x") for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, block int, fp long, state string"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def sha():
    return lambda data: hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture
def awkward():
    """Nulls, empty texts, spaces only, repeated rows, no id, one very long text."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
    same = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf at night"
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, same), (5, same), (6, same + " again"), (None, same), (None, None), (7, long), (8, "é ü 漢字 😀")]
