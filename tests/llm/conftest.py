from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, label int"

LONG = " ".join(f"word{i} and more" for i in range(20_000)) + "\n" + "x" * 50_000


@pytest.fixture(scope="session")
def docs(spark):
    """Build documents from (doc_id, text[, lang, source]); more columns have clashing names."""

    def build(*rows):
        full = [(*r, *(None, "s")[len(r) - 2 :], 1, 2, "k", 3) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and long texts, ties and repeated rows."""
    return [
        (1, "the cat sat on the mat today", "en", "a"),
        (2, "the cat  sat on\tthe mat today", "en", None),
        (2, "the cat  sat on\tthe mat today", "en", None),
        (3, None, None, "b"),
        (4, "", "en", "b"),
        (5, " \n\t ", None, None),
        (None, "the cat sat on the mat today", "en", "a"),
        (None, None, None, None),
        (6, LONG, "en", "a"),
        (7, LONG, "en", "b"),
        (8, "12345 67890 --- !!!", "de", "b"),
        (9, "Straße über alles Größe für dich", "de", "c"),
    ]
