from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Build a documents table from (doc_id, text) pairs."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], SCHEMA).repartition(3)

    return build


@pytest.fixture()
def odd_rows():
    """Nulls, empty, blank, long, repeated and tied rows."""
    long_text = " ".join(f"w{k % 977}" for k in range(30_000))
    return [(501, None), (502, ""), (503, " \n\t "), (504, "one two"), (504, "one two"), (None, "a null id here"),
            (505, long_text), (506, long_text), (507, "x" * 50_000), (508, "é ß 日本 😀 a@b.co +1 (234) 567-8901")]
