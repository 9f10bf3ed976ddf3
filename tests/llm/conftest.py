from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, note string, shard int, score double"


@pytest.fixture
def frame(spark):
    """Documents with clashing extra columns from (doc_id, text[, lang[, source]]) rows."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *(None,) * (4 - len(row)))
            full.append((doc_id, text, lang, source, None if text is None else len(text), "kept", 7, 0.25))
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture
def prose():
    """Seeded invented text of n words."""

    def make(n, seed=0, letters="abcdefghij"):
        rnd = random.Random(seed)
        return " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 7))) for _ in range(n))

    return make
