import random

import pytest


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text[, source]) tuples, with columns whose names clash with results."""
    def build(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for name in ("size", "spans", "fp", "n_words", "kept", "component_id", "n_tokens", "key", "block"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df
    return build
