"""Small fixtures for the tests of the training-data operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text) or whole rows of the schema."""
    n = schema.count(",") + 1
    return spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], schema)


def sentences(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))
