import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ta", "vi") for b in ("ben", "dor", "fal", "gim", "hup")]


@pytest.fixture
def prose():
    """prose(seed, n): n made-up words, the same for the same seed."""

    def make(seed, n):
        pick = random.Random(seed)
        return [pick.choice(WORDS) + pick.choice(("", "s", "ly", "ing")) for _ in range(n)]

    return make


@pytest.fixture
def texts(spark):
    """texts([...]): documents (doc_id, text) and columns whose names operators use inside."""

    def make(rows):
        rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, "kept", "src", -1) for i, t in rows],
            "doc_id long, text string, hash string, source string, size int",
        )

    return make
