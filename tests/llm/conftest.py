import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table from (doc_id, text) pairs, with the driver's columns."""
    def make(rows, extra=""):
        data = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(data, DOCS)
    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic prose: prose(seed, n_words) in sentences, lines of four sentences."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        syllables = ["ra", "ne", "to", "mi", "sal", "ver", "ti", "on", "el", "ba", "cor", "du", "in", "est", "al"]
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
        out, k = [], 0
        while k < n:
            step = rng.randint(5, 11)
            out.append(" ".join(words[k:k + step]).capitalize() + ".")
            k += step
        return "\n".join(" ".join(out[i:i + 4]) for i in range(0, len(out), 4))
    return make
