import random

import pytest

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, hash string, key string, size int, block array<int>, name string, kept string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{min(int(rng.expovariate(0.01)), vocabulary)}x{rng.randrange(9)}" for _ in range(n))


@pytest.fixture(scope="session")
def edges():
    """Rows with nulls everywhere, empty and very long texts, ties, repeated rows, and clashing extra columns."""
    rng = random.Random(5)
    body, long = prose(rng, 120), prose(rng, 9000)
    texts = [(1, body), (2, body), (3, body + " tail"), (4, None), (5, ""), (5, ""), (6, "   "), (7, long), (8, long[:-40]),
             (None, prose(rng, 30)), (None, None), (9, "One"), (9, "One"), (9, "other text of the same id"), (10, "ünï ▁ \U0001f600 \x00\x01\x02" * 40),
             (11, "x" * 2000), (12, "x" * 1500 + "y")]
    texts += [(20 + i, prose(rng, rng.randrange(1, 90))) for i in range(20)]
    return [(i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None if n % 3 == 0 else len(t or ""),
             n, "h", None, n, [n], "n", None) for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark, edges):
    return spark.createDataFrame(edges, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
