import random

import pytest

# Columns whose names the operators use themselves.
CLASH = ["k", "h", "key", "size", "rep", "kept", "class", "value", "seed", "n", "word", "label", "sums", "t"]


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    vowels, others = "aeiou", "bcdfglmnprst"
    return ["".join(rng.choice(others) + rng.choice(vowels) for _ in range(rng.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def prose(words):
    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(words) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def edge_docs(spark, prose):
    """NULLs, empty and blank texts, ties, repeated rows, a very long text, other alphabets, clashing columns."""
    near = prose(1, 300).split()
    far = near.copy()
    far[150] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, "One"), (6, "two words"), (6, "two words"), (7, prose(2, 60_000)),
        (8, " ".join(near)), (9, " ".join(far)), (10, " ".join(near).upper()), (11, "ünï 日本語 \U0001f600 \x00 \x1c x " * 40),
        (12, prose(3, 120)), (13, prose(3, 120)), (None, "no id"), (14, "!!! ### $$$"), (15, "a b c a b c a b c"),
    ]
    rows += [(100 + i, prose(50 + i, 80)) for i in range(20)]
    full = [(i, t, "en" if (i or 0) % 3 else None, None if (i or 0) % 5 == 0 else "s", *["x"] * len(CLASH)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
