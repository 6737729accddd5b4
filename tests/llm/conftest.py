import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Python workers import the operators by name
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


def sentence(rng, n, words="ab cd efg hi jkl mno pq rst uvw xyz alpha beta gamma delta".split()):
    return " ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(id, text) with nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(4)
    base = sentence(rng, 80)
    near = base.replace(base.split()[3], "changed1", 1)
    long = sentence(rng, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (6, near), (7, long), (7, long), (8, long + " end"),
        (None, base), (None, None), (9, "One"), (10, "one"), (11, "123 456!!"), (12, "ÉÀ 中文"), (2**60 + 1, base.upper()),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """``odd_rows`` with columns whose names the operators use themselves."""
    clash = "n int, n_words int, score double, shard int, part int, key string, label int, words string"
    rows = [(*r, 1, 2, 0.5, 3, 4, "k", 1, "w") for r in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {clash}").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
