"""The toxicity index gathers a bounded number of entries at a time."""

import numpy as np

from tidewatch.llm import toxicity as X


def test_a_search_in_groups_finds_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    n, terms = 300, 2000

    def some():
        return np.unique((terms * rng.random(80) ** 2).astype(np.int64))

    rows = [some() for _ in range(n)]
    example, term = np.repeat(np.arange(n), [len(r) for r in rows]), np.concatenate(rows)
    index = X.BlockMaxIndex(example, term, rng.random(len(term)), rng.integers(0, 2, n), np.arange(n), terms, common=100, block=16)
    queries = [(at, rng.random(len(at))) for at in [*rows[:40], np.zeros(0, np.int64), some()]]
    but = np.array([*range(40), 0, 0])
    whole = index.search(queries, 5, but)
    sizes, short = [], index._short
    monkeypatch.setattr(X, "_POSTINGS", 1500)
    monkeypatch.setattr(index, "_short", lambda part: sizes.append(sum(index._entries(at)[1].sum() for at, _ in part)) or short(part))
    parts = index.search(queries, 5, but)
    assert len(sizes) > 5 and max(sizes) <= 1500
    for (a, x), (b, y) in zip(whole, parts, strict=True):
        assert a.tolist() == b.tolist() and np.array_equal(x, y)
