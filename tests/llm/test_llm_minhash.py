"""Operator 8 against brute force, and its parts."""

import random
import re

import numpy as np
import pytest
from llm_fixtures import docs, no_docs, pairs  # noqa: F401

from cohort_effects.llm import op8_minhash as M
from cohort_effects.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(pairs, k):
    """(id, size of the set) -> smallest id reachable; rows of one id are one node."""
    rows = [(M.NO_ID if i is None else i, shingles(t, k)) for i, t in pairs]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(rows):
        for j, t in rows[:a]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in rows)


@pytest.fixture(params=["whole", "blocks"])
def sizes(request, monkeypatch):
    if request.param == "blocks":
        monkeypatch.setattr(M, "BUCKET", 3)
        monkeypatch.setattr(M, "GROUP", 4)


@pytest.mark.parametrize("k", [4, 5])
def test_components_of_near_duplicates(docs, pairs, sizes, k):
    want = brute(pairs, k)
    assert sorted(map(tuple, M.near_duplicates(docs, k).collect())) == want
    assert len({w[2] for w in want}) < len({w[0] for w in want}) - 10


def test_representatives(docs, pairs):
    got = M.representatives(docs)
    assert got.columns == docs.columns
    want = sorted({i for i, _, c in brute(pairs, 5) if i == c})
    assert sorted(M.NO_ID if r.doc_id is None else r.doc_id for r in got.collect()) == want


def test_no_rows(no_docs):
    assert M.near_duplicates(no_docs).collect() == []


def test_random_graphs(spark):
    rng = random.Random(2)
    for n, m in ((40, 30), (200, 260), (60, 59)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 59 else [(k, k + 1) for k in range(59)]
        parent = list(range(n))
        for a, b in edges:
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        want = {(x, root(x)) for e in edges if e[0] != e[1] for x in e}
        got = components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_estimate_is_close():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(x[:2000]), np.unique(x[200:2000]), np.unique(x[1000:])]
    begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
    _, sig = M._signatures(np.concatenate(sets), begin)
    sig = sig.view(np.uint64)
    assert abs(M.estimate(sig[0], sig[1]) - 0.9) < 0.12
    assert abs(M.estimate(sig[0], sig[2]) - 1 / 3) < 0.2
