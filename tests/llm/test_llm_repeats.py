"""Operators 2 and 9 against brute force, also with all groups split."""

import hashlib
import random
import re

import pytest
import xxhash
from llm_fixtures import docs, make, no_docs, pairs, prose  # noqa: F401

from cohort_effects.llm import repeats
from cohort_effects.llm.op2_suffix import dedup_strings
from cohort_effects.llm.op9_substring import cut_passages, dedup_passages

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def order(pairs):
    """Distinct (id, text), a null id first, texts of one id by their hash."""
    key = lambda p: (p[0] is not None, p[0] or 0, xxhash.xxh64(p[1].encode(), seed=42).intdigest() ^ (1 << 63))
    return sorted({(i, t or "") for i, t in pairs}, key=key)


def removed_bytes(pairs, n=100):
    seen, out = set(), {}
    for i, t in order(pairs):
        b = t.encode()
        gone = [False] * len(b)
        for p in range(len(b) - n + 1):
            w = b[p : p + n]
            if w in seen:
                gone[p : p + n] = [True] * n
            seen.add(w)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i, t] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def removed_words(pairs, n=50):
    first, out = {}, {}
    for i, t in order(pairs):
        w = WORD.findall(t.encode())
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if first.setdefault(tuple(w[p : p + n]), i) != i:
                gone[p : p + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i, t] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(params=["whole groups", "split groups", "split, joined by shuffle"])
def groups(request, monkeypatch):
    if request.param == "split groups":
        monkeypatch.setattr(repeats, "HOT_UNITS", 2)
    if request.param == "split, joined by shuffle":
        monkeypatch.setattr(repeats, "HOT_UNITS", 2)
        monkeypatch.setattr(repeats, "HOT_BROADCAST", 0)


def expected(pairs, result):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    return sorted(((i, *result[i, t or ""]) for i, t in pairs), key=key), key


def test_bytes(docs, pairs, groups):
    want, key = expected(pairs, removed_bytes(pairs))
    assert sorted(map(tuple, dedup_strings(docs).collect()), key=key) == want
    assert sum(w[2] for w in want) > 0


def test_words(docs, pairs, groups):
    want, key = expected(pairs, removed_words(pairs))
    assert sorted(map(tuple, dedup_passages(docs).collect()), key=key) == want
    assert sum(w[2] for w in want) > 0


def test_cut_text_keeps_columns(docs, pairs):
    got = cut_passages(docs)
    assert got.columns == docs.columns + ["cut"]
    want = removed_words(pairs)
    texts = {(i, t or "") for i, t in pairs}
    for r in got.collect():
        if not r["cut"]:
            assert (r["doc_id"], r["text"]) in texts
        else:
            assert hashlib.sha256(r["text"].encode()).hexdigest() in {v[2] for k, v in want.items() if k[0] == r["doc_id"]}
    assert got.count() == len(pairs)


def twins(seed):
    """Two texts whose hashes agree modulo 32749."""
    seen = {}
    for k in range(100_000):
        text = f"head {seed} {k} " + prose(random.Random(k % 50 + 1000 * seed), 70)
        other = seen.setdefault(xxhash.xxh64(text.encode(), seed=42).intdigest() % 32749, text)
        if other != text:
            return other, text


def test_texts_that_share_an_id(spark):
    rng = random.Random(8)
    passage = prose(rng, 80)
    a, b = twins(1)
    rows = [(0, prose(rng, 5) + " " + passage), (5, a + " " + passage), (5, b + " " + passage + " tail"), (6, passage), (6, passage + " x")]
    rows += [(7, prose(rng, 60)) for _ in range(3)] + [(7, rows[1][1]), (7, rows[1][1])]
    for got, want in ((dedup_strings, removed_bytes), (dedup_passages, removed_words)):
        expect, key = expected(rows, want(rows))
        assert sorted(map(tuple, got(make(spark, rows)).collect()), key=key) == expect


def test_many_rows_without_an_id(spark):
    rng = random.Random(9)
    shared = [prose(rng, 55) for _ in range(40)]
    rows = [(None, f"{k} {prose(rng, 4)} {rng.choice(shared)} {k}") for k in range(2000)] + [(1, shared[0]), (2, "a " + shared[1])]
    for got, want in ((dedup_strings, removed_bytes), (dedup_passages, removed_words)):
        expect, key = expected(rows, want(rows))
        assert sorted(map(tuple, got(make(spark, rows)).collect()), key=key) == expect


def test_no_rows(no_docs):
    assert dedup_strings(no_docs).collect() == []
    assert dedup_passages(no_docs).collect() == []
