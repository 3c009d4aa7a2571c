"""Operators 3 and 10."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs, no_docs, pairs  # noqa: F401

from cohort_effects.llm import op10_sharding as S
from cohort_effects.llm.op3_packing import pack_documents, plan, slots, tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1))
def test_plan_places_every_piece(histogram):
    patterns = plan(histogram, 64)
    used = Counter()
    for times, pattern in patterns:
        assert times > 0 and sum(a * k for a, k in pattern) <= 64
        for a, k in pattern:
            used[a] += times * k
    assert used == Counter(histogram)
    total = sum(a * n for a, n in histogram.items())
    first_fit, open_ = 0, []  # first-fit decreasing, for comparison
    for a in sorted(Counter(histogram).elements(), reverse=True):
        for k, gap in enumerate(open_):
            if gap >= a:
                open_[k] -= a
                break
        else:
            open_.append(64 - a)
    first_fit = len(open_)
    assert -(-total // 64) <= sum(t for t, _ in patterns) <= first_fit + 1
    ranks = defaultdict(list)
    for length, lo, hi, *_ in slots(patterns):
        ranks[length].append((lo, hi))
    for length, spans in ranks.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == histogram[length]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_packed_documents(docs, pairs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t in pairs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = pack_documents(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in rows) == want
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r["length"]))
    for spans in at.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(spans[-1]) <= 2048
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
    assert len(at) == -(-sum(r["length"] for r in rows) // 2048)


def least_capacity(sizes, shards):
    """Smallest capacity with which the order fits, a larger group alone."""
    def fits(cap):
        used, fill = 0, 0
        for x in sizes:
            if x > cap:
                used, fill = used + 1 + (fill > 0), 0
            elif fill + x > cap:
                used, fill = used + 1, x
            else:
                fill += x
        return used + (fill > 0) <= shards

    low, high = 1, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def test_cuts_are_minimax(spark):
    rng = np.random.default_rng(4)
    for n, shards in ((300, 7), (5, 9), (1000, 3)):
        h = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        size = rng.integers(16, 400, len(h))
        size[len(h) // 2] = 30_000 if n == 300 else 50
        groups = spark.createDataFrame([(int(a), int(b)) for a, b in zip(h, size, strict=True)], "h long, size long")
        cap, cuts = S.minimax_cuts(groups, shards)
        assert cap == least_capacity(size.tolist(), shards)
        load = np.bincount(np.searchsorted(np.array(cuts), h, side="left"), size)
        assert len(cuts) < shards and load.max() <= max(cap, size.max())


def test_sharded_documents(docs, pairs):
    rows = S.shard_documents(docs, 6).collect()
    key = lambda t: 42 if t is None else xxhash.xxh64(t.encode(), seed=42).intdigest()
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    sizes = Counter()
    for _, t in pairs:
        sizes[signed(key(t))] += len((t or "").encode()) + 16
    order = sorted(sizes)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs)
    load, slot, group = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        load[r.shard] += r["size"]
        slot[r.shard].append(r.slot)
        group[r.h].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slot.values())
    assert all(len(s) == 1 for s in group.values())
    cap = least_capacity([sizes[h] for h in order], 6)
    assert max(load.values()) <= max(cap, max(sizes.values())) and set(load) <= set(range(6))


def test_no_rows(no_docs):
    assert S.shard_documents(no_docs, 6).collect() == []
    assert pack_documents(no_docs).collect() == []


@pytest.mark.parametrize("text", ["It's 'tis we'll DON'T <|endoftext|> x²½ a\x0bb", "naïve ﬁ İstanbul ΣΑΣ", "!!'s ## 12 3a b­c"])
def test_word_cache_is_the_tokenizer(text):
    from tokenizers import Tokenizer

    from cohort_effects.llm.wordcache import WordCache

    ids = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert WordCache(tokenizer_path()).encode(text) == np.array(ids, "<u4").tobytes()
