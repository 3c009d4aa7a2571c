"""Operators 4, 5, 6: held-out accuracy and brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs, no_docs, pairs  # noqa: F401

from cohort_effects.llm import op5_ngram as N
from cohort_effects.llm import op6_langid as L
from cohort_effects.llm.op4_quality import accepted, classify, hinge_fit
from cohort_effects.llm.op5_ngram import score_documents
from cohort_effects.llm.op6_langid import identify
from cohort_effects.llm.textarrays import ODD

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def crc(i, m):
    return zlib.crc32(str(i).encode() if i is not None else b"") % m


def worded(spark, n=300):
    """Texts of one shape; only the words tell good (odd ids) from bad."""
    rng = random.Random(9)
    names = [a + b for a in ("ba", "ke", "li", "mo", "nu", "ze") for b in ("ran", "sti", "dog", "gel", "fur")]
    rows = [(i, " ".join(rng.choice(names[i % 2 :: 2]) for _ in range(40))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, quality int")


def test_quality_by_wording_alone(spark):
    got = [r for r in classify(*worded(spark)).collect() if r.held_out]
    assert len(got) > 30 and sum(r.predicted == r.doc_id % 2 for r in got) >= 0.97 * len(got)


def test_empty_texts_pass_whatever_the_bias(spark):
    docs, labels = worded(spark, 100)
    empty = spark.createDataFrame([(1000, None), (1001, ""), (None, None)], docs.schema)
    for quality in ("quality", "1 - quality"):
        some = labels.where("doc_id % 2 = 1 or doc_id < 30").selectExpr("doc_id", f"{quality} AS quality")
        got = [r.doc_id for r in accepted(docs.union(empty), some).collect() if not r.text]
        assert sorted(got, key=str) == [1000, 1001, None]


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert len(got) == docs.count()
    marked = [(got[r.doc_id], r.quality) for r in labels.collect()]
    assert all(g.held_out == (crc(g.doc_id, 5) == 0) and 0 <= g.score <= 1 and g.predicted == (g.score >= 0.3) for g in got.values())
    held = [(g, q) for g, q in marked if g.held_out]
    assert sum(g.predicted == q for g, q in held) / len(held) >= 0.97
    kept = accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, g in got.items() if g.predicted}


def test_quality_edge_cases(spark, docs, pairs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in classify(docs, none).collect()} == {(1.0, 1)}
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (63, 0, 0), (3, 1, 0), (3, 1, 1), (4, 1, 0)], none.schema)
    rows = classify(docs, odd).collect()
    assert len(rows) == len(pairs) and all(r.score is not None for r in rows)
    assert classify(no_docs, odd).collect() == []


def test_hinge_separates():
    rng = np.random.default_rng(1)
    rows = [rng.choice(30, 6, replace=False) for _ in range(200)]
    y = np.array([1.0 if 3 in r or 7 in r else -1.0 for r in rows])
    w, b = hinge_fit(rows, y, np.ones(30))
    assert np.mean([np.sign(w[r].sum() / np.sqrt(7) + b / np.sqrt(7)) == t for r, t in zip(rows, y, strict=True)]) > 0.95


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count() and all(g.held_out == (crc(g.doc_id, 4) == 2) for g in got)
    held = [g for g in got if g.held_out]
    assert sum(g.lang == g.lang_pred for g in held) / len(held) >= 0.97


def test_language_edge_cases(spark, docs, no_docs):
    got = {r.doc_id: r for r in identify(docs).collect()}
    for i in (60, 61, 62):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[66].lang_pred == "en"
    assert identify(no_docs).collect() == []
    unknown = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in identify(unknown).collect()] == [(1, crc(1, 4) == 2, "und", 0.0)]


def plain_grams(text):
    """Buckets of a text's n-grams with a letter, one by one."""
    low = [0] + [ord(c.lower()[0]) if ord(c) < 1 << 16 and c.isalpha() else 0 if ord(c) < 1 << 16 else ord(c) for c in text] + [0]
    out = Counter()
    for n in L.ORDERS:
        for at in range(len(low) - n + 1):
            h = sum(c * int(ODD[20 * n + j]) for j, c in enumerate(low[at : at + n])) % 2**64
            h ^= h >> 31
            out[(h * int(ODD[20 * n + 19]) % 2**64) >> (64 - 15)] += 1
    return out


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 18])
def test_every_ngram_is_counted_once(monkeypatch, chunk):
    monkeypatch.setattr(L, "_CHUNK", chunk)
    texts = ["", "a", "Été! über 12 x", "word " * 40, "語𝒜 b", "Z" * 33]
    got = [Counter() for _ in texts]
    for row, g in L.ngrams(texts, chunk):
        for r, x in zip(row.tolist(), g.tolist(), strict=True):
            got[r][x] += 1
    assert got == [plain_grams(t) for t in texts]


def test_language_model_against_plain_recomputation(spark):
    rng = np.random.default_rng(3)
    letters = {"aa": "abcde ", "bb": "cdefg ", "cc": "xyzab "}
    rows = []
    for k in range(60):
        lang = ["aa", "bb", "cc", None][k % 4]
        rows.append((k, "".join(rng.choice(list(letters.get(lang, "abxg "))) for _ in range(30 + k)), lang))
    rows += [(60, "abc xyz " * 40_000, "aa"), (61, "cdefg xyz " * 30_000, None), (62, None, "bb"), (63, "", "cc")]  # longer than a run
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    grams = {i: plain_grams(t or "") if len(t or "") < 1000 else None for i, t, _ in rows}
    for i, unit, times in ((60, "abc xyz ", 40_000), (61, "cdefg xyz ", 30_000)):  # n-grams of a repeated unit
        few, more = plain_grams(unit * 3), plain_grams(unit * 4)
        grams[i] = Counter({g: few[g] + (more[g] - few[g]) * (times - 3) for g in more})
    learned = [(i, lang) for i, _, lang in rows if lang is not None and crc(i, 4) != 2]
    names = sorted({lang for _, lang in learned})
    logp, prior = {}, {}
    for lang in names:
        n = np.full(L.BUCKETS, L.SMOOTHING)
        for i, other in learned:
            if other == lang:
                for g, c in grams[i].items():
                    n[g] += c * (g > 0)
        logp[lang] = np.log(n) - np.log(n.sum())
        prior[lang] = np.log(sum(other == lang for _, other in learned) + 1)
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        total = np.array([prior[x] + sum(c * logp[x][g] for g, c in grams[i].items() if g) for x in names])
        assert got[i].lang_pred == names[int(total.argmax())]
        assert abs(got[i].score - 1 / np.exp(total - total.max()).sum()) < 1e-3


def brute_lm(pairs):
    rows = [(i, [w.lower() for w in WORD.findall((t or "").encode())] + [None]) for i, t in pairs]
    count, two = Counter(), Counter()
    for i, w in rows:
        if crc(i, 7) != 2:
            count.update(w)
            two.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v = sum(count.values()), len(count)
    share = 1 - sum(c == 1 for c in two.values()) / n
    out = []
    for i, w in rows:
        base = [(count[x] + 1) / (n + v + 1) for x in w]
        p = []
        for c, x, b in zip(["<s>", *w[:-1]], w, base, strict=True):
            before = count[None] if c == "<s>" else count[c]
            p.append(share * two[c, x] / before + (1 - share) * b if before else b)
        out.append((i, crc(i, 7) == 2, len(w), sum(count[x] > 0 for x in w), n, sum(map(math.log10, base)), sum(map(math.log10, p))))
    return out


def test_lm_against_brute_force(docs, pairs):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    want = sorted(brute_lm(pairs), key=key)
    for size in (1 << 24, 1 << 17):
        got = sorted(map(tuple, score_documents(docs, block_bytes=size).collect()), key=key)
        assert len(got) == len(want)
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5]
            assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
            assert abs(g[6] - w[6]) <= 0.04 * w[2] + 1e-9  # quantised counts are at most 9 % low


def test_lm_no_rows(no_docs):
    assert score_documents(no_docs).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 5000), max_size=200), st.integers(5001, 100_000))
def test_elias_fano(values, universe):
    v = np.array(sorted(values), np.uint64)
    ef = N.EliasFano(v, universe, lambda a: a)
    ask = np.arange(min(universe, 5002), dtype=np.uint64)
    at = {int(x): k for k, x in enumerate(v)}
    assert ef.find(ask).tolist() == [at.get(x, -1) for x in ask.tolist()]
    assert (ef[np.arange(len(v))] == v).all()


def test_trie_round_trip():
    rng = np.random.default_rng(9)
    keys = np.unique((rng.integers(0, 50, 3000).astype(np.uint64) << np.uint64(32)) | rng.integers(0, 2**32, 3000).astype(np.uint64))
    counts = rng.integers(1, 10_000, len(keys))
    trie = N.Trie(keys[::2], counts[::2])
    codes = trie.codes_of(keys)
    assert (codes[1::2] == 0).all()
    got = N._LEVELS[codes[::2]]
    assert (got <= counts[::2]).all() and (got >= 0.9 * counts[::2]).all()
    small = counts[::2] <= 64
    assert (got[small] == counts[::2][small]).all()
