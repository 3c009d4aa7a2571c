"""Substring dedup by seed and extend.

Seeds are winnowed 8-word anchors; documents meet on equal anchors
(``repeats``).  Inside a group every seed is extended word by word, to the left
and to the right: seeds stay in one class for as long as their extensions
agree.  A window of 50 words around a seed, l words before it and r after it,
equals another if both classes at l and r agree; so a window repeats if and
only if the extension reaches over all of it, and neighbouring repeated windows
make up the maximal repeats of 50 words or more.

Removed is what such a repeat covers if it also starts in a document with a
smaller id.  Edge cases: null text has no words; documents under 50 words lose
nothing; an empty table gives no rows; see ``repeats`` for repeated rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.repeats import NO_ID, Scheme, Symbols, covered, repeated_windows
from cohort_effects.llm.tables import read
from cohort_effects.llm.textarrays import ODD, U, mix, shingle_hashes, sliding_min, word_hashes, words

WINDOW, GRAM = 50, 8
SCHEME = Scheme(WINDOW, GRAM, by_word=True)


def _extend(word: np.ndarray, seed: np.ndarray, group: np.ndarray, step: int, reach: np.ndarray, most: int) -> np.ndarray:
    """Class of each seed after each number of words of extension up to its
    ``reach`` (seeds x most + 1)."""
    out = np.full((len(seed), most + 1), -1, np.int64)
    out[:, 0] = np.unique(group, return_inverse=True)[1]
    for n in range(1, most + 1):
        k = np.flatnonzero(reach >= n)
        if not len(k):
            break
        pair = out[k, n - 1].astype(U) * ODD[0] + mix(word[seed[k] + step * n])
        out[k, n] = np.unique(mix(pair), return_inverse=True)[1]
    return out


def seed_extend(buf: np.ndarray, off: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Class of each window of each span (a span has n + 49 words)."""
    starts, ends, doc = words(buf, off)
    h = word_hashes(buf, starts, ends, False)
    x, at = shingle_hashes(h, doc, GRAM)
    gram = np.full(max(0, len(h) - GRAM + 1), np.iinfo(np.uint64).max, U)
    gram[at] = x
    span = n + WINDOW - 1
    window = np.arange(int(n.sum())) + np.repeat((np.cumsum(span) - span) - (np.cumsum(n) - n), n)
    least = sliding_min(gram, WINDOW - GRAM + 1)[window]
    # the seed of a window is the first gram inside it that has its anchor
    here = np.where(gram == np.repeat(least[np.cumsum(n) - n], span)[: len(gram)], np.arange(len(gram)), len(gram))
    following = np.minimum.accumulate(here[::-1])[::-1]
    seed_of = following[window]
    seeds, which = np.unique(seed_of, return_inverse=True)
    before = seed_of - window
    after = WINDOW - GRAM - before
    left, right = np.zeros(len(seeds), np.int64), np.zeros(len(seeds), np.int64)
    np.maximum.at(left, which, before)
    np.maximum.at(right, which, after)
    owner = group[np.searchsorted(np.cumsum(span), seeds, side="right")]
    most = WINDOW - GRAM
    a = _extend(h, seeds, owner, -1, left, most)
    b = _extend(h, seeds + GRAM - 1, owner, 1, right, most)
    key = a[which, before].astype(U) * ODD[1] + mix(b[which, after].astype(U) * ODD[2] + before.astype(U))
    return np.unique(mix(key), return_inverse=True)[1]


def _digest(rows: pa.RecordBatch, copies: np.ndarray, buf: np.ndarray, off: np.ndarray, s: Symbols, removed: np.ndarray) -> pa.RecordBatch:
    gone = covered(removed, s.off, copies, WINDOW)
    sha, n_removed = [], []
    for a, b in zip(s.off[:-1].tolist(), s.off[1:].tolist(), strict=True):
        keep = np.flatnonzero(~gone[a:b]) + a
        kept = b" ".join([buf[x:y].tobytes() for x, y in zip(s.starts[keep].tolist(), s.ends[keep].tolist(), strict=True)])
        sha.append(hashlib.sha256(kept).hexdigest())
        n_removed.append(b - a - len(keep))
    return pa.RecordBatch.from_arrays(
        [rows.column("_id"), pa.array(np.diff(s.off)), pa.array(n_removed, pa.int64()), pa.array(sha)], names=["_id", "n_words", "n_removed", "kept_sha256"]
    )


def dedup_passages(docs: DataFrame) -> DataFrame:
    got = repeated_windows(docs, SCHEME, seed_extend, False, _digest, "_id long, n_words long, n_removed long, kept_sha256 string")
    return got.select(F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def _kept_text(rows: pa.RecordBatch, copies: np.ndarray, buf: np.ndarray, off: np.ndarray, s: Symbols, removed: np.ndarray) -> pa.RecordBatch:
    gone = covered(removed, s.off, copies, WINDOW)
    out, cut = [], []
    for a, b, p, q in zip(s.off[:-1].tolist(), s.off[1:].tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
        keep = np.flatnonzero(~gone[a:b]) + a
        cut.append(len(keep) < b - a)
        if not cut[-1]:
            out.append(buf[p:q].tobytes())
        else:
            out.append(b" ".join([buf[x:y].tobytes() for x, y in zip(s.starts[keep].tolist(), s.ends[keep].tolist(), strict=True)]))
    return pa.RecordBatch.from_arrays(
        [rows.column("_rest"), pa.array([x.decode("utf-8", "replace") for x in out], pa.string()), pa.array(cut, pa.bool_())], names=["_rest", "text", "cut"]
    )


def cut_passages(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with the repeats cut out of ``text`` (the words
    that stay are joined by a space) and whether any was ``cut``."""
    carry = [c for c in docs.columns if c != "text"]
    rest = docs.select(F.struct(*carry).alias("_rest")).schema["_rest"].dataType.simpleString()
    got = repeated_windows(docs, SCHEME, seed_extend, False, _kept_text, f"_rest {rest}, text string, cut boolean", tuple(carry))
    return got.select(*[F.col("text") if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns], "cut")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(read(spark, sf_dir, "documents"))
