"""Suffix-array dedup of 100-byte strings by bucket-pointer refinement.

Which strings can repeat at all is found by ``repeats`` (winnowed anchors, so
only repeated stretches are looked at).  Inside an anchor's group the suffixes
that start there are put into initial buckets by their first 25 bytes; a bucket
is refined by sorting on the bucket identifiers 25 bytes later, and the refined
identifiers are reused 50 bytes later, which orders suffixes to depth 100.
Equal identifiers are equal 100-byte strings; all but the first are removed.

Edge cases: null text is empty; texts under 100 bytes lose nothing; an empty
table gives no rows; see ``repeats`` for repeated rows and ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.repeats import NO_ID, Scheme, Symbols, byte_grams, covered, repeated_windows
from cohort_effects.llm.tables import read

WINDOW, GRAM = 100, 25
SCHEME = Scheme(WINDOW, GRAM, by_word=False)


def _buckets(key: np.ndarray) -> np.ndarray:
    """Identifier of each key's bucket, in sorted order."""
    return np.unique(key, return_inverse=True)[1]


def bucket_refine(buf: np.ndarray, off: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Depth-100 bucket of the first ``n`` suffixes of each span.  A span has
    n + 99 bytes, so every offset that is read lies inside it."""

    def places(extra: int) -> np.ndarray:
        size = n + extra
        begin = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(off[:-1] - begin, size)

    depth = GRAM
    at = places(WINDOW - depth)
    pointer = np.zeros(len(buf), np.int64)
    pointer[at] = _buckets(byte_grams(buf, depth)[at])
    while depth < WINDOW:
        at = places(WINDOW - 2 * depth)
        buckets = int(pointer.max(initial=0)) + 1
        pointer[at] = _buckets(pointer[at] * buckets + pointer[at + depth])
        depth *= 2
    return pointer[at]


def _digest(rows: pa.RecordBatch, copies: np.ndarray, buf: np.ndarray, off: np.ndarray, s: Symbols, removed: np.ndarray) -> pa.RecordBatch:
    gone = covered(removed, off, copies, WINDOW)
    total = np.concatenate([[0], np.cumsum(gone)])
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inner = off[1:-1][off[1:-1] < len(gone)]
    begins[inner] = gone[inner]
    spans = np.concatenate([[0], np.cumsum(begins)])
    sha = [
        hashlib.sha256(buf[a:b][~gone[a:b]].tobytes()).hexdigest() if total[b] > total[a] else hashlib.sha256(buf[a:b].tobytes()).hexdigest()
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [rows.column("_id"), pa.array(np.diff(off)), pa.array(np.diff(total[off])), pa.array(np.diff(spans[off])), pa.array(sha)],
        names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def dedup_strings(docs: DataFrame) -> DataFrame:
    got = repeated_windows(
        docs, SCHEME, bucket_refine, True, _digest, "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return got.select(F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_strings(read(spark, sf_dir, "documents"))
