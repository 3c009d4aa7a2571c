"""Language identification by multinomial naive Bayes over hashed character
n-grams.

Every training text is counted whole, on the cluster: each task adds the
n-grams of its documents to a language x bucket table and hands on the cells it
filled; their sums (at most languages x ``BUCKETS`` rows) make the
log-probability matrix, which is broadcast (``BUCKETS`` floats a language).
Batches are scored at once: the n-grams of all their texts, as sparse counts,
times the matrix.  Long texts go through in runs that share no n-gram.

Characters are lower-cased; everything that is not a letter reads as one class
of blank.  n-grams run over the text including blanks, those of blanks only
carry no evidence.

Edge cases: null text or text without a letter gives ``und`` and score 0; rows
without a language are scored, not learned from; with no training rows every
answer is ``und``; ties go to the smaller language; the score is the posterior
probability of the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.tables import held_out, lean, read
from cohort_effects.llm.textarrays import ODD, U

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
MOST_LANGUAGES = 2000  # the matrix stays below 256 MB; more is an error, not a cut
_CHUNK = 1 << 18


def _classes() -> np.ndarray:
    """Lower-case code of each letter below 65536, 0 for all else."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low[0])
    return out


_CLASS: list[np.ndarray] = []


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """A text, with a blank at either end, in runs: (code points, how many of them
    n-grams start at).  A run looks ahead by the longest order less one, so each
    n-gram of the whole text starts in one run, however long the text is."""
    text, ahead = f" {text} ", max(ORDERS) - 1
    for at in range(0, len(text), _CHUNK):
        yield text[at : at + _CHUNK + ahead], min(_CHUNK, len(text) - at)


def ngrams(texts: list[str], limit: int = _CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram of a batch of texts, about ``limit`` code
    points at a time; bucket 0 has no letter in it."""
    if not _CLASS:
        _CLASS.append(_classes())
    held: list[tuple[int, str, int]] = []
    size = 0
    for row, text in enumerate(texts):
        for piece, own in _pieces(text):
            held.append((row, piece, own))
            size += len(piece)
            if size >= limit:
                yield from _grams(held)
                held, size = [], 0
    if held:
        yield from _grams(held)


def _grams(held: list[tuple[int, str, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    points = np.frombuffer("".join(p for _, p, _ in held).encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(points < 1 << 16, _CLASS[0][np.minimum(points, (1 << 16) - 1)], points).astype(U)
    length = np.array([len(p) for _, p, _ in held])
    first = np.cumsum(length) - length
    row = np.repeat([r for r, _, _ in held], length)
    at = np.arange(len(c)) - np.repeat(first, length)
    left = np.repeat(length, length) - at  # code points from here to the end of the run
    starts = at < np.repeat([own for _, _, own in held], length)
    shift = U(64 - (BUCKETS.bit_length() - 1))
    for n in ORDERS:
        size = len(c) - n + 1
        if size <= 0:
            return
        h = c[:size] * ODD[20 * n]
        for j in range(1, n):
            h += c[j : j + size] * ODD[20 * n + j]
        h ^= h >> U(31)
        h *= ODD[20 * n + 19]
        whole = starts[:size] & (left[:size] >= n)
        yield row[:size][whole], (h >> shift).astype(np.int64)[whole]


def counted(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of ``lang``, ``text``; bucket -1 holds
    the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            names, of = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            for k, lang in enumerate(names.tolist()):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                rows[lang] = rows.get(lang, 0) + int((of == k).sum())
            for row, g in ngrams(pc.fill_null(batch.column("text"), "").to_pylist()):
                for k in np.unique(of[row]).tolist():
                    sums[names[k]] += np.bincount(g[of[row] == k], minlength=BUCKETS)
        for lang, table in sums.items():
            there = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(there) + 1)), pa.array(np.append(there, -1).astype(np.int32)), pa.array(np.append(table[there], rows[lang]))],
                names=["lang", "bucket", "n"],
            )

    got = docs.select("lang", "text").mapInArrow(lean(count), "lang string, bucket int, n long")
    return got.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order and their log-probability matrix (languages x buckets)."""

    def __init__(self, rows: pa.Table):
        languages = sorted(set(rows["lang"].to_pylist()))
        if len(languages) > MOST_LANGUAGES:
            raise ValueError(f"{len(languages)} languages; the matrix is made for {MOST_LANGUAGES}")
        self.languages = languages
        index = {x: k for k, x in enumerate(languages)}
        lang = np.array([index[x] for x in rows["lang"].to_pylist()], np.int64)
        bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy().astype(float)
        counts = np.zeros((BUCKETS, len(languages)))
        cell = bucket >= 0
        counts[bucket[cell], lang[cell]] = n[cell]
        docs = np.zeros(len(languages))
        docs[lang[~cell]] = n[~cell]
        counts[0] = 0
        logp = np.log(counts + SMOOTHING) - np.log((counts + SMOOTHING).sum(axis=0))
        logp[0] = 0
        self.matrix = np.ascontiguousarray(logp.T.astype(np.float32))
        self.prior = np.log(docs + 1) - np.log((docs + 1).sum()) if languages else np.zeros(0)

    def scores(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text: the sparse n-gram counts of the
        batch times the matrix, a language at a time."""
        total = np.repeat(self.prior[None, :], len(texts), axis=0)
        for row, g in ngrams(texts):
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(row, self.matrix[k][g], len(texts))
        best = total.argmax(axis=1)
        p = np.exp(total - total[np.arange(len(texts)), best][:, None])
        return [self.languages[k] for k in best], 1 / p.sum(axis=1)


def fit(docs: DataFrame) -> Model:
    return Model(counted(docs.where(F.col("lang").isNotNull())).toArrow())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and the columns ``keep``s of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            lang, score = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            known = np.flatnonzero(batch.column("has_letter").to_numpy(zero_copy_only=False))
            if len(known) and m.languages:
                lang[known], score[known] = m.scores(batch.column("text").take(pa.array(known)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.withColumn("has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return rows.select("doc_id", "held_out", "text", "has_letter").mapInArrow(lean(run), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learns from the rows outside the held-out fold, scores all rows."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), held_out(F.col("doc_id"), folds, fold).alias("held_out"),
    )
    return predict(rows, fit(rows.where(~F.col("held_out"))))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
