"""Quality classifier: naive Bayes support vectors.

Features are n-gram indicators: runs of one to four character classes (upper
and lower case, digits, blanks, each punctuation mark for itself), and n-grams
of word shapes, of repeats (this word equals the one before, the one two back,
...) and of how common a shape or repeat is in the text, hashed to ``SHAPES``
buckets; and the words themselves, alone and in pairs of neighbours (A-Z read as
a-z), hashed to ``WORDS`` buckets of their own.  Each indicator is scaled by the log ratio of its smoothed document counts in
the two classes; a linear model with hinge loss is then fitted to the scaled
indicators by dual coordinate descent.

Counts cover all labelled rows outside the held-out fold.  The hinge model is
fitted to at most ``FIT_ROWS`` of those rows (a documented bound: all of a class
up to half of it, else those whose id hashes lowest), in one task; the model, two
floats a bucket, is broadcast.

Scores are 1 / (1 + exp(-SLOPE * margin)), shifted so that margin 0 scores the
threshold 0.3.  Edge cases: null and empty texts are scored like any text
(without n-grams: the bias); labels without a document, null labels and repeated
labels with both values are not learned from (rows repeated alike count once);
without labels of both classes all rows score 1 (nothing is rejected).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.tables import held_out, lean, materialise, read
from cohort_effects.llm.textarrays import ODD, U, chunks, mix, word_hashes, words

SHAPES, WORDS = 1 << 16, 1 << 18
BUCKETS = SHAPES + WORDS
FIT_ROWS = 20_000
LABELS = 1 << 19
THRESHOLD = 0.3
SLOPE = 4.0
C = 1.0
SMOOTHING = 1.0
EPOCHS = 30
PIECE = 1 << 18  # bytes of text that are made into indicators at once


def _byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte: lower, upper, digit, blank, other letters'
    bytes, each ASCII mark for itself."""
    out = np.arange(256, dtype=np.uint64)
    out[ord("a") : ord("z") + 1] = ord("a")
    out[ord("A") : ord("Z") + 1] = ord("A")
    out[ord("0") : ord("9") + 1] = ord("0")
    out[128:] = ord("a")
    return out


_CLASS = _byte_classes()


def _gram(kind: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind, U) * ODD[400]
    for j, x in enumerate(parts):
        h = h + x.astype(U) * ODD[401 + j]
    return (mix(h) >> U(48)).astype(np.int64)


def _word_gram(kind: int, *parts: np.ndarray) -> np.ndarray:
    """Bucket of words or pairs of words, given their hashes."""
    h = np.full(len(parts[0]), kind, U) * ODD[400]
    for j, x in enumerate(parts):
        h = h + x * ODD[401 + j]
    return SHAPES + (mix(h) >> U(46)).astype(np.int64)


def indicators(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) pairs of a chunk, each once, in order."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    pairs = []

    def add(d: np.ndarray, g: np.ndarray) -> None:
        pairs.append(np.unique(d * BUCKETS + g))

    c = _CLASS[buf]
    run = c.copy()  # runs of one class count once, so length does not make new n-grams
    keep = np.ones(len(c), bool)
    keep[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    c, d = c[keep], doc[keep]
    for n in range(1, 5):
        size = len(c) - n + 1
        if size > 0:
            same = d[:size] == d[n - 1 :]
            add(d[:size][same], _gram(n, *[c[j : j + size][same] for j in range(n)]))
    starts, ends, wd = words(buf, off)
    if len(starts):
        h = word_hashes(buf, starts, ends, True)
        per_doc = np.bincount(wd, minlength=len(off) - 1)
        # share of words that equal the word k before, and of each last mark, in steps of a factor of two
        def share(kind: int, key: np.ndarray, at: np.ndarray) -> None:
            cell, n = np.unique(at * 256 + key, return_counts=True)
            level = np.floor(np.log2(n / per_doc[cell // 256])).clip(-8).astype(np.int64) + 8
            add(cell // 256, _gram(kind, cell % 256, level))

        for back in (1, 2, 3, 4, 8):
            if len(h) > back:
                again = np.flatnonzero((h[back:] == h[:-back]) & (wd[back:] == wd[:-back]))
                share(10 + back, np.zeros(len(again), np.int64), wd[back:][again])
        last = _CLASS[buf[ends - 1]].astype(np.int64)
        share(20, last, wd)
        first = _CLASS[buf[starts]].astype(np.int64)
        share(21, first, wd)
        upper = (buf[starts] >= 65) & (buf[starts] <= 90) & (ends - starts > 1)
        upper &= (buf[np.minimum(starts + 1, len(buf) - 1)] >= 65) & (buf[np.minimum(starts + 1, len(buf) - 1)] <= 90)
        share(22, upper.astype(np.int64), wd)
        # word shapes: first class, last class; pairs of neighbours
        shape = first * 256 + last
        add(wd, _gram(30, shape))
        if len(shape) > 1:
            two = wd[1:] == wd[:-1]
            add(wd[1:][two], _gram(31, shape[:-1][two], shape[1:][two]))
            add(wd[1:][two], _word_gram(41, h[:-1][two], h[1:][two]))
        add(wd, _word_gram(40, h))
    got = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return got // BUCKETS, got % BUCKETS


def featured(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``label`` and the sorted buckets of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch, limit=PIECE):
                d, g = indicators(buf, off)
                at = np.searchsorted(d, np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(g.astype(np.int32)))
                ids, labels = (batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "label"))
                yield pa.RecordBatch.from_arrays([ids, labels, lists], names=["doc_id", "label", "buckets"])

    return rows.select("doc_id", "label", "text").mapInArrow(lean(run), "doc_id long, label int, buckets array<int>")


def class_counts(rows: DataFrame) -> np.ndarray:
    """Rows of each class (0, 1) with each bucket; every task sums its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(2 * BUCKETS, np.int64)
        for batch in batches:
            labels = batch.column("label").to_numpy().astype(np.int64)
            for lo, hi, buf, off in chunks(batch, limit=PIECE):
                d, g = indicators(buf, off)
                n += np.bincount(labels[lo:hi][d] * BUCKETS + g, minlength=len(n))
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], names=["key", "n"])

    got = rows.select("label", "text").mapInArrow(lean(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * BUCKETS)
    out[got["key"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(2, BUCKETS)


def hinge_fit(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss with an L2 penalty; the rows
    are scaled indicators of unit length, the bias is one more feature."""
    w, bias = np.zeros(len(scale)), 0.0
    unit = np.array([1 / np.sqrt(scale[r] @ scale[r] + 1) for r in rows])
    alpha = np.zeros(len(rows))
    cost = C * len(y) / (2 * np.array([max(1, (y < 0).sum()), max(1, (y > 0).sum())]))
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        most = 0.0
        for i in rng.permutation(len(rows)).tolist():
            r = rows[i]
            v = scale[r] * unit[i]
            step = 1 - y[i] * (v @ w[r] + bias * unit[i])
            new = min(max(alpha[i] + step, 0.0), cost[int(y[i] > 0)])
            if new != alpha[i]:
                w[r] += (new - alpha[i]) * y[i] * v
                bias += (new - alpha[i]) * y[i] * unit[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w, float(bias)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(scale, weights, bias) from ``docs`` with one undisputed label, or None.
    No text is moved: labels go to the texts in blocks of about ``LABELS``, one
    after the other, and the rows the hinge model sees are found by their ids."""
    docs, one = docs.where(F.col("doc_id").isNotNull()), materialise(undisputed(labels))
    marked = materialise(docs.select("doc_id").join(one, "doc_id"))
    totals = {r.label: r.n for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    n, blocks = np.zeros((2, BUCKETS)), -(-one.count() // LABELS)
    for block in range(blocks):
        mine = one.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(blocks)) == block)
        n += class_counts(docs.join(F.broadcast(mine), "doc_id"))
    scale = np.zeros(BUCKETS)
    for part in (slice(0, SHAPES), slice(SHAPES, BUCKETS)):  # words do not shift the share of a shape
        p, q = n[1, part] + SMOOTHING, n[0, part] + SMOOTHING
        seen = n[:, part].sum(axis=0) > 0
        scale[part][seen] = (np.log(p / p[seen].sum()) - np.log(q / q[seen].sum()))[seen]
    half, sample = FIT_ROWS // 2, None
    for label, total in sorted(totals.items()):
        share = 1.0 if total <= half else 0.95 * half / total
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
        ids = marked.where((F.col("label") == label) & drawn).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(half)
        rows = featured(docs.join(F.broadcast(ids), "doc_id"))  # an id may stand in many rows
        rows = rows.orderBy(F.xxhash64("doc_id", "buckets"), "doc_id").limit(half)
        sample = rows if sample is None else sample.unionByName(rows)
    w, bias = np.zeros(BUCKETS), 0.0
    for r in fitted(sample, scale).toArrow().to_batches():
        at, values = r.column("bucket").to_numpy(), r.column("weight").to_numpy()
        w[at[at >= 0]] = values[at >= 0]
        bias += float(values[at < 0].sum())
    return scale, w, bias


def fitted(sample: DataFrame, scale: np.ndarray) -> DataFrame:
    """``bucket`` (-1: the bias) and ``weight`` of the hinge model of at most
    ``FIT_ROWS`` rows of ``featured``, fitted in one task; the driver sees the
    weights only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, labels = [], []
        for batch in batches:
            col = batch.column("buckets")
            flat, at = pc.list_flatten(col).to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(col).to_numpy())])
            lists += [flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
            labels.append(batch.column("label").to_numpy())
        if lists:
            w, bias = hinge_fit(lists, np.concatenate(labels) * 2.0 - 1, scale)
            there = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(there, -1)), pa.array(np.append(w[there], bias))], names=["bucket", "weight"])

    one = sample.repartition(1).sortWithinPartitions("doc_id", F.xxhash64("buckets"))
    return one.mapInArrow(lean(run), "bucket long, weight double")


def scores(model: tuple[np.ndarray, np.ndarray, float] | None, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Score of each document of a chunk."""
    docs = len(off) - 1
    if model is None:
        return np.ones(docs)
    scale, w, bias = model
    d, g = indicators(buf, off)
    dot = np.bincount(d, (scale * w)[g], docs) + bias
    norm = np.sqrt(np.bincount(d, (scale * scale)[g], docs) + 1)
    return 1 / (1 + np.exp(-(SLOPE * dot / norm + np.log(THRESHOLD / (1 - THRESHOLD)))))


def score(rows: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` of every row's whole text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch, limit=PIECE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(scores(shared.value, buf, off))],
                    names=["doc_id", "held_out", "score"],
                )

    return rows.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(lean(run), "doc_id long, held_out boolean, score double")


def undisputed(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``label`` of the ids with one undisputed label."""
    return (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
        .where(F.col("label") == F.col("_most"))
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Learns from the labelled rows outside the held-out fold, scores all."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
    )
    model = fit(rows.where(~F.col("held_out")).select("doc_id", "text"), labels)
    return score(rows, model).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject;
    they are filtered where they are read.  Null and empty texts stay."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = fit(rows.where(~held_out(F.col("doc_id"), folds, fold)), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch, limit=PIECE):
                yield batch.slice(lo, hi - lo).filter(pa.array((scores(shared.value, buf, off) >= THRESHOLD) | (np.diff(off) == 0)))

    return docs.mapInArrow(lean(run), docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
