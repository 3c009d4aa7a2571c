"""Spelling variant grouping by pivotal grams.

Words within one edit (a code point inserted, deleted or replaced) of each other
are found without comparing all words.  Bigrams are ordered, rarest first.  A
word's *prefix* is its three rarest bigrams (with all that tie with the third);
its *pivots* are two disjoint bigrams of the prefix with the least frequency in
sum, chosen by dynamic programming over positions.  One edit breaks at most one
pivot.  Of two near words, the pivots of the one whose prefix ends rarer stand,
as far as they are unbroken, in the prefix of the other.

Position limits: an edit lies right of the left pivot or left of the right
pivot.  Right of the left pivot, everything up to that pivot is equal and at the
same position; left of the right pivot, everything from there on is equal, at a
position that differs by the difference in length.  What remains on the edit's
side is halved, and one half is equal as well.  The index holds, for every word
and prefix bigram, the equal part with either half and its position and length;
a word's pivots ask for each of the three lengths a near word can have.  So a
group of the join shares about half of a word and not a bigram alone.  Hits are
verified by their edit distance.

Words come from the whole texts; occurrences are counted with partial sums, so
frequent words are one row a task.  Groups of the join hold distinct words only
(copies of a document add none); those over ``HOT`` words are dealt to blocks by
a hash of the word, each asked once.  What is broadcast: the counts of 65,536
bigram codes.

Forms are followed to their end by pointer doubling (a form is at least ten
times as frequent, so there are no cycles and the depth is a logarithm).

Edge cases: null and empty texts have no words; a null id counts as the empty
text in the hash; words under ``least_chars`` are left out; ties between forms
go to the smallest in code-point order; repeated rows are rows; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.tables import materialise, read

CODES = 1 << 16  # a bigram's code: exact for code points under 256, else equal bigrams have equal codes
HOT = 4096


def slipped_words(docs: DataFrame, least_chars: int = 7, every: int = 31) -> DataFrame:
    """``word`` and ``n``, its occurrences in the whole texts: runs of letters, A-Z
    in lower case, one code point deleted where ``every`` divides the crc32 of
    ``<doc_id>:<run>``."""
    run = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{least_chars},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    lowered = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", ascii_uppercase, ascii_lowercase))
    runs = runs.select("id", lowered.alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    k = F.expr("cast(h % char_length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), k), F.substring("run", k + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))


def _codes(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the words of each length: their rows and the codes of their bigrams."""
    text = np.array(words.to_pylist(), dtype=str)
    points = np.char.str_len(text)
    for length in np.unique(points).tolist():
        rows = np.flatnonzero(points == length)
        at = np.ascontiguousarray(text[rows].astype(f"<U{length}")).view(np.uint32).reshape(len(rows), length).astype(np.int64)
        yield rows, (at[:, :-1] * 256 + at[:, 1:]) % CODES


def gram_counts(words: DataFrame) -> np.ndarray:
    """Words' bigrams of each code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(CODES, np.int64)
        for batch in batches:
            for _, codes in _codes(batch.column(0)):
                n += np.bincount(codes.ravel(), minlength=CODES)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], names=["code", "n"])

    got = words.select("word").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CODES, np.int64)
    out[got["code"].to_numpy()] = got["n"].to_numpy()
    return out


def pivots(codes: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length (rows of bigram codes): which bigrams are in the
    prefix, and the positions of the left and the right pivot."""
    rank = order[codes]
    prefix = rank <= np.partition(rank, 2, axis=1)[:, 2:3]
    cost = np.where(prefix, counts[codes].astype(float), np.inf)
    # best single bigram up to each position, then best pair that ends there
    best, where = cost[:, 0].copy(), np.zeros(len(cost), np.int64)
    total, left, right = np.full(len(cost), np.inf), np.zeros(len(cost), np.int64), np.zeros(len(cost), np.int64)
    for j in range(2, cost.shape[1]):
        better = cost[:, j - 2] < best
        best[better], where[better] = cost[better, j - 2], j - 2
        pair = best + cost[:, j]
        better = pair < total
        total[better], left[better], right[better] = pair[better], where[better], j
    return prefix, left, right


def with_pivots(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """``word``, ``prefix`` (positions), ``a`` and ``b`` (pivots)."""
    order = np.empty(CODES, np.int64)
    order[np.argsort(counts, kind="stable")] = np.arange(CODES)
    shared = words.sparkSession.sparkContext.broadcast((counts, order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(0)
            for rows, codes in _codes(col):
                prefix, a, b = pivots(codes, *shared.value)
                _, at = np.nonzero(prefix)
                off = np.concatenate([[0], np.cumsum(prefix.sum(axis=1))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(off), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [col.take(pa.array(rows)), lists, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["word", "prefix", "a", "b"]
                )

    return words.select("word").mapInArrow(run, "word string, prefix array<int>, a int, b int")


def _part(start: Column, length: Column) -> Column:
    """``length`` code points of the word from ``start`` (from 0)."""
    return F.substring("word", (start + 1).cast("int"), length.cast("int"))


def _keys(at: Column, length: Column, shift: Column | int, side: str) -> list[Column]:
    """Keys of a bigram that stands at ``at`` in a word of ``length``, as a word
    shows them whose code points beyond the edit are ``shift`` places earlier.

    ``right``: all up to the bigram's end is equal, and what follows is halved at
    ``cut``; ``left``: all from the bigram on is equal (in this word from
    ``at - shift``), and what stands before is halved."""
    own = F.char_length("word")
    if side == "right":
        cut = (at + 2 + F.floor((length - at - 2) / 2)).cast("int")
        return [
            F.xxhash64(F.lit(0), _part(F.lit(0), cut), at, length),
            F.when(cut - shift >= at + 2, F.xxhash64(F.lit(1), _part(F.lit(0), at + 2), _part(cut - shift, own), at, length)),
        ]
    cut = F.floor(at / 2).cast("int")
    return [
        F.xxhash64(F.lit(2), _part(F.lit(0), cut), _part(at - shift, own), at),
        F.when(cut - shift >= 0, F.xxhash64(F.lit(3), _part(cut - shift, own), at)),
    ]


def near_words(words: DataFrame) -> DataFrame:
    """``word`` and ``near``, both ways, of distinct ``word``s of 4 code points
    or more that are one edit apart."""
    marked = with_pivots(words, gram_counts(words))
    length = F.char_length("word")
    index = marked.select("word", F.explode("prefix").alias("at")).select(
        "word", F.explode(F.array(*_keys(F.col("at"), length, 0, "right"), *_keys(F.col("at"), length, 0, "left"))).alias("key")
    )
    asked = []
    for shift in (-1, 0, 1):  # lengths of a near word
        asked += _keys(F.col("a"), length + shift, shift, "right")
        asked += _keys(F.col("b") + shift, length + shift, shift, "left")
    probe = marked.select("word", F.explode(F.array(*asked)).alias("key")).where("key is not null")
    hot = index.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > HOT).select("key", F.ceil(F.col("_n") / HOT).cast("int").alias("blocks"))
    hot = materialise(hot)
    if hot.isEmpty():
        met = probe.join(index.withColumnRenamed("word", "near"), "key")
    else:
        blocks = F.coalesce("blocks", F.lit(1))
        held = index.withColumnRenamed("word", "near").join(hot, "key", "left").withColumn("block", F.pmod(F.xxhash64("near"), blocks).cast("int"))
        asks = probe.join(hot, "key", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        met = asks.drop("blocks").join(held.drop("blocks"), ["key", "block"])
    # either word may be the one whose pivots ask
    pair = met.where((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    pair = pair.select(F.least("word", "near").alias("word"), F.greatest("word", "near").alias("near")).distinct()
    return pair.select(F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))).alias("x")).select("x.*")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of the chain of ``form``s, for the words
    that have one.  Each round doubles the steps taken."""
    at = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        moved = materialise(at.join(ahead, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def group_variants(vocabulary: DataFrame, least_chars: int = 7, least_n: int = 2, ratio: int = 10) -> DataFrame:
    """``word``, ``n`` with ``n_near``, ``form``, ``form_n`` and ``root``."""
    words = materialise(vocabulary.where((F.col("n") >= least_n) & (F.char_length("word") >= max(4, least_chars))).select("word", "n"))
    near = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("_form_n", -F.col("best.less"))
    form = F.col("_form_n") >= ratio * F.col("n")
    found = materialise(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(form, F.col("best.near")).alias("form"), F.when(form, F.col("_form_n")).alias("form_n"),
        )
    )
    return found.join(roots(found.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(slipped_words(read(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")
