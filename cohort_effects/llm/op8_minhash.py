"""MinHash near-dedup with b-bit signatures.

1. Each whole text becomes its set of distinct word shingles, 175 minima, and
   from those 35 band keys (of five whole minima) and a signature of the two low
   bits of each minimum.  A link of similarity 0.8 misses every band with a
   probability below 1e-6.
2. Texts with equal sets are one class from here on; its smallest id stands for
   it.
3. Classes meet on band keys.  In a bucket, similarity is estimated from equal
   signature positions, corrected for the quarter that agree by chance.  What
   reaches 0.6 (five and a half standard deviations below 0.8) is connected,
   by a spanning forest: a bucket of n members hands on fewer than n links.
4. Connected classes are verified on their full sets: in a group, a search
   from member to member joins those with 100 * intersection >= 80 * union and
   again hands on a spanning forest.  Its components are the result.

No bucket or group is cut off.  One over its size is split into blocks and
every pair of blocks is worked on by a task of its own, so all links are found
with bounded memory.

Edge cases: a text of fewer words than a shingle is one shingle; without words
a document is linked with nothing; a null id orders first; rows that share an
id are one document as far as links go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_effects.llm.components import components
from cohort_effects.llm.repeats import NO_ID
from cohort_effects.llm.tables import lean, materialise, read, texts
from cohort_effects.llm.textarrays import ODD, U, as_long, chunks, mix, shingle_hashes, whole_groups, word_hashes, words

BANDS, ROWS = 35, 5
HASHES = BANDS * ROWS
SIG_WORDS = -(-HASHES * 2 // 64)
LEAST_ESTIMATE = 0.6
BUCKET = 8192  # members of a bucket, or of one of its blocks
GROUP, GROUP_SHINGLES = 2048, 2_000_000  # the same for verification
_rng = np.random.default_rng(31337)
_FLIP = _rng.integers(0, 2**63, HASHES, dtype=np.int64).astype(U)
_TIMES = _rng.integers(1, 2**63, HASHES, dtype=np.int64).astype(U) * U(2) + U(1)


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) of a chunk: sorted, each pair once."""
    starts, ends, doc = words(buf, off)
    h = word_hashes(buf, starts, ends, True)
    x, at = shingle_hashes(h, doc, k)
    d = doc[at]
    n_words = np.bincount(doc, minlength=len(off) - 1)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):  # the whole sequence is the one shingle
        first = np.searchsorted(doc, short)
        y = n_words[short].astype(U) * ODD[200]
        for j in range(k - 1):
            has = n_words[short] > j
            y[has] += h[first[has] + j] * ODD[201 + j]
        x, d = np.concatenate([x, mix(y)]), np.concatenate([d, short])
    order = np.lexsort((x, d))
    x, d = x[order], d[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (d[1:] != d[:-1])
    return d[new], x[new]


def _signatures(x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, packed two-bit signatures) of sets that start at ``begin``."""
    least = np.empty((HASHES, len(begin)), U)
    for j in range(HASHES):
        least[j] = np.minimum.reduceat((x ^ _FLIP[j]) * _TIMES[j], begin)
    keys = np.empty((len(begin), BANDS), U)
    for b in range(BANDS):
        y = np.full(len(begin), b, U) * ODD[220]
        for j in range(ROWS):
            y += mix(least[b * ROWS + j]) * ODD[221 + j]
        keys[:, b] = mix(y)
    low = mix(least.T)
    bits = np.zeros((len(begin), SIG_WORDS * 64), np.uint8)
    bits[:, 0 : 2 * HASHES : 2], bits[:, 1 : 2 * HASHES : 2] = low & U(1), (low >> U(1)) & U(1)
    return keys, np.packbits(bits, axis=1)


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """``id``, size and hash of the shingle set, signature and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch):
                d, x = shingle_sets(buf, off, k)
                n = np.bincount(d, minlength=hi - lo)
                full = np.flatnonzero(n)
                begin = np.searchsorted(d, full)
                a, b = np.zeros(hi - lo, U), np.zeros(hi - lo, U)
                keys, sig = np.zeros((0, BANDS), U), np.zeros((0, SIG_WORDS * 8), np.uint8)
                if len(full):
                    keys, sig = _signatures(x, begin)
                    a[full], b[full] = np.add.reduceat(mix(x * ODD[230]), begin), np.add.reduceat(mix(x * ODD[231]), begin)
                place = np.cumsum(n > 0) - 1
                sigs = [sig[p].tobytes() if m else None for p, m in zip(place.tolist(), (n > 0).tolist(), strict=True)]
                ends = np.concatenate([[0], np.cumsum((n > 0) * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(as_long(a)), pa.array(as_long(b)),
                        pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(as_long(keys.ravel()))),
                    ],
                    names=["id", "n", "a", "b", "sig", "keys"],
                )

    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    return rows.mapInArrow(lean(run), "id long, n long, a long, b long, sig binary, keys array<long>")


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links (first member of its tree, member) of a spanning forest of 0..n-1.
    ``near(x, others)``: which of the others are linked with x."""
    left = np.arange(n)
    a, b = [], []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        todo = [root]
        while todo and len(left):
            hit = near(todo.pop(), left)
            if hit.any():
                found, left = left[hit], left[~hit]
                a.append(np.full(len(found), root))
                b.append(found)
                todo += found.tolist()
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def estimate(sig: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity from packed two-bit signatures, corrected for chance."""
    diff = sig ^ others
    diff = (diff | (diff >> U(1))) & U(0x5555555555555555)
    equal = 1 - np.bitwise_count(diff).sum(axis=-1, dtype=np.int64) / HASHES
    return (equal - 0.25) / 0.75


def _bounds(table: pa.Table, *keys: str) -> np.ndarray:
    cols = [table[k].to_numpy() for k in keys]
    change = np.zeros(len(table), bool)
    change[0] = True
    for c in cols:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), len(table))


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _bucket_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, ("key", "cell"), "sig", 8 << 20):
        rep = table["rep"].to_numpy()
        raw = table["sig"].combine_chunks()
        raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
        at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]
        sig = np.frombuffer(raw.buffers()[2], np.uint8)[at : at + len(table) * SIG_WORDS * 8].view(U).reshape(len(table), SIG_WORDS)
        bounds = _bounds(table, "key", "cell")
        size = np.diff(bounds)
        two = bounds[:-1][size == 2]
        ok = estimate(sig[two], sig[two + 1]) >= LEAST_ESTIMATE
        a, b = [rep[two[ok]]], [rep[two[ok] + 1]]
        for lo, n in zip(bounds[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            s = sig[lo : lo + n]
            x, y = forest(n, lambda i, others, s=s: estimate(s[i], s[others]) >= LEAST_ESTIMATE)
            a.append(rep[lo + x])
            b.append(rep[lo + y])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=_LINKS)


def _verify_pass(k: int, percent: int) -> Callable:
    def group(ids: np.ndarray, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d, x = shingle_sets(buf, off, k)
        values, local = np.unique(x, return_inverse=True)
        size = np.bincount(d, minlength=len(ids))
        begin = np.cumsum(size) - size
        mark = np.zeros(len(values), np.int64)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            mine = local[begin[i] : begin[i] + size[i]]
            hit = np.zeros(len(others), bool)
            fit = np.flatnonzero((100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])) & (size[others] > 0))
            if not len(fit) or not len(mine):
                return hit
            mark[mine] = 1
            o = others[fit]
            n = size[o]
            ends = np.cumsum(n)
            flat = np.arange(int(ends[-1])) + np.repeat(begin[o] - (ends - n), n)
            both = np.add.reduceat(mark[local[flat]], ends - n)
            mark[mine] = 0
            hit[fit] = 100 * both >= percent * (n + size[i] - both)
            return hit

        a, b = forest(len(ids), near)
        return ids[a], ids[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("key", "cell"), "text", 4 << 20):
            bounds = _bounds(table, "key", "cell")
            ids = table["rep"].to_numpy()
            raw = table["text"].combine_chunks()
            raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
            off = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(table) + 1].astype(np.int64)
            data = np.frombuffer(raw.buffers()[2], np.uint8)
            links = [
                group(ids[lo:hi], data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*links, strict=True)], schema=_LINKS)

    return run


def _cells(rows: DataFrame, blocks, member) -> DataFrame:
    """One row for each pair of blocks that a member belongs to: ``cell``
    numbers the pairs; members of a key that needs no split get cell 0."""
    mine = F.pmod(F.xxhash64(member), F.col("_nb"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1), lambda p: F.least(mine, p) * F.col("_nb") + F.greatest(mine, p))
    return rows.withColumn("_nb", blocks.cast("long")).withColumn("cell", F.explode(pair)).drop("_nb")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``id``, ``n`` (size of the shingle set), ``component`` (smallest id)."""
    all_docs = materialise(sketch(docs, shingle))
    classes = all_docs.where("n > 0").groupBy("a", "b", "n", "sig", "keys").agg(F.min("id").alias("rep"))
    bands = classes.select(F.explode("keys").alias("key"), "rep")
    full = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = _cells(bands.join(full, "key"), F.ceil(F.col("size") / BUCKET), "rep")
    near = (
        members.join(classes.select("rep", "sig"), "rep").select("key", "cell", "rep", "sig")
        .repartition("key", "cell").sortWithinPartitions("key", "cell")
        .mapInArrow(lean(_bucket_pass), "a long, b long").distinct()
    )
    groups = materialise(components(near).join(classes.select(F.col("rep").alias("node"), "n"), "node"))
    sizes = groups.groupBy("component").agg(F.count("*").alias("_m"), F.sum("n").alias("_s"))
    blocks = F.greatest(F.ceil(F.col("_m") / GROUP), F.ceil(F.col("_s") / GROUP_SHINGLES))
    wanted = groups.join(sizes, "component").select(F.col("node").alias("rep"), F.col("component").alias("key"), "_m", "_s")
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("rep"), "text")
    links = (
        _cells(rows.join(wanted.hint("shuffle_hash"), "rep"), blocks, "rep").select("key", "cell", "rep", "text")
        .repartition("key", "cell").sortWithinPartitions("key", "cell")
        .mapInArrow(lean(_verify_pass(shingle, percent)), "a long, b long")
    )
    found = components(links)
    settled = classes.select("a", "b", "n", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    settled = settled.groupBy("a", "b", "n").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    return all_docs.select("id", "n", "a", "b").join(settled, ["a", "b", "n"], "left").select("id", "n", F.coalesce("component", "id").alias("component"))


def representatives(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near duplicates
    (the smallest id; of rows that share id and text, one)."""
    kept = near_duplicates(docs, shingle, percent).where("id = component").select(F.col("id").alias("_kept")).distinct()
    rows = docs.withColumn("_kept", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    stay = rows.join(kept.hint("shuffle_hash"), "_kept", "left_semi").withColumn("_text", F.xxhash64("text"))
    first = F.row_number().over(Window.partitionBy("_kept", "_text").orderBy("_kept"))
    return stay.withColumn("_first", first).where("_first = 1").select(*docs.columns)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4, percent=80).select(
        named("id").alias("doc_id"), F.col("n").alias("n_shingles"), named("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
