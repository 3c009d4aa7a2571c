"""Best-fit packing of tokenised documents by exact-complement hashing.

Pieces of at most ``size`` ids are counted by length; that histogram (at most
``size`` rows, whatever the input) is all the driver plans with.  From the
longest length down, an index of single, pair and triple length sums is asked
for combinations that fill the gap exactly, and they are consumed as often as
the counts allow.  What is left is packed best-fit, longest first.  The plan is
a list of patterns with multiplicities: the r-th piece of a length (a
distributed numbering) belongs to the pattern whose rank interval holds r, so
pieces are placed by one join on the length.

Edge cases: null text is empty and gives one piece, the end id alone; repeated
rows and ids are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.op10_sharding import numbered
from cohort_effects.llm.tables import lean, materialise, read, texts
from cohort_effects.llm.textarrays import chunks
from cohort_effects.llm.wordcache import word_cache

SIZE = 2048
END_ID = 0
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None) -> DataFrame:
    """One row per piece; only documents longer than ``size`` ids are cut."""
    path = tokenizer or tokenizer_path()
    step = 4 * size
    end = END_ID.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo, hi, _, _ in chunks(batch):
                rows = []
                for doc, text in zip(ids[lo:hi], batch.column("text").slice(lo, hi - lo).to_pylist(), strict=True):
                    raw = cache.encode(text or "") + end
                    rows += [
                        (doc, k, at // 4, min(step, len(raw) - at) // 4, zlib.crc32(raw[at : at + step]))
                        for k, at in enumerate(range(0, len(raw), step))
                    ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES.types, strict=True)], schema=_PIECES)

    return texts(docs).mapInArrow(lean(encode), "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Sums:
    """Which lengths are left, and which sums two of them make."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.size = counts, len(counts) - 1
        self.refresh()

    def refresh(self) -> None:
        there = np.flatnonzero(self.counts > 0)
        self.pair = np.zeros(self.size + 1, bool)
        for a in there.tolist():
            sums = there[: np.searchsorted(there, self.size - a, side="right")] + a
            self.pair[sums] = True
        self.stale = 0

    def _two(self, gap: int, most: int) -> tuple[int, ...] | None:
        if gap < 2 or not self.pair[gap]:
            return None
        a = np.arange((gap + 1) // 2, min(most, gap - 1) + 1)
        ok = (self.counts[a] > 0) & (self.counts[gap - a] > (a * 2 == gap))
        if not ok.any():
            self.stale += 1
            return None
        x = int(a[np.flatnonzero(ok)[-1]])
        return (x, gap - x)

    def filling(self, gap: int, most: int) -> tuple[int, ...] | None:
        """Up to ``most`` (three at most) lengths left that sum to ``gap``, as
        few and as long as possible."""
        if most and self.counts[gap] > 0:
            return (gap,)
        if most > 1 and (found := self._two(gap, gap - 1)):
            return found
        if most < 3:
            return None
        first = np.arange(gap - 2, 0, -1)
        for a in first[(self.counts[first] > 0) & self.pair[gap - first]].tolist():
            if a * 3 < gap:
                break
            self.counts[a] -= 1
            rest = self._two(gap - a, a)
            self.counts[a] += 1
            if rest:
                return (a, *rest)
            if self.stale > 64:
                self.refresh()
        return None


Plan = list[tuple[int, list[tuple[int, int]]]]


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """(number of sequences, [(length, how many of it)]) for each pattern: the
    best of the plans with combinations of up to three, two, one and no lengths
    (few pieces can come out better without)."""
    plans = [_plan(histogram, size, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda p: sum(times for times, _ in p))


def _plan(histogram: dict[int, int], size: int, most: int) -> Plan:
    counts = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out: Plan = []
    sums = _Sums(counts)
    for length in range(size, 0, -1):
        while counts[length] > 0:
            gap = size - length
            if not gap:
                found: tuple[int, ...] | None = ()
            else:
                counts[length] -= 1
                found = sums.filling(gap, most)
                counts[length] += 1
            if found is None:
                break
            use: dict[int, int] = {length: 1}
            for x in found:
                use[x] = use.get(x, 0) + 1
            times = min(int(counts[x]) // k for x, k in use.items())
            for x, k in use.items():
                counts[x] -= times * k
            out.append((times, list(use.items())))
    # best fit, longest first, on what is left: open sequences by their gap
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def keep(times: int, pattern: list[tuple[int, int]], gap: int) -> None:
        if not times:
            return
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((times, pattern))

    for length in range(size, 0, -1):
        n = int(counts[length])
        while n:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                gap, times, pattern = size, n, []
            else:
                gap = gaps[k]
                times, pattern = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[k]
            per = min(gap // length, n)
            used = min(times, n // per)
            keep(used, [*pattern, (length, per)], gap - used_length if (used_length := per * length) else gap)
            if pattern:
                keep(times - used, pattern, gap)
            n -= used * per
    return out + [entry for entries in open_.values() for entry in entries]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces a sequence, offset)."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for length, k in pattern:
            at = used.get(length, 0)
            out.append((length, at, at + times * k, sequence, k, offset))
            used[length] = at + times * k
            offset += k * length
        sequence += times
    return out


def pack(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``piece``
    and ``length``.  The broadcast slots follow the number of distinct lengths
    (at most ``size``), not the rows."""
    spark = rows.sparkSession
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.createDataFrame(
        slots(plan(histogram, size)), "length long, _lo long, _hi long, _seq long, _k long, _off long"
    )
    ranked = numbered(rows, "length", ["doc_id", "piece"], ["doc_id", "piece"], max(4, sum(histogram.values()) // 2_000_000), "_rank")
    since = F.col("_rank") - F.col("_lo")
    return (
        ranked.join(F.broadcast(table), "length")
        .where((F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
        .withColumn("sequence_id", F.col("_seq") + F.floor(since / F.col("_k")).cast("long"))
        .withColumn("offset", F.col("_off") + (since % F.col("_k")) * F.col("length"))
        .drop("_lo", "_hi", "_seq", "_k", "_off", "_rank")
    )


def pack_documents(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None) -> DataFrame:
    return pack(materialise(pieces(docs, size, tokenizer)), size)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
