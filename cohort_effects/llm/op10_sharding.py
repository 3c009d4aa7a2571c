"""Sharding by minimax contiguous partition.

Groups of equal keys are atomic.  They stand in the order of a 64-bit hash of
the key; a shard is a run of that order.  The smallest feasible capacity (the
largest shard of the best cutting) is found by binary search, each capacity
checked greedily, and the order is cut there.

The groups themselves stay on the cluster.  The driver holds a bounded table of
hash ranges with the sum of their sizes.  A greedy pass that may cut only at
range borders proves a capacity feasible; one that may cut anywhere inside a
range that holds several groups proves it infeasible.  Ranges in which a cut of
the capacities between those two bounds can fall are split by their next hash
bits, until the bounds meet.  The result is exact: no other cutting of this
order has a smaller largest shard.  Where one group alone is larger than the
capacity the others need, it is a shard of its own and the search goes on for
the others, so a hot group does not leave the remaining shards empty.

Edge cases: a null key is a group of its own; null sizes count 0; repeated rows
are rows; an empty table gives no rows; with fewer groups than shards some
shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_effects.llm.tables import materialise, read

FIRST_BITS = 12  # ranges of the first pass: 4096
SPLIT_BITS = 8  # each open range is split into 256
MOST_SPLIT = 512  # ranges split in one pass; those still open wait for the next


@dataclass(frozen=True)
class Span:
    """Groups whose hash shifted right by ``shift`` is ``prefix``."""

    shift: int
    prefix: int
    total: int
    single: bool

    @property
    def last(self) -> int:
        return ((self.prefix + 1) << self.shift) - 1


class _Spans:
    """The ranges in order, with the prefix sums at their ends."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans, key=lambda s: s.last)
        self.totals = np.array([s.total for s in self.spans], np.int64)
        self.single = np.array([s.single for s in self.spans], bool)
        self.ends = np.cumsum(self.totals).tolist()


def _chain(spans: _Spans, shards: int, cap: int, inside: bool) -> list[int]:
    """Prefix sums at which a greedy pass cuts; a group over ``cap`` is a shard
    of its own.  ``inside``: it may also cut anywhere within a range of several
    groups (then it gets at least as far as the true greedy pass)."""
    ends, total = spans.ends, spans.ends[-1]
    giants = np.flatnonzero(spans.single & (spans.totals > cap)).tolist()
    cuts, at = [], 0
    if len(giants) > shards:
        return [at]
    for _ in range(shards):
        while giants and ends[giants[0]] <= at:
            giants.pop(0)
        start = ends[giants[0]] - int(spans.totals[giants[0]]) if giants else total
        if giants and start <= at:
            at = ends[giants[0]]
        else:
            reach = min(at + cap, start)
            k = bisect_right(ends, reach)  # the range that holds `reach`
            at = reach if inside and k < len(ends) and not spans.single[k] else max(at, ends[k - 1] if k else 0)
        cuts.append(at)
        if at >= total:
            break
    return cuts


def _least(low: int, high: int, ok) -> int:
    """Smallest value in low..high for which ``ok`` holds (it holds for high)."""
    while low < high:
        mid = (low + high) // 2
        if ok(mid):
            high = mid
        else:
            low = mid + 1
    return low


def _summaries(groups: DataFrame, shift: int) -> list:
    return (
        groups.groupBy(F.shiftright("h", shift).alias("prefix"))
        .agg(F.sum("size").alias("total"), F.count("*").alias("n"))
        .collect()
    )


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, last hash of each shard but the last) for the atomic groups
    ``h`` (distinct longs, in this order) with ``size``."""
    shift = 64 - FIRST_BITS
    spans = [Span(shift, r.prefix, r.total, r.n == 1) for r in _summaries(groups, shift)]
    if not spans:
        return 0, []
    while True:
        table = _Spans(spans)
        spans, ends, single, total = table.spans, table.ends, table.single, table.ends[-1]
        high = _least(1, total, lambda cap: _chain(table, shards, cap, False)[-1] == total)
        low = _least(1, high, lambda cap: _chain(table, shards, cap, True)[-1] == total)
        if low == high:
            break
        # the cuts of any capacity from low to high lie between these chains
        near, far = _chain(table, shards, low, False), _chain(table, shards, high, True)
        near += [total] * (len(far) - len(near))
        far += [total] * (len(near) - len(far))
        open_ = {}
        for a, b in zip(near, far, strict=False):
            for k in range(bisect_right(ends, a), min(bisect_right(ends, b) + 1, len(spans))):
                if not single[k]:
                    open_.setdefault(k, spans[k].total)
        widest = sorted(open_, key=open_.get, reverse=True)[:MOST_SPLIT]
        if not widest:
            break
        split = {spans[k] for k in widest}
        spans = [s for s in spans if s not in split]
        for shift in {s.shift for s in split}:
            mine = [s.prefix for s in split if s.shift == shift]
            part = groups.where(F.shiftright("h", shift).isin(mine))
            finer = max(0, shift - SPLIT_BITS)
            spans += [Span(finer, r.prefix, r.total, r.n == 1 or finer == 0) for r in _summaries(part, finer)]
    cuts = _chain(table, shards, high, False)
    return high, [spans[bisect_right(ends, c) - 1].last for c in cuts[:-1]]


def numbered(df: DataFrame, by: str, order: list, split_on, parts: int, name: str) -> DataFrame:
    """Gapless numbers from 0 within each value of ``by``.  Each value is dealt
    to ``parts`` sub-groups by a hash of ``split_on``, so a value that holds
    most rows is numbered by many tasks; sub-groups start where the counts of
    those before them end."""
    part = df.withColumn("_part", F.pmod(F.xxhash64(*split_on), F.lit(parts)))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        part.groupBy(by, "_part").agg(F.count("*").alias("_n"))
        .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(by, "_part", "_from")
    )
    inside = Window.partitionBy(by, "_part").orderBy(*order)
    return (
        part.withColumn("_row", F.row_number().over(inside))
        .join(counts, [by, "_part"])
        .withColumn(name, (F.col("_from") + F.col("_row") - 1).cast("long"))
        .drop("_part", "_row", "_from")
    )


def minimax_shards(rows: DataFrame, shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows with ``h`` (hash of the atomic
    group's key), ``size`` and ``doc_id``."""
    groups = rows.groupBy("h").agg(F.sum("size").alias("size"))
    _, cuts = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for last in cuts:
        shard = shard + (F.col("h") > F.lit(last)).cast("int")
    n = rows.count()
    return numbered(
        rows.withColumn("shard", shard.cast("int")), "shard", ["doc_id", "h"], ["doc_id"], max(4, n // 2_000_000), "slot"
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shards documents by bytes; equal texts (null and empty text differ) stay
    together.  One scan of the texts; only ids, sizes and hashes are kept."""
    text = F.col("text").cast("string")
    rows = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        )
    )
    return minimax_shards(rows, shards)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
