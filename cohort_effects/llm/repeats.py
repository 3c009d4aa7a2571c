"""First occurrences of every window of W symbols, over all documents.

A window's *anchor* is the smallest hash among the q-symbol grams inside it
(winnowing), so equal windows have equal anchors wherever they stand.  Runs of
neighbouring windows with one anchor are a *unit*: about one unit in w / 2
symbols instead of one row a symbol.

1. Units are counted by anchor (partial sums before the shuffle; a unit that
   can repeat within itself counts twice).  An anchor counted once names its only document, which learns so that these windows
   are unique; a unit a document is not told about is repeated somewhere.  No
   key is ever joined back to all its members.
2. Repeated units go, with the bytes they span, to their anchor's group.
   Anchors of more than ``HOT_UNITS`` units are dealt to sub-groups of about
   that many by document.  There are at most units / HOT_UNITS of them: their
   table is broadcast while that is no more than ``HOT_BROADCAST``, else joined
   by shuffle.
3. A sub-group finds the first of equal windows (``refine``, the method of the
   operator).  Windows of split groups meet once more by window hash, again
   with partial minima.
4. First occurrences go to their document, one row a run.  A document removes
   what its repeated windows cover, those first occurrences excepted.

Equal whole texts are settled before: all but the smallest id are covered
wholly.  The texts are shuffled once, by id; every step reuses that exchange.

Rows that share id and text are one document (each row gets its result); rows
that share an id only are documents of their own, told apart by 64 bits of a text
hash.  Where an earlier window of the same document counts, they are ordered by
that hash; where only documents with a smaller id count, they remove nothing from
each other.  A null id is one id, and orders first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_effects.llm.tables import lean, texts
from cohort_effects.llm.textarrays import ODD, U, as_long, chunks, mix, shingle_hashes, sliding_min, whole_groups, word_hashes, words

NO_ID = -(2**63)
HOT_UNITS = 512  # units of an anchor in one sub-group, about
HOT_BROADCAST = 1 << 20  # rows


@dataclass(frozen=True)
class Scheme:
    """``window`` and ``gram`` in symbols: bytes, or words."""

    window: int
    gram: int
    by_word: bool


@dataclass
class Symbols:
    """A chunk's symbols: hash of the gram at each, the first symbol of each
    document, and where each symbol's bytes begin and end."""

    gram: np.ndarray
    off: np.ndarray
    starts: np.ndarray | None
    ends: np.ndarray | None

    def bytes_of(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (first, last + 1) if self.starts is None else (self.starts[first], self.ends[last])


def byte_grams(buf: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q bytes (8 or more) at each position, from 8-byte reads."""
    n = len(buf) - q + 1
    if n <= 0:
        return np.zeros(0, U)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(np.ndarray(len(buf), "<u8", padded, 0, (1,)))
    x = eight[:n] * ODD[100]
    for j, at in enumerate([*range(8, q - 8, 8), q - 8]):
        x += eight[at : at + n] * ODD[101 + j]
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    return x


def symbols(buf: np.ndarray, off: np.ndarray, scheme: Scheme) -> Symbols:
    if not scheme.by_word:
        return Symbols(byte_grams(buf, scheme.gram), off, None, None)
    starts, ends, doc = words(buf, off)
    h = word_hashes(buf, starts, ends, False)
    x, at = shingle_hashes(h, doc, scheme.gram)
    gram = np.full(max(0, len(h) - scheme.gram + 1), np.iinfo(np.uint64).max, U)
    gram[at] = x
    return Symbols(gram, np.searchsorted(doc, np.arange(len(off))), starts, ends)


@dataclass
class Units:
    doc: np.ndarray  # row in the chunk
    ordinal: np.ndarray  # number within the document
    first: np.ndarray  # first window, as a symbol of the chunk
    count: np.ndarray  # windows
    anchor: np.ndarray


def units(s: Symbols, scheme: Scheme) -> Units:
    off, w = s.off, scheme.window - scheme.gram + 1
    docs = len(off) - 1
    lengths = np.maximum(np.diff(off) - scheme.window + 1, 0)  # windows of each document
    total = int(lengths.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return Units(none, none, none, none, np.zeros(0, U))
    at = np.arange(total) + np.repeat(off[:-1] - (np.cumsum(lengths) - lengths), lengths)
    doc = np.repeat(np.arange(docs), lengths)
    least = sliding_min(s.gram, w)[at]
    new = np.ones(total, bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    k = np.flatnonzero(new)
    d = doc[k]
    begin = np.searchsorted(d, np.arange(docs))
    return Units(d, np.arange(len(k)) - begin[d], at[k], np.diff(np.append(k, total)), least[k])


def _recurring(s: Symbols, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(document, anchor) of anchors that stand twice in one unit (periodic
    text): windows of that unit can equal each other.  A position is an anchor
    if its gram is the minimum of some window, so the largest minimum of the
    windows over it; two equal ones next to each other are what is looked for."""
    w = scheme.window - scheme.gram + 1
    if len(s.gram) < w:
        return np.zeros(0, np.int64), np.zeros(0, U)
    least = sliding_min(s.gram, w)
    padded = np.concatenate([np.full(w - 1, least[0]), least, np.full(w - 1, least[-1])])
    at = np.flatnonzero(s.gram == ~sliding_min(~padded, w))
    doc = np.searchsorted(s.off, at, side="right") - 1
    g = s.gram[at]
    twice = np.flatnonzero((g[1:] == g[:-1]) & (doc[1:] == doc[:-1]))
    return doc[twice], g[twice]


def _lists(batch: pa.RecordBatch, name: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column, null lists empty; rows from 0."""
    col = batch.column(name).slice(lo, hi - lo)
    rows = pa.compute.list_parent_indices(col).to_numpy(zero_copy_only=False)
    return rows, pa.compute.list_flatten(col)


def _unique(batch: pa.RecordBatch, lo: int, hi: int, u: Units) -> np.ndarray:
    """Which units the document was told to be unique."""
    rows, flat = _lists(batch, "uniques", lo, hi)
    begin = np.searchsorted(u.doc, np.arange(hi - lo))
    out = np.zeros(len(u.doc), bool)
    out[begin[rows] + flat.to_numpy(zero_copy_only=False)] = True
    return out


def _keyed(docs: DataFrame, carry: list[str]) -> DataFrame:
    rows = docs.select(F.struct(*carry).alias("_rest"), "doc_id", "text") if carry else docs
    rest = ["_rest"] if carry else []
    return texts(rows, *rest).select(
        *rest,
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"),
        # never null, and known as such: a null filter would make the join's exchange a second one
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_tag"),
        "text",
    )


def _stats_pass(scheme: Scheme, same_doc_counts: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("_id").to_numpy(), batch.column("_tag").to_numpy()
            for lo, hi, buf, off in chunks(batch):
                s = symbols(buf, off, scheme)
                u = units(s, scheme)
                if same_doc_counts:
                    doc, anchor = _recurring(s, scheme)
                    u = Units(np.append(u.doc, doc), np.append(u.ordinal, np.full(len(doc), -1)), u.first, u.count, np.append(u.anchor, anchor))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(u.anchor)), pa.array(ids[lo:hi][u.doc]), pa.array(tags[lo:hi][u.doc]), pa.array(u.ordinal.astype(np.int32))],
                    names=["anchor", "_id", "_tag", "ordinal"],
                )

    return run


def _unit_pass(scheme: Scheme) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("_id").to_numpy(), batch.column("_tag").to_numpy()
            for lo, hi, buf, off in chunks(batch):
                s = symbols(buf, off, scheme)
                u = units(s, scheme)
                k = np.flatnonzero(~_unique(batch, lo, hi, u))
                if not len(k):
                    continue
                first, count = u.first[k], u.count[k]
                a, b = s.bytes_of(first, first + count + scheme.window - 2)
                spans = [buf[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(u.anchor[k])), pa.array(ids[lo:hi][u.doc[k]]), pa.array(tags[lo:hi][u.doc[k]]),
                        pa.array((first - s.off[u.doc[k]]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(spans, pa.binary()),
                    ],
                    names=["anchor", "_id", "_tag", "first", "n", "span"],
                )

    return run


# (rows in the order of id, tag and first window; spans' bytes and offsets) -> class of each
# window, of equal windows the same, all windows of the first row, then of the next
Refine = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _first_pass(scheme: Scheme, refine: Refine, same_doc_counts: bool, limit: int = 4 << 20) -> Callable:
    """Finds first occurrences group by group; groups come whole and in order,
    many at a time up to ``limit`` bytes (or one that is larger)."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor, ids, tags = (table[c].to_numpy() for c in ("anchor", "_id", "_tag"))
        first, n, split, salt = (table[c].to_numpy() for c in ("first", "n", "split", "salt"))
        order = np.lexsort((first, tags, ids))
        spans = table["span"].cast(pa.large_binary()).combine_chunks().take(pa.array(order))
        buf = np.frombuffer(spans.buffers()[2], np.uint8)
        off = np.frombuffer(spans.buffers()[1], np.int64)[: len(order) + 1]
        anchor, ids, tags, first, n, split, salt = (x[order] for x in (anchor, ids, tags, first, n, split, salt))
        # equal units: only the first of them can hold a first occurrence (with `same_doc_counts`, any of its document)
        h = word_hashes(buf, off[:-1], off[1:], False) + as_long(anchor).view(U) + salt.astype(U) * ODD[300]
        _, lead, inverse = np.unique(h, return_index=True, return_inverse=True)
        lead = lead[inverse]
        kept = lead == np.arange(len(h))
        if not same_doc_counts:
            kept |= ids[lead] == ids
        k = np.flatnonzero(kept)
        lengths = np.diff(off)[k]
        new_off = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(new_off[-1]) + np.repeat(off[:-1][k] - new_off[:-1], lengths)
        buf, ids, tags, first, n, split = buf[take], ids[k], tags[k], first[k], n[k].astype(np.int64), split[k]
        cls = refine(buf, new_off, n, as_long(anchor[k]).view(U) + salt[k].astype(U) * ODD[300])
        row = np.repeat(np.arange(len(k)), n)
        _, lead, inverse = np.unique(cls, return_index=True, return_inverse=True)
        lead = lead[inverse]
        keep = lead == np.arange(len(cls))
        if not same_doc_counts:
            keep |= ids[row[lead]] == ids[row]
        at = np.flatnonzero(keep)
        if not len(at):
            return
        r = row[at]
        start = first[r] + at - (np.cumsum(n) - n)[r]
        hot = split[r] > 1
        # runs of first occurrences; windows of split groups stay single, with a hash to meet by
        new = np.ones(len(at), bool)
        new[1:] = (r[1:] != r[:-1]) | (start[1:] != start[:-1] + 1) | hot[1:]
        j = np.flatnonzero(new)
        length = np.diff(np.append(j, len(at)))
        key1, key2 = ids[r[j]].copy(), as_long(mix(tags[r[j]].view(U) + start[j].astype(U) * ODD[301]))
        warm = hot[j]
        if warm.any():
            pos = (new_off[:-1][r[j]] + at[j] - (np.cumsum(n) - n)[r[j]])[warm]
            if scheme.by_word:
                ws, we, wd = words(buf, new_off)
                w0 = np.searchsorted(wd, r[j][warm]) + (at[j] - (np.cumsum(n) - n)[r[j]])[warm]
                h = word_hashes(buf, ws, we, False)
                x = sum((h[w0 + i] * ODD[i] for i in range(scheme.window)), np.zeros(len(w0), U))
                y = sum((h[w0 + i] * ODD[i + 128] for i in range(scheme.window)), np.zeros(len(w0), U))
            else:
                g = [byte_grams(buf, 8), byte_grams(buf, 12)]
                steps = [*range(0, scheme.window - 12, 8), scheme.window - 12]
                x = sum((mix(g[0][pos + i] + U(i)) * ODD[i] for i in steps), np.zeros(len(pos), U)) + g[0][pos + scheme.window - 8]
                y = sum((mix(g[1][pos + i] + U(i)) * ODD[i + 128] for i in steps), np.zeros(len(pos), U))
            key1[warm], key2[warm] = as_long(mix(x)), as_long(mix(y))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key1), pa.array(key2), pa.array(ids[r[j]]), pa.array(tags[r[j]]), pa.array(start[j].astype(np.int32)), pa.array(length.astype(np.int32))],
            names=["key1", "key2", "_id", "_tag", "start", "length"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("anchor", "salt"), "span", limit):
            yield from settle(table)

    return run


def repeated_windows(
    docs: DataFrame, scheme: Scheme, refine: Refine, same_doc_counts: bool, digest: Callable, schema: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Runs ``digest(rows, copies, buf, off, symbols, removed starts)`` over
    every document; the columns ``carry`` travel with it as a struct ``_rest``.  ``same_doc_counts``: an earlier window of the same
    document counts too; otherwise only one of another, earlier document."""
    keyed = _keyed(docs, list(carry))
    key, rest = ["_id", "_tag"], ["_rest"] if carry else []
    hashed = keyed.select("_id", "_tag", F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"))
    heads = hashed.groupBy("a", "b").agg(F.min(F.struct("_id", "_tag")).alias("k")).select("k.*").withColumn("head", F.lit(True)).distinct()
    n_units = (docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) * 2 / (scheme.window - scheme.gram + 2) / (6 if scheme.by_word else 1)
    own = keyed.join(heads.hint("shuffle_hash"), key, "left_semi")
    stats = (
        own.mapInArrow(lean(_stats_pass(scheme, same_doc_counts)), "anchor long, _id long, _tag long, ordinal int")
        .where("anchor is not null")  # as the join below infers it; said here, both uses share one exchange
        .groupBy("anchor")
        .agg(F.count("*").alias("n"), F.max("_id").alias("_id"), F.max("_tag").alias("_tag"), F.max("ordinal").alias("ordinal"))
    )
    uniques = stats.where("n = 1").groupBy(*key).agg(F.collect_list("ordinal").alias("uniques"))
    # all columns are read here as well, so that both uses share one exchange
    hot = stats.where((F.col("n") > HOT_UNITS) & (F.col("ordinal") >= -1) & (F.col("_id") >= NO_ID) & (F.col("_tag") >= NO_ID))
    hot = hot.select("anchor", F.ceil(F.col("n") / HOT_UNITS).cast("int").alias("split"))
    hot = F.broadcast(hot) if n_units / HOT_UNITS <= HOT_BROADCAST else hot
    found = (
        own.join(uniques.hint("shuffle_hash"), key, "left")
        .select(*key, *rest, "text", "uniques")
        .mapInArrow(lean(_unit_pass(scheme)), "anchor long, _id long, _tag long, first int, n int, span binary")
        .join(hot, "anchor", "left")
        .withColumn("split", F.coalesce("split", F.lit(1)))
        .withColumn("salt", F.pmod(F.xxhash64(*key), F.col("split")).cast("int"))
        .repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt")
        .mapInArrow(lean(_first_pass(scheme, refine, same_doc_counts)), "key1 long, key2 long, _id long, _tag long, start int, length int")
    )
    if not same_doc_counts:  # all windows under the smallest id stay
        least = found.groupBy("key1", "key2").agg(F.min("_id").alias("_least"))
        firsts = found.join(least, ["key1", "key2"]).where("_id = _least").select(*key, F.struct("start", "length").alias("run"))
    else:
        firsts = found.groupBy("key1", "key2").agg(F.min(F.struct(*key, "start", "length")).alias("x")).select("x._id", "x._tag", F.struct("x.start", "x.length").alias("run"))
    firsts = firsts.groupBy(*key).agg(F.collect_list("run").alias("runs"))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = pa.compute.fill_null(batch.column("head"), False).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in chunks(batch):
                s = symbols(buf, off, scheme)
                u = units(s, scheme)
                gone = np.zeros(int(s.off[-1]) + 1, np.int32)  # +1 where removed starts begin, -1 after them
                k = np.flatnonzero(~_unique(batch, lo, hi, u) & head[lo:hi][u.doc])
                np.add.at(gone, u.first[k], 1)
                np.add.at(gone, u.first[k] + u.count[k], -1)
                rows, flat = _lists(batch, "runs", lo, hi)
                a = s.off[rows] + flat.field("start").to_numpy(zero_copy_only=False)
                np.add.at(gone, a, -1)
                np.add.at(gone, a + flat.field("length").to_numpy(zero_copy_only=False), 1)
                removed = np.flatnonzero(np.cumsum(gone) > 0)
                yield digest(batch.slice(lo, hi - lo), ~head[lo:hi], buf, off, s, removed)

    return (
        keyed.join(heads.hint("shuffle_hash"), key, "left")
        .join(uniques.hint("shuffle_hash"), key, "left")
        .join(firsts.hint("shuffle_hash"), key, "left")
        .select(*key, *rest, "text", "head", "uniques", "runs")
        .mapInArrow(lean(last), schema)
    )


def covered(removed: np.ndarray, off: np.ndarray, copies: np.ndarray, window: int) -> np.ndarray:
    """Which symbols the removed windows cover; a copy of an earlier text is
    covered wholly if it has a window at all."""
    edge = np.zeros(int(off[-1]) + window + 1, np.int32)
    np.add.at(edge, removed, 1)
    np.add.at(edge, removed + window, -1)
    out = np.cumsum(edge)[: int(off[-1])] > 0
    lengths = np.diff(off)
    out |= np.repeat(copies & (lengths >= window), lengths)
    return out
