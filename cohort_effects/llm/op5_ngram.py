"""LM scoring with Elias-Fano n-gram tries.

The model is an interpolated bigram model over word hashes:
p(w | c) = s * count(c w) / count(c) + (1 - s) * (count(w) + 1) / (N + V + 1),
where s is the share of training bigrams seen more than once (deleted
interpolation); after an unseen context the second term alone.  A text ends
with an end token, its first context is a start token.

It grows with the corpus, so it is sharded, and texts meet it in batches:

1. Texts are packed (zstd) into rows of about a megabyte and dealt to blocks.
2. A block reduces its tokens to distinct words and bigrams with their training
   counts and sends each shard its part, one row: counts and questions at once.
   A word or bigram is one entry a block however frequent, and the successors of
   one context are spread over all shards, so no frequent word fills a task.
3. A shard sums the counts and writes its trie into one memory map: level 1 the
   contexts, level 2 their successors, both as Elias-Fano sequences, with a
   monotone Elias-Fano pointer from each context to its first successor and one
   byte a bigram for its quantised joint probability (counts to 64 exactly, then
   in steps of 9 %, rounded down).  It answers every block's bigrams by searching
   the context, then the successor inside the context's range; word counts are
   answered exactly.
4. A block reads its texts again and adds up the scores.

Rows between steps number blocks * shards; both are the text size over
``BLOCK_BYTES``, which larger inputs should raise with their executors' memory.

Edge cases: null text is empty (one token, the end); a null id is the text ""
for the fold; without training rows every word is unknown and N is 0; repeated
rows are scored and counted each.  Words and bigrams are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import mmap
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.tables import held_out, read
from cohort_effects.llm.textarrays import ODD, U, chunks, mix, word_hashes, words

BLOCK_BYTES = 16 << 20
START, END = U(0x5151_5151_5151_5151), U(0xE1E1_E1E1_E1E1_E1E1)
EXACT, STEP = 64, 1.09
_LEVELS = np.unique(np.concatenate([np.arange(EXACT + 1), np.floor(EXACT * STEP ** np.arange(1, 191))]))
_SELECT = np.array([[([k for k in range(8) if not b >> k & 1] + [8] * 8)[j] for j in range(8)] for b in range(256)], np.int64)


def _zip(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd", 3).compress(raw, asbytes=True) if raw else b"")


def _unzip(raw: bytes) -> bytes:
    n = int.from_bytes(raw[:8], "little")
    return pa.Codec("zstd").decompress(raw[8:], n, asbytes=True) if n else b""


def _squeeze(a: np.ndarray) -> bytes:
    """zstd of an array's bytes, plane by plane."""
    return _zip(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())


def _expand(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(_unzip(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _steps(sorted_: np.ndarray) -> bytes:
    return _squeeze(np.diff(sorted_, prepend=U(0)))


class EliasFano:
    """A monotone sequence below ``universe``: low bits packed, high bits in
    unary; both lie in ``room``, a writable buffer the caller maps."""

    def __init__(self, values: np.ndarray, universe: int, room):
        self.n = n = len(values)
        self.low_bits = l = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        high = (values >> U(l)).astype(np.int64)
        bits = np.zeros(n + (int(universe) >> l) + 2, np.uint8)
        bits[high + np.arange(n)] = 1
        self.upper = room(np.packbits(bits, bitorder="little"))
        width = -(-l // 8)  # whole bytes: read without shifts
        low = (values & U((1 << l) - 1)).view(np.uint8).reshape(n, 8)[:, :width] if n else np.zeros((0, width), np.uint8)
        self.low = room(np.ascontiguousarray(low).ravel()).reshape(n, width)
        zeros = 8 - np.bitwise_count(self.upper).astype(np.int64)
        self.zeros = np.concatenate([[0], np.cumsum(zeros)])

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero bit."""
        byte = np.searchsorted(self.zeros, k, side="right") - 1
        return byte * 8 + _SELECT[self.upper[byte], k - self.zeros[byte]]

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.low.shape[1]] = self.low[at]
        return out.view(U).ravel()

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """Values at positions (by the position of their one bit)."""
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.upper).astype(np.int64))])
        byte = np.searchsorted(ones, at, side="right") - 1
        bit = _SELECT[~self.upper[byte], at - ones[byte]]
        return ((byte * 8 + bit - at).astype(U) << U(self.low_bits)) | self._low(at)

    def find(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Position of each ``x`` (between ``lo`` and ``hi``), or -1."""
        high = (x >> U(self.low_bits)).astype(np.int64)
        begin = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - (high - 1), 0)
        end = self._zero(high) - high
        if lo is not None:
            begin, end = np.maximum(begin, lo), np.minimum(end, hi)
        out = np.full(len(x), -1, np.int64)
        low = x & U((1 << self.low_bits) - 1)
        todo = np.flatnonzero(begin < end)
        while len(todo):
            hit = self._low(begin[todo]) == low[todo]
            out[todo[hit]] = begin[todo[hit]]
            todo = todo[~hit]
            begin[todo] += 1
            todo = todo[begin[todo] < end[todo]]
        return out


class Trie:
    """Bigrams (32 bits of context, 32 of successor) with quantised values."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.map = mmap.mmap(-1, 64 + 24 * len(keys) + (1 << 16))
        self.used = 0
        context = keys >> U(32)
        new = np.ones(len(keys), bool)
        new[1:] = context[1:] != context[:-1]
        first = np.flatnonzero(new)
        nth = np.cumsum(new).astype(U) - U(1)
        self.contexts = EliasFano(context[first], 1 << 32, self._room)
        self.pointers = EliasFano(np.append(first, len(keys)).astype(U), len(keys) + 1, self._room)
        self.successors = EliasFano((nth << U(32)) | (keys & U(0xFFFFFFFF)), max(1, len(first)) << 32, self._room)
        self.codes = self._room((np.searchsorted(_LEVELS, counts, side="right") - 1).astype(np.uint8))

    def _room(self, a: np.ndarray) -> np.ndarray:
        raw = a.tobytes()
        if self.used + len(raw) > len(self.map):
            self.map.resize(self.used + len(raw))
        self.map[self.used : self.used + len(raw)] = raw
        self.used += len(raw)
        return np.frombuffer(self.map, a.dtype, len(a), self.used - len(raw))

    def codes_of(self, keys: np.ndarray) -> np.ndarray:
        """Code of each bigram, 0 for one that is not there."""
        out = np.zeros(len(keys), np.uint8)
        at = self.contexts.find(keys >> U(32))
        k = np.flatnonzero(at >= 0)
        if len(k):
            lo, hi = self.pointers[at[k]].astype(np.int64), self.pointers[at[k] + 1].astype(np.int64)
            pos = self.successors.find((at[k].astype(U) << U(32)) | (keys[k] & U(0xFFFFFFFF)), lo, hi)
            out[k[pos >= 0]] = self.codes[pos[pos >= 0]]
        return out


def _pack(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column("doc_id"), batch.column("held_out").to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in chunks(batch):
                known = ids.slice(lo, hi - lo)
                doc = pa.compute.fill_null(known, 0).to_numpy()
                parts = (doc, known.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), held[lo:hi].astype(np.uint8), np.diff(off))
                row = [*(x.tobytes() for x in parts), _zip(buf.tobytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([zlib.crc32(b"".join(row)) % blocks]), *(pa.array([x], pa.binary()) for x in row)], names=["block", "ids", "nulls", "held", "sizes", "text"]
                )

    return run


_PACKED = "block long, ids binary, nulls binary, held binary, sizes binary, text binary"


def _texts(table: pa.Table):
    """(ids, null flags, held-out flags, bytes, offsets) of each packed row, in
    an order that does not depend on the shuffle."""
    rows = sorted(table.select(["ids", "nulls", "held", "sizes", "text"]).to_pylist(), key=lambda r: (r["ids"], r["text"]))
    for r in rows:
        buf = np.frombuffer(_unzip(r["text"]), np.uint8)
        off = np.concatenate([[0], np.cumsum(np.frombuffer(r["sizes"], np.int64))])
        yield np.frombuffer(r["ids"], np.int64), np.frombuffer(r["nulls"], np.uint8), np.frombuffer(r["held"], np.uint8).astype(bool), buf, off


def _tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, context, document): the words of each document, then its end."""
    starts, ends, doc = words(buf, off)
    h = word_hashes(buf, starts, ends, True)
    docs = len(off) - 1
    size = np.bincount(doc, minlength=docs) + 1
    last = np.cumsum(size) - 1
    token = np.full(int(size.sum()), END, U)
    inner = np.ones(len(token), bool)
    inner[last] = False
    token[inner] = h
    context = np.empty(len(token), U)
    context[1:] = token[:-1]
    context[last - size + 1] = START
    return token, context, np.repeat(np.arange(docs), size)


def _bigrams(token: np.ndarray, context: np.ndarray) -> np.ndarray:
    """32 bits of the context, then 32 of the successor given the context."""
    return ((mix(context * ODD[3]) >> U(32)) << U(32)) | (mix(context * ODD[5] + token * ODD[7]) >> U(32))


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(keys * ODD[9]) >> U(33)) % U(shards)).astype(np.int64)


class _Counted:
    """Distinct keys of a block in order of (shard, key), and what is needed to
    find a token's key again."""

    def __init__(self, keys: np.ndarray, train: np.ndarray, shards: int):
        distinct, inverse = np.unique(keys, return_inverse=True)
        shard = _shard(distinct, shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.place = distinct[order], place[inverse]
        self.counts = np.bincount(self.place[train], minlength=len(order)).astype(U)
        self.bounds = np.searchsorted(shard[order], np.arange(shards + 1))


def _count_block(shards: int):
    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        parts = [(t, c, ~held[d]) for _, _, held, buf, off in _texts(table) for t, c, d in [_tokens(buf, off)]]
        token, context, train = (np.concatenate(x) for x in zip(*parts, strict=True))
        cols: list[list] = []
        for keys in (token, _bigrams(token, context)):
            got = _Counted(keys, train, shards)
            spans = list(zip(got.bounds[:-1].tolist(), got.bounds[1:].tolist(), strict=True))
            cols += [[_steps(got.keys[a:b]) for a, b in spans], [_squeeze(got.counts[a:b]) for a, b in spans]]
        return pa.table([pa.array(range(shards), pa.int64()), pa.array([block] * shards, pa.int64()), *(pa.array(c, pa.binary()) for c in cols)], names=["shard", "block", "uk", "uc", "bk", "bc"])

    return run


def _answer(table: pa.Table) -> pa.Table:
    """One shard: sums the blocks' counts, builds the trie, answers each block."""
    blocks = table["block"].to_pylist()
    out = {}
    for kind in "ub":
        keys = [np.cumsum(_expand(x.as_py(), U), dtype=U) for x in table[f"{kind}k"]]
        counts = [_expand(x.as_py(), U) for x in table[f"{kind}c"]]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, np.concatenate(counts).astype(np.int64))
        there = total > 0
        if kind == "u":
            ends = np.cumsum([len(k) for k in keys])
            answers = [_squeeze(total[inverse[e - len(k) : e]]) for e, k in zip(ends.tolist(), keys, strict=True)]
            sums = (int(total.sum()), int(there.sum()))
        else:
            trie = Trie(distinct[there], total[there])
            answers = [_squeeze(trie.codes_of(k)) for k in keys]
            sums = (int(total.sum()), int((total == 1).sum()))
        out[kind] = (answers, sums)
    n = len(blocks)
    return pa.table(
        [table["block"], table["shard"], pa.array(out["u"][0], pa.binary()), pa.array(out["b"][0], pa.binary()), *(pa.array([x] * n, pa.int64()) for x in out["u"][1] + out["b"][1])],
        names=["block", "shard", "ua", "ba", "n", "v", "bigrams", "once"],
    )


_OUT = pa.schema([(c, t) for c, t in zip(("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)])


def _score_block(shards: int):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(packed):
            return _OUT.empty_table()
        answers = answers.sort_by("shard")
        n, v, bigrams, once = (sum(answers[c].to_pylist()) for c in ("n", "v", "bigrams", "once"))
        seen = (bigrams - once) / bigrams if bigrams else 0.0
        unigram = np.concatenate([_expand(x.as_py(), np.int64) for x in answers["ua"]])
        codes = np.concatenate([_expand(x.as_py(), np.uint8) for x in answers["ba"]])
        chunks_ = list(_texts(packed))
        parts = [_tokens(buf, off) for *_, buf, off in chunks_]
        token, context = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        none = np.zeros(0, np.int64)
        words_, pairs = _Counted(token, none, shards), _Counted(_bigrams(token, context), none, shards)
        c = unigram[words_.place]
        # a context's count: that of the word before; of the start token, that of the end token (one each a document)
        before = np.concatenate([[0], c[:-1]])
        ends = c[token == END]
        before[context == START] = ends[0] if len(ends) else 0
        base = (c + 1) / (n + v + 1)
        joint = _LEVELS[codes[pairs.place]]
        p = np.where(before > 0, seen * joint / np.maximum(before, 1) + (1 - seen) * base, base)
        sizes = [len(off) - 1 for *_, off in chunks_]
        doc = np.concatenate([p_[2] + s for p_, s in zip(parts, np.cumsum([0, *sizes[:-1]]).tolist(), strict=True)])
        docs = sum(sizes)
        nulls = np.concatenate([x[1] for x in chunks_]).astype(bool)
        held = np.concatenate([x[2] for x in chunks_])
        return pa.table(
            [
                pa.array(np.concatenate([x[0] for x in chunks_]), mask=nulls), pa.array(held), pa.array(np.bincount(doc, minlength=docs)),
                pa.array(np.bincount(doc, c > 0, docs).astype(np.int64)), pa.array(np.full(docs, n, np.int64)),
                pa.array(np.bincount(doc, np.log10(base), docs)), pa.array(np.bincount(doc, np.log10(p), docs)),
            ],
            schema=_OUT,
        )

    return run


def score_documents(docs: DataFrame, folds: int = 7, fold: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Learns from the rows outside the held-out fold, scores all rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), folds, fold).alias("held_out"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // block_bytes))
    packed = rows.mapInArrow(_pack(parts), _PACKED).groupBy("block")
    counted = packed.applyInArrow(_count_block(parts), "shard long, block long, uk binary, uc binary, bk binary, bc binary")
    answers = counted.groupBy("shard").applyInArrow(_answer, "block long, shard long, ua binary, ba binary, n long, v long, bigrams long, once long")
    return packed.cogroup(answers.groupBy("block")).applyInArrow(
        _score_block(parts), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
