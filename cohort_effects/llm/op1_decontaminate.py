"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark texts become passages of at most ``PASSAGE`` words (lower-cased,
   punctuation trimmed), dealt to blocks of at most ``BLOCK`` passages; what
   follows is done for one block after the other, so what is broadcast is
   bounded (``BLOCK * PASSAGE`` terms times at most ``BLOCK`` dimensions),
   however large the benchmark.
2. Terms weigh by their inverse document frequency, counted over all documents.
   A distributed randomised SVD of the TF-IDF passages (range finder with one
   power iteration; each task adds its passages' part of A'(A M), the parts are
   summed by slices of terms) gives the latent space.
3. Every document is read once and whole, in overlapping windows of ``SPAN``
   words.  A passage is a candidate of a window that holds as many of its words
   as step 4 asks for, and on whose projection into the space its share is not
   under the least share so many of its words can have.  Both bounds follow
   from step 4, and neither looks at what else the window holds, so they drop
   no leak.  The space has as many dimensions as the block has passages, so
   projecting loses nothing of a passage.
4. A candidate is a leak if the longest common subsequence of words holds
   ``EXACT`` of the passage, or ``PARAPHRASE`` of it and the answer, the last
   sentence of the text, stands in the window word for word.  A passage under
   ``SHORT`` words must stand there as a whole.

All words of a passage span the space, also those in many passages: which other
passages share its block changes nothing.

Result: one row for each document and benchmark item, for the best window;
``cosine`` is that of the passage and the part of it the window holds, by weight.
Edge cases: null or empty texts match nothing; null ids stay null; equal
benchmark rows count once; without benchmark or documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.op10_sharding import numbered
from cohort_effects.llm.tables import lean, materialise, read, texts
from cohort_effects.llm.textarrays import U, chunks, word_hashes, words

PASSAGE, BLOCK = 64, 256
SPAN, STRIDE = 96, 32  # a passage lies in some window whole
EXACT, PARAPHRASE, SHORT = 0.7, 0.5, 8
SLACK = 1e-3  # rounding of projections, as a share of a passage
ANSWER = 3  # words an answer has at least
SLICE = 1024
CHUNK = 1 << 18  # bytes of text looked at together: its arrays stay in a core's cache
CELLS, PAIRS = 2048, 1024  # windows counted, and candidates asked, at a time
_RUNS = SPAN // STRIDE  # cells of STRIDE words that a window has
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?")]] = True


def plain_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, ends a sentence) of each word, ASCII marks around it
    trimmed; words of marks only are left out."""
    starts, ends, doc = words(buf, off)
    stop = _STOP[buf[ends - 1]] if len(ends) else np.zeros(0, bool)
    marked = np.flatnonzero(_MARK[buf[starts]] | _MARK[buf[ends - 1]]) if len(ends) else np.zeros(0, np.int64)
    if len(marked):  # the others stay as they are
        s, e = starts[marked], ends[marked]
        for _ in range(4):
            s += (s < e) & _MARK[buf[np.minimum(s, len(buf) - 1)]]
            e -= (s < e) & _MARK[buf[e - 1]]
        starts[marked], ends[marked] = s, e
    keep = starts < ends
    return word_hashes(buf, starts[keep], ends[keep], True), doc[keep], stop[keep]


def passages(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``words`` (hashes) and ``answer``: how many of the last of
    them are the answer (0: the passage is not the end of its text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch):
                h, doc, stop = plain_words(buf, off)
                out: list[tuple] = []
                for k, item in enumerate(batch.column("doc_id").slice(lo, hi - lo).to_pylist()):
                    a, b = np.searchsorted(doc, [k, k + 1])
                    if a == b:
                        continue
                    before = np.flatnonzero(stop[a : b - 1])
                    answer = min(int(b - a), max(ANSWER, int(b - a - 1 - before[-1]) if len(before) else int(b - a)))
                    edges = np.linspace(a, b, -(-int(b - a) // PASSAGE) + 1).astype(int)
                    for x, y in zip(edges[:-1], edges[1:], strict=True):
                        out.append((item, h[x:y].view(np.int64).tolist(), min(answer, int(y - x)) if y == b else 0))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.list_(pa.int64()), pa.int32()), strict=True)], names=["item_id", "words", "answer"]
                    )

    rows = texts(benchmark, id_col="item_id").withColumn("text", F.lower("text")).distinct()
    return rows.mapInArrow(lean(run), "item_id long, words array<long>, answer int")


def vocabulary(rows: list) -> np.ndarray:
    """Sorted hashes of the terms that span the space."""
    return np.unique(np.concatenate([np.array(r.words, np.int64) for r in rows]).view(U))


def _lookup(terms: np.ndarray):
    """Number of each word in the sorted terms, or -1: terms are looked for
    from the first one with the word's leading bits."""
    shift = U(64 - min(20, len(terms).bit_length() + 5))
    head = (terms >> shift).astype(np.int64)
    first = np.searchsorted(head, np.arange(1 << (64 - int(shift)))).astype(np.int32)
    most = int(np.bincount(head).max(initial=0))  # terms that share their leading bits
    there = np.append(terms, np.repeat(terms[-1:], most))

    def of(h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        at = first[(h >> shift).astype(np.int64)]
        for k in range(most):
            hit = np.flatnonzero(there[at + k] == h)
            out[hit] = np.minimum(at[hit] + k, len(terms) - 1)
        return out

    return of


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents with each term, and all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, n = _lookup(terms), np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            for lo, hi, buf, off in chunks(batch, limit=CHUNK):
                h, doc, _ = plain_words(buf, off)
                at = of(h)
                k = np.flatnonzero(at >= 0)
                pair = np.sort(doc[k] * len(terms) + at[k])
                n[:-1] += np.bincount(pair[np.diff(pair, prepend=-1) > 0] % len(terms), minlength=len(terms))
                n[-1] += hi - lo
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], names=["term", "n"])

    got = docs.select("text").mapInArrow(lean(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms) + 1, np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()
    return out[:-1], int(out[-1])


def _row(words_: np.ndarray, of, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A passage's row of the TF-IDF matrix, of unit length."""
    at = np.unique(of(words_))
    at = at[at >= 0]
    value = weight[at]
    return at, value / max(float(np.sqrt(value @ value)), 1e-12)


def _gram(rows: DataFrame, terms: np.ndarray, weight: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A'(A m) for the TF-IDF matrix A of the passages."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((terms, weight, m))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weight, m = shared.value
        of, out, any_ = _lookup(terms), np.zeros_like(m), False
        for batch in batches:
            any_ |= batch.num_rows > 0
            for w in batch.column("words").to_pylist():
                at, value = _row(np.array(w, np.int64).view(U), of, weight)
                out[at] += np.outer(value, value @ m[at])
        for k in range(0, len(out) if any_ else 0, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([out[k : k + SLICE].tobytes()], pa.binary())], names=["slice", "part"])

    def total(table: pa.Table) -> pa.Table:
        sums = np.frombuffer(table["part"][0].as_py()).copy()
        for x in table["part"][1:]:
            sums += np.frombuffer(x.as_py())
        return pa.table([table["slice"][:1], pa.array([sums.tobytes()], pa.binary())], names=["slice", "part"])

    got = rows.select("words").mapInArrow(lean(part), "slice long, part binary").groupBy("slice").applyInArrow(total, "slice long, part binary").collect()
    out = np.zeros_like(m)
    for r in got:
        piece = np.frombuffer(r["part"]).reshape(-1, m.shape[1])
        out[r["slice"] : r["slice"] + len(piece)] = piece
    return out


def randomised_svd(rows: DataFrame, terms: np.ndarray, weight: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors (terms x at most ``rank``) of the passages."""
    width = min(rank + 8, len(terms))
    q, _ = np.linalg.qr(_gram(rows, terms, weight, np.random.default_rng(11).standard_normal((len(terms), width))))
    q, _ = np.linalg.qr(_gram(rows, terms, weight, q))
    values, vectors = np.linalg.eigh(q.T @ _gram(rows, terms, weight, q))
    keep = np.argsort(values)[::-1][:rank]
    keep = keep[values[keep] > 1e-12 * max(values.max(), 1e-300)]
    return q @ vectors[:, keep]


def common_subsequence(masks: dict[int, int], n: int, window: list[int]) -> int:
    """Length of the longest common subsequence with a passage of ``n`` words,
    given the bit mask of each of its words (bit-parallel); the plain form of
    ``common_subsequences``, which tests hold it against."""
    free = full = (1 << n) - 1
    for w in window:
        m = masks.get(w)
        if m is not None:
            u = free & m
            free = ((free + u) | (free - u)) & full
    return n - free.bit_count()


def _holds(window: list[int], part: list[int]) -> bool:
    n = len(part)
    return any(window[k : k + n] == part for k in range(len(window) - n + 1) if window[k] == part[0])


def least_words(n: int, answer: int) -> int:
    """Words of a passage of ``n`` that a leak has at least."""
    return n if n < SHORT else int(np.ceil((PARAPHRASE if answer else EXACT) * n))


def least_share(n: np.ndarray, square: np.ndarray, need: int) -> float:
    """The least share of a passage's squared weights that ``need`` of its words
    have, for terms of ``n`` words and a squared weight each (parts of a term
    count too, so this is a lower bound)."""
    order = np.argsort(square / n)
    before = np.cumsum(n[order]) - n[order]
    taken = np.clip((need - before) / n[order], 0, 1)
    return float(taken @ square[order]) / max(float(square.sum()), 1e-300)


def common_subsequences(masks: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``common_subsequence`` of many pairs at once: ``masks`` has a row for
    each word of the windows and a column for each pair (0: the word is not in
    the passage), ``length`` the passages' words, at most 64."""
    free = np.full(masks.shape[1], ~U(0))
    for m in masks:
        u = free & m
        free = (free + u) | (free - u)  # carries beyond a passage's end never come back
    return length - np.bitwise_count(free & (~U(0) >> (64 - length).astype(U))).astype(np.int64)


def previous(at: np.ndarray) -> np.ndarray:
    """Position of the word before that is the same term, or -1."""
    hit = np.flatnonzero(at >= 0)
    bits = len(at).bit_length()
    key = np.sort(at[hit] << bits | hit)
    pos, term = key & ((1 << bits) - 1), key >> bits
    same = np.flatnonzero(term[1:] == term[:-1])
    out = np.full(len(at), -1, np.int64)
    out[pos[same + 1]] = pos[same]
    return out


def window_counts(at: np.ndarray, before: np.ndarray, cell: np.ndarray, packed: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first cell, sums) of runs of cells: for the window that begins with each
    cell, the rows of ``packed`` of its distinct terms, summed.  A term counts
    in a cell once, for as many of the windows that reach it as have not met the
    term before: as many as cells have passed since, so each row is added up
    once and not for each window.  Documents are ``_RUNS - 1`` empty cells apart."""
    hit = np.flatnonzero(at >= 0)
    age = cell[hit] - np.where(before[hit] >= 0, cell[before[hit]], -_RUNS)
    levels = [(n, k := hit[age == n if n < _RUNS else age >= n], cell[k]) for n in range(1, _RUNS + 1)]
    for s in range(0, int(cell[-1]) + 1 if len(cell) else 0, CELLS):
        held = np.zeros((CELLS + 2 * (_RUNS - 1), packed.shape[1]), packed.dtype)
        for n, k, mine in levels:
            lo, hi = np.searchsorted(mine, [s, s + CELLS + _RUNS - 1])
            if lo == hi:
                continue
            begin = np.flatnonzero(np.diff(mine[lo:hi], prepend=-1))
            sums = np.add.reduceat(packed[at[k[lo:hi]]], begin, axis=0)
            row = mine[lo:hi][begin] - s + _RUNS - 1
            for back in range(n):
                held[row - back] += sums
        yield s, held[_RUNS - 1 : _RUNS - 1 + CELLS]


def find_leaks(docs: DataFrame, rows: list, terms: np.ndarray, weight: np.ndarray, space: np.ndarray) -> DataFrame:
    """Documents against one block of passages."""
    of = _lookup(terms)
    lists = [list(r.words) for r in rows]
    embedded = np.zeros((len(rows), space.shape[1]), np.float32)  # scaled so that a window's product is the share it holds
    count = np.zeros((len(terms), -(-len(rows) // 8) * 8), np.uint8)  # words of each term a passage has, at most PASSAGE
    need, share = np.full(count.shape[1], 255, np.uint8), np.zeros(len(rows))
    masks = [0]  # of a term's words in a passage, passage by passage
    for k, r in enumerate(rows):
        mine = of(np.array(r.words, np.int64).view(U))
        at, n = np.unique(mine, return_counts=True)
        value = weight[at]
        embedded[k] = value @ space[at] / max(float(value @ value), 1e-300)
        count[at, k] = n
        need[k] = least_words(len(r.words), r.answer)
        share[k] = least_share(n, value * value, int(need[k])) - SLACK
        masks += [sum(1 << int(j) for j in np.flatnonzero(mine == x)) for x in at]
    latent = (weight[:, None] * space).astype(np.float32)
    model = (terms, latent, embedded, count, need, share, np.array(masks, U), [r.item_id for r in rows], lists, np.array([r.answer for r in rows]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, latent, embedded, count, need, least, masks, items, lists, answers = shared.value
        of, packed = _lookup(terms), count.view(np.uint64)  # eight passages' counts are added at once: none passes a byte
        length = np.array([len(w) for w in lists])
        # of each term, and of no term, with each passage: their product in the space, the place of the mask
        product, slot = (np.zeros((len(terms) + 1, len(lists)), t) for t in (np.float32, np.uint16))
        product[:-1] = latent @ embedded.T
        slot[:-1].T[count[:, : len(lists)].T > 0] = np.arange(1, len(masks))
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, buf, off in chunks(batch, limit=CHUNK):
                h, doc, _ = plain_words(buf, off)
                at = of(h)
                if not (at >= 0).any():
                    continue
                size = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(size) - size
                n_cells = np.maximum(-(-size // STRIDE), 1)  # a window begins with each, the last ones are shorter
                base = np.cumsum(n_cells + _RUNS - 1) - n_cells
                before = previous(at)
                cell = np.repeat(base, size) + (np.arange(len(h)) - np.repeat(first, size)) // STRIDE
                term = np.append(np.where(at < 0, len(terms), at), np.full(SPAN, len(terms)))
                met = np.append(before, np.full(SPAN, -1))
                best: dict[tuple[int, int], tuple] = {}
                for s, held in window_counts(at, before, cell, packed):
                    near = np.flatnonzero(held.view(np.uint8) >= need)
                    for x in range(0, len(near), PAIRS):
                        window, ks = near[x : x + PAIRS] // len(need) + s, near[x : x + PAIRS] % len(need)
                        d = np.searchsorted(base, window, side="right") - 1
                        real = (d >= 0) & (window - base[d] < n_cells[d])  # others begin between documents
                        window, ks, d = window[real], ks[real], d[real]
                        start = (window - base[d]) * STRIDE
                        begin, end = first[d] + start, first[d] + np.minimum(start + SPAN, size[d])
                        at_word = begin + np.arange(SPAN)[:, None]
                        within = np.where(at_word < end, term[at_word], len(terms))
                        # the share of a window's projection, term by term
                        asked = (product[within, ks] * (met[at_word] < begin)).sum(axis=0) >= least[ks]
                        within, ks, d, start, begin, end = within[:, asked], ks[asked], d[asked], start[asked], begin[asked], end[asked]
                        lcs, n = common_subsequences(masks[slot[within, ks]], length[ks]), length[ks]
                        sure = (n >= SHORT) & (lcs >= EXACT * n)
                        maybe = np.where(n < SHORT, lcs == n, (lcs >= PARAPHRASE * n) & (answers[ks] > 0))
                        for i in np.flatnonzero(sure | maybe).tolist():
                            k, there = int(ks[i]), within[: end[i] - begin[i], i]
                            if not sure[i] and not _holds(h[begin[i] : end[i]].view(np.int64).tolist(), lists[k][0 if n[i] < SHORT else -int(answers[k]) :]):
                                continue
                            whole = np.unique(there[there < len(terms)])
                            part = float((np.add.reduceat(latent[whole], [0], axis=0)[0] * embedded[k]).sum())
                            inside = np.flatnonzero(slot[there, k])
                            found = (int(lcs[i]) / int(n[i]), int(lcs[i]), int(n[i]), min(max(part, 0.0), 1.0) ** 0.5, int(start[i] + inside[0]), int(inside[-1] - inside[0] + 1))
                            key = (int(d[i]), items[k])
                            if key not in best or found[:2] > best[key][:2]:
                                best[key] = found
                if best:
                    doc_ids = ids.slice(lo, hi - lo).to_pylist()
                    out = [(doc_ids[d], item, *v) for (d, item), v in best.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(lean(run), _SCHEMA)


_NAMES = ["doc_id", "item_id", "share", "common_words", "passage_words", "cosine", "start_word", "n_words"]
_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
_SCHEMA = "doc_id long, item_id long, share double, common_words long, passage_words long, cosine double, start_word long, n_words long"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Leaks of all passages in all documents."""
    docs = texts(docs).withColumn("text", F.lower("text"))
    rows = passages(benchmark).withColumn("one", F.lit(0))
    rows = materialise(numbered(rows, "one", ["item_id"], ["item_id", "words"], 8, "number").drop("one"))
    out = None
    for block in range(-(-rows.count() // BLOCK)):
        mine = rows.where(F.floor(F.col("number") / BLOCK) == block).coalesce(4)  # a few hundred rows
        local = mine.orderBy("number").collect()
        terms = vocabulary(local)
        n, total = document_frequencies(docs, terms)
        weight = np.log((total + 1) / (n + 1)) + 0.1
        space = randomised_svd(mine, terms, weight, len(local))
        found = find_leaks(docs, local, terms, weight, space)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    # passages of one long item meet here: its best one stays
    best = F.max(F.struct("share", "common_words", "passage_words", "cosine", "start_word", "n_words")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without a leak."""
    leaks = contamination(docs, benchmark).select(F.struct("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, F.struct(docs["doc_id"].cast("long").alias("doc_id")) == F.col("_leak"), "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
