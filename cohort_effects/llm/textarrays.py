"""Whole texts as numpy arrays, straight from Arrow buffers.

A task gets record batches; ``chunks`` hands them on as byte buffers of about
a megabyte (a longer document is a chunk of its own), so the memory of a task
follows its longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
# Word separators of the contracts: space and the controls 09 to 0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
ODD = _rng.integers(1, 2**63, 512, dtype=np.int64).astype(U) * U(2) + U(1)
_P = U(0x9E3779B97F4A7C15)
_P_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_P**0.._P**(n-1) and their inverses modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in a new array)."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    texts = batch.column(column)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word of a chunk."""
    n = len(buf)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    sep = SEPARATOR[buf]
    edge = np.empty(n, bool)
    edge[0], edge[1:] = True, sep[:-1]
    edge[off[:-1][off[:-1] < n]] = True
    starts = np.flatnonzero(edge & ~sep)
    edge[-1], edge[:-1] = True, sep[1:]
    edge[off[1:][off[1:] > 0] - 1] = True
    ends = np.flatnonzero(edge & ~sep) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """64-bit hash of each word; ``fold`` reads A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, U)
    power, inverse = powers(len(buf))
    total = np.zeros(len(buf) + 1, U)
    np.cumsum((_FOLDED if fold else _BYTE)[buf] * power, out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(U) * ODD[511])


def shingle_hashes(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every run of ``k`` words inside one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    x = h[:n] * ODD[0]
    for j in range(1, k):
        x += h[j : j + n] * ODD[j]
    return mix(x)[at], at


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values (by doubling)."""
    done, m = 1, a
    while done * 2 <= w:
        m = np.minimum(m[: len(m) - done], m[done:])
        done *= 2
    return np.minimum(m[: len(m) - (w - done)], m[w - done :]) if done < w else m


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, str], payload: str, limit: int) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a partition sorted by ``keys`` (integer
    columns), each of about ``limit`` bytes of ``payload`` or one larger group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):  # one batch can be far over the limit
            part = batch.slice(lo, 4096)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(payload))).as_py() or 0
            if size < limit:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            a, b = (table[k].to_numpy() for k in keys)
            change = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            if not len(change):  # one group still: look again after as much more
                held, size = table.to_batches(), 0
                continue
            cut = int(change[-1]) + 1
            yield table.slice(0, cut)
            held, size = table.slice(cut).to_batches(), 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
