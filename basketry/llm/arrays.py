"""Text columns as byte arrays inside tasks: chunks, words, hashes, hash-bucket messages.

Everything here works on one bounded chunk of Arrow rows in numpy; Spark
partitions, shuffles and retries the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
#: Bytes hashed at a time.
HASH_BLOCK = 1 << 16
_SPACES = (0x20, 9, 10, 11, 12, 13)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: words are runs of anything but white space
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[list(_SPACES)] = False

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(0, 2**62)) * 4 + 3
_INVERSE = pow(_BASE, -1, 2**64)
#: one odd factor per place in a window of words
PLACES = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i up to n, kept per worker for block-sized n."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = max(n, 2 * HASH_BLOCK)
        got = np.full(size, base, dtype=np.uint64)
        got[0] = 1
        got = np.cumprod(got, dtype=np.uint64)
        if size <= 4 * HASH_BLOCK:
            _POWERS[base] = got
    return got


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chunks(batches: Iterator[pa.RecordBatch], text_col: str = "text", size: int = CHUNK_BYTES, rows: int = 60_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text and at most ``rows`` rows, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            below = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, below + size, side="right")))
            stop = min(stop, start + rows)
            yield batch.slice(start, stop - start)
            start = stop


def even_chunks(batches: Iterator[pa.RecordBatch], text_col: str = "text", size: int = CHUNK_BYTES, rows: int = 60_000) -> Iterator[pa.RecordBatch]:
    """Like ``chunks``, but over the ends of batches: where one is cut depends on its rows alone, however Spark batches them."""
    held, n_bytes, n_rows = [], 0, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            below = ends[start - 1] if start else 0
            stop = min(int(np.searchsorted(ends, below + size - n_bytes, side="right")), start + rows - n_rows)
            if not held:
                stop = max(stop, start + 1)  # one row at least
            if stop > start:
                held.append(batch.slice(start, stop - start))
                n_bytes, n_rows, start = n_bytes + int(ends[stop - 1] - below), n_rows + stop - start, stop
            if start < batch.num_rows:
                yield pa.concat_batches(held)
                held, n_bytes, n_rows = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows are empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, starts, ends, first word of each document and the total): runs of word bytes, cut at documents."""
    low = FOLD[data]
    inside = is_word[low]
    if not len(low):
        none = np.zeros(0, dtype=np.int64)
        return low, none, none, np.zeros(len(offsets), dtype=np.int64)
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes (in order, apart), from prefix sums of a polynomial over the runs of one block at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            at = int(starts[i])
            j = int(np.searchsorted(starts, at + HASH_BLOCK))  # the runs that start in the block
            s, e = starts[i:j] - at, ends[i:j] - at
            size = int(e[-1])
            total = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(_BYTE[low[at:at + size]] * _powers(_BASE, size)[:size], out=total[1:])
            out[i:j] = mix((total[e] - total[s]) * _powers(_INVERSE, size + 1)[s] + (e - s).astype(np.uint64))
            i = j
    return out


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every window of ``width`` words; a shorter document, unless empty, is one window."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    full = np.zeros(n, dtype=bool)
    if n >= width:
        full[:n - width + 1] = doc[:n - width + 1] == doc[width - 1:]
    with np.errstate(over="ignore"):
        acc = np.zeros(max(0, n - width + 1), dtype=np.uint64)
        for k in range(width):
            acc += hashes[k:k + len(acc)] * PLACES[k]
        out, owner = acc[full[:len(acc)]], doc[:len(acc)][full[:len(acc)]]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            extra = np.zeros(len(short), dtype=np.uint64)
            for k in range(width - 1):
                has = counts[short] > k
                extra[has] += hashes[first[short][has] + k] * PLACES[k]
            extra = mix(extra + counts[short].astype(np.uint64), 7)
            at = np.searchsorted(owner, short)
            out, owner = np.insert(out, at, extra), np.insert(owner, at, short)
    return mix(out, 1), owner


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows with the same key, from batches sorted by it."""
    held, current = [], None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[a] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def of(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(data, dtype=kind)


def stretches(x: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of each run of equal values."""
    if not len(x):
        return []
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return list(zip(at.tolist(), [*at[1:].tolist(), len(x)], strict=True))
