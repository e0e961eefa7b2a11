"""Array kernels over text used inside Arrow batches: words, word shingles, rolling byte grams, anchors.

All of them look at whole texts. Work arrays are several times the size of the bytes they cover, so batches are cut into
runs of documents of about ``RUN_BYTES``; a longer text is a run of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
U = np.uint64

# What this Python process keeps from one task to the next of the same operator.
kept: dict = {}


def release() -> None:
    """Give freed memory back to the system: Spark keeps idle Python processes, and what they hold is missing elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(work: Callable, keep: bool = False) -> Callable:
    """``work`` on the batches of a task, with freed memory given back at its end. What other operators left in ``kept`` goes first, unless ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            kept.clear()
        try:
            yield from work(batches)
        finally:
            release()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


# One random value for each byte; ASCII capitals share the value of their small letter.
_BYTE = stream(256, 11)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
# Bytes that belong to a word: ASCII letters and digits, and every byte of a non-ASCII character.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, RUN_BYTES + 64)
        known = np.full(size, base, dtype=U)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 4 * RUN_BYTES:
            _powers[base] = known
    return known[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, starts


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a batch into (first, end) runs of documents of about ``limit`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, documents' first word) of the words in ``data``; ``bounds`` are the documents' byte bounds from 0.

    A word is a maximal run of ASCII letters, digits and non-ASCII bytes; ASCII case is ignored.
    """
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(U), empty, empty, np.zeros(len(bounds), dtype=np.int64)
    inside = _IN_WORD[data]
    change = np.empty(len(data) + 1, dtype=bool)
    change[0], change[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=change[1:-1])
    first = inside.copy()
    first[1:] &= change[1:-1]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    first[cut] = inside[cut]  # a word never runs on into the next document
    starts = np.flatnonzero(first)
    last = np.zeros(len(data), dtype=bool)
    last[:-1] = inside[:-1] & change[1:-1]
    last[-1] = inside[-1]
    last[cut - 1] = inside[cut - 1]
    ends = np.flatnonzero(last) + 1
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(_FOLDED[data] * powers(_BASE, len(data)), out=total[1:])
    hashes = mix((total[ends] - total[starts]) * powers(_BASE_INVERSE, len(data))[starts])
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of the ``n``-word windows of one document, in order; none if it has fewer words."""
    count = len(hashes) - n + 1
    if count < 1:
        return np.zeros(0, dtype=U)
    total = np.zeros(count, dtype=U)
    for i in range(n):
        total = (total + hashes[i : i + count]) * U(0x9FB21C651E98DF25 + 2 * i)
        total ^= total >> U(29)
    return mix(total)


def running(data: np.ndarray) -> np.ndarray:
    """What ``spans`` and ``gram_hashes`` of one text are taken from; pass it on if both are."""
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=total[1:])
    return total


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """Hash of the bytes from each start to its end, which also tells lengths apart."""
    total = running(data) if total is None else total
    return mix((total[ends] - total[starts]) * powers(_BASE_INVERSE, len(data))[starts] + (ends - starts).astype(U))


def gram_hashes(data: np.ndarray, k: int, total: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``k`` bytes that start at each position (the last k - 1 positions have none)."""
    count = len(data) - k + 1
    if count < 1:
        return np.zeros(0, dtype=U)
    total = running(data) if total is None else total
    return mix((total[k:] - total[:-k]) * powers(_BASE_INVERSE, len(data))[:count])


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` consecutive grams, where the smallest of them starts (the last one of equals)."""
    count = len(hashes) - window + 1
    if count < 1:
        return np.zeros(0, dtype=np.int64)
    found = []
    block = 60_000  # places within a block fit the low 16 bits that the keys give up
    for start in range(0, count, block):
        part = hashes[start : min(start + block, count) + window - 1]
        low = (part & ~U(0xFFFF)) | np.arange(0xFFFF, 0xFFFF - len(part), -1, dtype=U)
        width = 1
        while width * 2 <= window:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < window:
            low = np.minimum(low[: width - window], low[window - width :])
        found.append(start + 0xFFFF - (low & U(0xFFFF)).astype(np.int64))
    return np.concatenate(found) if len(found) > 1 else found[0]


def document_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text, in order."""
    data, offsets = utf8(column)
    for first, end in runs(offsets):
        bounds = offsets[first : end + 1] - offsets[first]
        hashes, _, _, at = words(data[offsets[first] : offsets[end]], bounds)
        for a, b in zip(at[:-1], at[1:]):
            yield hashes[a:b]
