"""Word and shingle hashes of whole batches of texts, as numpy arrays over the batch's UTF-8 bytes.

A word's hash is a polynomial over its bytes modulo 2^64, read off one running sum for all words of the
batch; a shingle's hash combines those of its words. Memory is a small multiple of the batch's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer text is handled alone.
BLOCK_BYTES = 1_000_000

_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: all but white space; and digits, letters and everything beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^j and P^-j for j < n, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def blocks(texts: pa.Array, most: int = BLOCK_BYTES):
    """``first, bytes, offsets`` of consecutive runs of texts of at most ``most`` bytes (or one text); null is
    empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray):
    """``starts, ends, hashes, per_doc``: byte bounds and hash of each word of the lower-cased bytes, and where
    each document's words begin (one more entry than documents)."""
    low = LOWER[data]
    inside = alphabet[low]
    n = len(low)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    ends[before] = inside[before]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(ends) + 1
    return starts, ends, range_hashes(running(low), starts, ends), np.searchsorted(starts, offsets)


def running(low: np.ndarray) -> np.ndarray:
    """The running sum that range_hashes reads from."""
    up, _ = powers(len(low))
    sums = np.empty(len(low) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[low] * up[: len(low)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end): equal for equal bytes, wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on; the last ``size - 1`` positions have none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total = total * _P + hashes[k : k + n]
    return mix(total)
