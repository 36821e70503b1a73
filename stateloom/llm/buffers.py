"""Arrow text columns as numpy byte arrays: chunks, words and 64-bit fingerprints.

Everything here works on UTF-8 bytes. All ASCII classes (blanks, letters, digits) can be told from
single bytes, and every byte of a longer character is 0x80 or above, so byte masks are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 2 << 20

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n, kept for the next call."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1 of them, from 0) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if n == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 4096
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs lo..hi of at most `rows` rows and `limit` bytes (or one longer row): lo, hi, bytes, offsets."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes, never across rows; and the first word of each row.

    The last array has one entry more than there are rows.
    """
    inside = is_word[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    after = np.empty(len(data) + 1, bool)
    after[-1], after[:-1] = False, inside
    cuts = offsets[1:-1]
    before[cuts] = False
    after[cuts] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * BASE**i before each place; spans of equal bytes differ by a power only."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data) or 1)[0][: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the bytes of each span, the same wherever the span stands."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
