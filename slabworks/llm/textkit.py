"""Vectorised work on batches of UTF-8 texts: slices, words, hashes of spans.

All functions take whole texts as one byte array with offsets, as Arrow stores them; nothing loops over bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer text is one slice.
SLICE = 1 << 19

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

#: ASCII white space: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose low and high bits both depend on all bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))
_powers = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if len(_powers[0]) < n:
        m = max(n, SLICE + 1)
        _powers[:] = [_geometric(_BASE, m), _geometric(_INV, m)]
    return _powers[0][:n], _powers[1][:n]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and n + 1 offsets into them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def slices(col: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) in slices of about ``limit`` bytes; every row is in one slice."""
    raw, at = utf8(col)
    lo, n = 0, len(col)
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def runs(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True in ``mask``, cut at the document offsets ``at``."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = mask[:-1]
    before[at[:-1][at[:-1] < n]] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = at[1:][at[1:] > 0] - 1
    after[ends] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def document_of(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(at, starts, side="right") - 1


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the words: maximal runs without ASCII white space."""
    starts, ends = runs(~SPACE[data], at)
    return starts, ends, document_of(starts, at)


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A value for the ``width`` bytes from each place, modulo 2**64: to choose places by, never to compare contents."""
    n = len(data) - width + 1
    prefix = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE[data] * powers(len(data))[0], dtype=U64, out=prefix[1:])
    return mix((prefix[width:] - prefix[:n]) * powers(len(data))[1][:n])


# The hash that contents are compared by is a polynomial modulo a prime: modulo 2**64 some pairs of texts collide
# whatever the base (a Thue-Morse sequence of 1,024 letters and its complement).
_P = (1 << 61) - 1
_BASES = (0x1B9D0E4F3A7C5826, 0x0C6A1F5D93E2B74D)
_BLOCK = 1 << 22
_tables: dict[int, list[np.ndarray]] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo P."""
    x = (x & U64(_P)) + (x >> U64(61))
    return np.where(x >= U64(_P), x - U64(_P), x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo P, for values below P."""
    low = U64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> U64(31), a & low, b >> U64(31), b & low
    mid = a1 * b0 + a0 * b1
    return _fold(U64(2) * a1 * b1 + (mid >> U64(30)) + ((mid & U64((1 << 30) - 1)) << U64(31)) + a0 * b0)


def _prime_powers(base: int, n: int) -> list[np.ndarray]:
    """High and low halves of base**i and the whole of base**-i modulo P, for i < n."""
    if base not in _tables or len(_tables[base][2]) < n:
        m = max(n, SLICE + 1)
        both = []
        for b in (base % _P, pow(base, -1, _P)):
            out = np.ones(m, dtype=U64)
            k = 1
            while k < m:
                step = np.full(1, pow(b, k, _P), dtype=U64)
                out[k : 2 * k] = _times(out[: min(k, m - k)], step)
                k *= 2
            both.append(out)
        _tables[base] = [(both[0] >> U64(31)).astype(np.uint32), (both[0] & U64((1 << 31) - 1)).astype(np.uint32), both[1]]
    return _tables[base]


class Spans:
    """64-bit values of any spans of one byte array: equal spans get equal values wherever they stand.

    Two given spans that differ collide with a chance of about their length in 2**61, for each of the two bases.
    """

    def __init__(self, data: np.ndarray, base: int = 0):
        high, low, self.inverse = _prime_powers(_BASES[base], len(data) + 1)
        symbols = data.astype(U64) + U64(1)
        self.sums = []
        for powers_ in (high, low):
            out = np.zeros(len(data) + 1, dtype=U64)
            for a in range(0, len(data), _BLOCK):  # a block's sums stay below 2**61
                part = out[a + 1 : a + _BLOCK + 1]
                np.cumsum(symbols[a : a + _BLOCK] * powers_[a : a + len(part)], out=part)
                part += _fold(out[a : a + 1])
            self.sums.append(out)

    def _at(self, places: np.ndarray) -> np.ndarray:
        high, low = (_fold(s[places]) for s in self.sums)
        return _fold(((high & U64((1 << 30) - 1)) << U64(31)) + (high >> U64(30)) + low)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        span = _fold(self._at(ends) + U64(_P) - self._at(starts))
        return mix(_times(span, self.inverse[starts]) + (ends - starts).astype(U64) * U64(_BASE))


def same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bool:
    """Whether the n bytes from each a are those from the b beside it."""
    cut = np.searchsorted(np.cumsum(n), np.arange(0, n.sum() + 1, SLICE), side="right")
    for lo, hi in zip(cut, [*cut[1:], len(n)]):
        k = n[lo:hi]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        if (data[np.repeat(a[lo:hi], k) + step] != data[np.repeat(b[lo:hi], k) + step]).any():
            return False
    return True


def window_hash(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every k values in a row (len - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for j in range(k):
        out = out * U64(_BASE) + values[j : j + n]
    return mix(out)
