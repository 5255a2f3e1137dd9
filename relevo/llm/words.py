"""Words and word hashes of an Arrow text column, vectorised with numpy.

A word is a run of bytes other than space and ``\t\n\v\f\r`` (the pattern
``[^\\x20\\x09-\\x0D]+``: every other byte of UTF-8 belongs to a word), after
lower-casing ``A-Z``.  A word's hash is a polynomial over 64-bit byte codes,
read off one prefix sum for a whole block of texts, then mixed.  Texts are
taken in blocks of about ``BLOCK`` bytes, so the arrays stay small whatever
the batch or a single text holds.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= _M1
    x ^= x >> U(27)
    x *= _M2
    x ^= x >> U(31)
    return x


_CODE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, up to ``n``."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, b, U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U)
    return _powers


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its ``n + 1`` offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if big else np.int32)[col.offset:col.offset + len(col) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d, o.astype(np.int64)


class Words:
    """The words of ``n`` consecutive texts, the first being row ``lo``.

    ``start``/``end``: byte spans in ``data``; ``ptr``: text ``i`` has the
    words ``ptr[i]:ptr[i + 1]``; ``offs``: byte offsets of the texts.
    """

    __slots__ = ("lo", "n", "data", "offs", "start", "end", "ptr")

    def __init__(self, lo: int, data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE):
        self.lo, self.n, self.data, self.offs = lo, len(offs) - 1, data, offs
        word = ~space[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        at = offs[1:-1]
        at = at[(at > 0) & (at < len(data))]  # neighbouring texts do not share a word
        first[at] = word[at]
        last[at - 1] = word[at - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.ptr = np.searchsorted(self.start, offs)

    def __len__(self) -> int:
        return len(self.start)

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        power, inverse = _power_tables(len(self.data) + 1)
        s = np.zeros(len(self.data) + 1, U)
        np.cumsum(_CODE[LOWER[self.data]] * power[:len(self.data)], out=s[1:])
        return s, inverse

    def hashes(self) -> np.ndarray:
        s, inverse = self._sums()
        return mix((s[self.end] - s[self.start]) * inverse[self.start])

    def stems(self, lengths: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the words, then of their first ``length`` bytes (of the
        whole word where it is shorter), each kind apart from the others."""
        s, inverse = self._sums()
        ends = [self.end, *(np.minimum(self.end, self.start + n) for n in lengths)]
        return [mix((s[e] - s[self.start]) * inverse[self.start] + U(k)) for k, e in enumerate(ends)]

    def rows(self) -> np.ndarray:
        """The text (from 0) of each word."""
        return np.repeat(np.arange(self.n), np.diff(self.ptr))

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Byte positions in ``data`` as code-point offsets within their text."""
        lead = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=lead[1:])
        text = np.searchsorted(self.offs, at, "right") - 1
        text = np.clip(text, 0, max(self.n - 1, 0))
        return lead[at] - lead[self.offs[text]]


def blocks(col: pa.Array, size: int = BLOCK, space: np.ndarray = SPACE) -> Iterator[Words]:
    """Split a text column into blocks of whole texts of about ``size`` bytes."""
    data, offs = utf8(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Words(lo, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], space)
        lo = hi


def _coefficients(width: int) -> np.ndarray:
    return mix(np.arange(1, width + 1, dtype=U) * U(0xD1B54A32D192ED03)) | U(1)


def shingles(h: np.ndarray, ptr: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word runs of each text, and their offsets.

    A text with fewer words has its whole sequence as its only run; a text
    without words has none.
    """
    c = _coefficients(width)
    m = np.diff(ptr)
    runs = np.where(m >= width, m - width + 1, (m > 0).astype(m.dtype))
    out = np.zeros(len(m) + 1, np.int64)
    np.cumsum(runs, out=out[1:])
    first = np.arange(out[-1]) - np.repeat(out[:-1], runs) + np.repeat(ptr[:-1], runs)
    length = np.repeat(np.minimum(m, width), runs)
    g = length.astype(U) * c[-1]
    for j in range(width):
        has = j < length
        g += np.where(has, h[np.where(has, first + j, 0)], U(0)) * c[j] if len(h) else U(0)
    return mix(g), out
