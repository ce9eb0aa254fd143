"""Arrow string columns as numpy arrays, and hashes of all their words at once.

A word's hash is a polynomial in fixed pseudo-random byte values, evaluated
for all words of a piece by differences of one running sum (mod 2**64) and then
mixed. Pieces are cut between words, so memory does not grow with a text.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 19
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse mod 2**64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(separators: np.ndarray) -> np.ndarray:
    """uint64 value of each byte: 0 for separators, A-Z as a-z, else odd and random."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER)) | np.uint64(1)
    table[65:91] = table[97:123]
    table[separators] = 0
    return table


def alnum_words() -> np.ndarray:
    """Words of digits, letters and everything beyond ASCII."""
    b = np.arange(256)
    return byte_values((b < 0x30) | ((b >= 0x3A) & (b <= 0x40)) | ((b >= 0x5B) & (b <= 0x60))
                       | ((b >= 0x7B) & (b <= 0x7F)))


def spaced_words() -> np.ndarray:
    """Words between ASCII white space."""
    b = np.arange(256)
    return byte_values((b == 0x20) | ((b >= 9) & (b <= 13)))


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of an Arrow string column (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = "large" in str(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


class Words:
    """Finds and hashes the words of many texts; ``table`` is from above."""

    def __init__(self, table: np.ndarray, prefixes: tuple[int, ...] = ()):
        self.table, self.prefixes = table, prefixes
        self.length = 0
        self._grow(PIECE)

    def _grow(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            p = np.full(n, base % 2**64, np.uint64)
            p[0] = 1
            return np.cumprod(p, dtype=np.uint64)

        self.power, self.inverse, self.length = powers(MULTIPLIER), powers(pow(MULTIPLIER, -1, 2**64)), n

    def _cuts(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
        lo, end = int(at[0]), int(at[-1])
        while lo < end:
            hi = lo + PIECE
            if hi >= end:
                yield lo, end
                return
            edge = int(at[np.searchsorted(at, hi, "right") - 1])  # a text begins here
            gaps = np.flatnonzero(self.table[data[max(lo, hi - 4096):hi]] == 0)
            gap = max(lo, hi - 4096) + int(gaps[-1]) + 1 if len(gaps) else lo
            cut = max(edge, gap)
            if cut <= lo:  # one word fills the piece: go on to its end
                cut = int(at[np.searchsorted(at, hi, "left")])
                while hi < cut:
                    gaps = np.flatnonzero(self.table[data[hi:min(cut, hi + PIECE)]] == 0)
                    if len(gaps):
                        cut = hi + int(gaps[0]) + 1
                    hi += PIECE
            yield lo, cut
            lo = cut

    def __call__(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces ``(starts, ends, hashes)`` of all words, in order; positions in
        ``data``. For each of ``prefixes`` an array more: hashes of the first so
        many bytes of longer words, 0 for others."""
        for lo, hi in self._cuts(data, at):
            n = hi - lo
            if n > self.length:
                self._grow(n)
            value = self.table[data[lo:hi]]
            inside = value != 0
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            begin = at[np.searchsorted(at, lo, "left"):np.searchsorted(at, hi, "left")] - lo
            first[begin] = inside[begin]
            begin = begin[begin > 0]
            last[begin - 1] = inside[begin - 1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            total = np.cumsum(value * self.power[:n], dtype=np.uint64)
            h = total[e - 1] - total[s] + value[s] * self.power[s]
            more = []
            for k in self.prefixes:
                longer = e - s > k
                part = (total[np.minimum(s + k, n) - 1] - total[s] + value[s] * self.power[s]) * self.inverse[s]
                more.append(np.where(longer, mix64(part + np.uint64(k)), np.uint64(0)))
            yield s + lo, e + lo, mix64(h * self.inverse[s]), *more

    def all(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, ends, hashes, ...)`` of a whole batch."""
        parts = list(self(data, at))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * (1 + len(self.prefixes))
        return tuple(np.concatenate(p) for p in zip(*parts))


def blocks(batch, rows_bytes: int = 8 << 20):
    """Slices of an Arrow batch of about ``rows_bytes`` text bytes (one row at least)."""
    _, at = strings(batch.column(batch.schema.names.index("text")))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + rows_bytes, "right")) - 1)
        yield batch.slice(lo, min(hi, n) - lo)
        lo = hi
