"""Words, windows and their hashes over many texts at once, as arrays.

A hash of a run of items is a polynomial in a fixed random base over the items' values, modulo the prime 2^61 - 1, taken from one
running sum, so every window of a text costs the same few array steps whatever its length; a final mix spreads it over 64 bits. Modulo a
prime two different runs of n items agree for at most n of the 2^61 bases, whatever their structure. (Modulo a power of two, runs in
Thue-Morse order agree for every base.) A second base makes 122 bits where a corpus has too many runs for one.
Memory is about 100 bytes per byte of the longest single text.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
PRIME = (1 << 61) - 1
_P, _M30, _M31 = U(PRIME), U((1 << 30) - 1), U((1 << 31) - 1)
# Random bases, the first for all hashes, the second for a second opinion.
BASES = (0x0D6E8FEB86659FD9, 0x12C4A7E59B3F1D07)
_powers: dict[tuple[int, bool], np.ndarray] = {}

# Bytes of a word: all but white space, or letters and digits with every byte of a character beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, in place."""
    high = x >> U(61)
    x &= _P
    x += high
    return np.subtract(x, _P, out=x, where=x >= _P)


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for a < 2^62 and b < 2^61: halves of 31 bits, with 2^62 = 2 and 2^61 = 1."""
    a1, a0, b1, b0 = a >> U(31), a & _M31, b >> U(31), b & _M31
    middle = a1 * b0
    middle += a0 * b1
    a1 *= b1
    a1 <<= U(1)
    a0 *= b0
    a0 += a1
    a0 += middle >> U(30)
    middle &= _M30
    middle <<= U(31)
    a0 += middle
    return _fold(a0)


def powers(n: int, inverse: bool = False, lane: int = 0) -> np.ndarray:
    """Powers 0 to n of a base, or of its inverse."""
    known = _powers.get((lane, inverse))
    if known is None:
        base = BASES[lane]
        known = np.array([1, pow(base, -1, PRIME) if inverse else base], U)
    while len(known) <= n:
        # The last power times the first is the step from one half to the next.
        step = multiply(known[-1:], known[1:2])
        known = np.concatenate([known, multiply(known, np.broadcast_to(step, known.shape))])
    _powers[lane, inverse] = known
    return known[:n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective spreading of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def running(values: np.ndarray, small: bool = False, lane: int = 0) -> np.ndarray:
    """Running sum modulo the prime of values times powers, with a leading 0; `small` promises values under 2^30."""
    up = powers(len(values), lane=lane)[:-1]
    if small:
        terms = values * (up >> U(31))
        low = terms & _M30
        low <<= U(31)
        terms >>= U(30)
        terms += low
        terms += values * (up & _M31)
    else:
        terms = multiply(values & _P, up)
    # Halves of 32 bits are summed on their own; neither sum overflows.
    high = np.cumsum(terms >> U(32), dtype=U)
    low = np.cumsum(terms & U(0xFFFFFFFF), dtype=U)
    low += high >> U(29)
    high &= U((1 << 29) - 1)
    high <<= U(32)
    low += high
    out = np.zeros(len(values) + 1, U)
    out[1:] = _fold(low)
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of each [start, end) from a running sum."""
    down = powers(len(sums) - 1, True, lane)
    return mix(multiply(sums[end] + (_P - sums[start]), down[start]))


def byte_sums(data: np.ndarray, lane: int = 0) -> np.ndarray:
    """Running sum over bytes."""
    return running(data.astype(U) + U(1), small=True, lane=lane)


class Words:
    """Maximal runs of word bytes: start, end (byte positions), hash, offsets of each text's words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, word_bytes: np.ndarray = NOT_SPACE):
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        inside = word_bytes[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.hash = spans_hash(byte_sums(data), self.start, self.end)
        self.offsets = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.offsets))

    def windows(self, size: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of `size` words inside one text."""
        at = np.arange(len(self.start))
        at = at[at + size <= self.offsets[self.doc + 1]]
        return at, spans_hash(running(self.hash, lane=lane), at, at + size, lane)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask over n items covered by [s, s + length) of any start."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:-1]) > 0


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges [start, start + length), one range after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)
