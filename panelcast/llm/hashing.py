"""Hashes of many byte ranges at once, and a table from them to places."""

from __future__ import annotations

import numpy as np

P = np.uint64((1 << 61) - 1)
#: A number drawn below the modulus; the base of every polynomial.
BASE = 0x0E3779B97F4A7C15 % int(P)
#: Bytes hashed at a time; longer ranges are put together from parts.
BLOCK = 1 << 19
_LOW, _MID = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_U1, _U30, _U31, _U61 = (np.uint64(k) for k in (1, 30, 31, 61))


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2**61 - 1."""
    x = (x & P) + (x >> _U61)
    return np.where(x >= P, x - P, x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1 of numbers below it, in halves that do not overflow."""
    a1, a0, b1, b0 = a >> _U31, a & _LOW, b >> _U31, b & _LOW
    mid = a0 * b1 + a1 * b0
    return reduced(a1 * b1 * np.uint64(2) + (mid >> _U30) + ((mid & _MID) << _U31) + a0 * b0)


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of the base, by doubling."""
    out, have = np.ones(max(n, 1), np.uint64), 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = product(out[:more], np.uint64(pow(base, have, int(P))))
        have += more
    return out[:n]


class _Tables:
    low = high = down = np.ones(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Halves of the base's powers, and the powers of its inverse."""
        if len(cls.down) < n:
            up = powers(BASE, n)
            cls.low, cls.high, cls.down = up & _LOW, up >> _U31, powers(pow(BASE, -1, int(P)), n)
        return cls.low[:n], cls.high[:n], cls.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of each range, by differences of prefix sums over a few blocks at most."""
    low, high, down = _Tables.get(len(data) + 1)
    value = data.astype(np.uint64) + _U1
    sums = np.zeros((2, len(data) + 1), np.uint64)
    np.cumsum(value * low[:-1], out=sums[0, 1:])
    np.cumsum(value * high[:-1], out=sums[1, 1:])
    low_part, high_part = (reduced(s[ends] - s[starts]) for s in sums)
    turned = ((high_part << _U31) & P) | (high_part >> _U30)  # times 2**31
    return product(reduced(low_part + turned), down[starts])


def _long(data: np.ndarray, start: int, end: int) -> int:
    """The polynomial of one long range, part by part."""
    total = 0
    for at in range(start, end, BLOCK):
        part = data[at : min(end, at + BLOCK)]
        total += int(_polynomials(part, np.array([0]), np.array([len(part)]))[0]) * pow(BASE, at - start, int(P))
    return total % int(P)


def range_polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp fingerprints modulo 2**61 - 1 of byte ranges [start, end), whose starts ascend; they may overlap.

    Equal bytes have equal fingerprints wherever they are; other bytes meet
    with a chance of their length in 2**61, unless made for this base.
    """
    out, at = np.empty(len(starts), np.uint64), 0
    lengths = ends - starts
    while at < len(starts):
        if lengths[at] > BLOCK:
            out[at], at = _long(data, int(starts[at]), int(ends[at])), at + 1
            continue
        after = at + int(np.searchsorted(starts[at:], starts[at] + BLOCK))
        over = np.flatnonzero(lengths[at:after] > BLOCK)
        after = at + int(over[0]) if len(over) else after
        first, last = starts[at], ends[at:after].max()
        out[at:after] = _polynomials(data[first:last], starts[at:after] - first, ends[at:after] - first)
        at = after
    return out


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end); equal bytes have equal hashes wherever they are."""
    return mixed(range_polynomials(data, starts, ends) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


class Places:
    """An open-addressing table from non-zero 64-bit keys to the slots that hold them."""

    def __init__(self, bits: int) -> None:
        self.bits, self.keys, self.size = bits, np.zeros(1 << bits, np.uint64), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not held."""
        last = len(self.keys) - 1
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[slots]
        out = np.where(held == keys, slots, -1)
        rest = np.flatnonzero((held != keys) & (held != 0))
        slots = slots[rest]
        while len(rest):
            slots = (slots + 1) & last
            held = self.keys[slots]
            hit = held == keys[rest]
            out[rest[hit]] = slots[hit]
            on = ~hit & (held != 0)
            rest, slots = rest[on], slots[on]
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """The slots that distinct keys which are not held yet get."""
        last = len(self.keys) - 1
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slots[rest]] == 0]
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]] = keys[placed]
            rest = rest[self.keys[slots[rest]] != keys[rest]]
            slots[rest] = (slots[rest] + 1) & last
        self.size += len(keys)
        return slots
