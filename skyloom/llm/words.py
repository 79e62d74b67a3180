"""Words of many texts at once, and 64-bit codes of words, prefixes, shingles and windows, without a Python loop over them.

A word is a longest run of bytes other than \\x20 and \\x09-\\x0D. The code of a byte run is a polynomial in a fixed
random base modulo the prime 2^61 - 1, taken from prefix sums, so that each run costs O(1); two runs of n bytes have
the same code with a chance of n / 2^61, whatever their pattern. Codes of all windows of one width come from doubling.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

PRIME = 2**61 - 1
#: Powers that are kept for the next call: a chunk of texts has not many more bytes.
KEPT = 1 << 20
#: Numbers of 64 bits that a pass works on at a time.
NEAR = 1 << 15
#: Bytes of a run whose prefix sums can't overflow; longer ones are coded in parts of this size.
LONGEST = 1 << 24
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64(2**31 - 1), np.uint64(2**30 - 1)
_61, _31, _30 = np.uint64(61), np.uint64(31), np.uint64(30)
_rng = np.random.default_rng(20240229)
_BASE = int(_rng.integers(2**59, 2**60)) * 2 + 1
_BASE_INVERSE = pow(_BASE, -1, PRIME)
_VALUE = np.arange(1, 257, dtype=np.uint16)
_VALUE_LOWER = _VALUE[LOWER]
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x * y modulo the prime, for numbers up to 2^61 + 2^32; the result is below the prime."""
    x1, x0, y1, y0 = x >> _31, x & _LOW31, y >> _31, y & _LOW31
    middle = x1 * y0
    middle += x0 * y1
    out = x1 * y1
    out += out
    out += middle >> _30
    out += (middle & _LOW30) << _31
    out += x0 * y0
    out = (out & _P) + (out >> _61)
    return np.where(out >= _P, out - _P, out)


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo the prime, by doubling; kept for the next call."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, _times(known, np.uint64(pow(base, len(known), PRIME)))])
    _powers[base] = known if len(known) <= 2 * KEPT else known[:KEPT].copy()
    return known[:n]


@lru_cache(1)
def _kept_halves() -> tuple[np.ndarray, np.ndarray]:
    power = _power(_BASE, KEPT)
    return (power >> _31).astype(np.uint32), (power & _LOW31).astype(np.uint32)


def _halves(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, cut in 30 and 31 bits."""
    if n <= KEPT:
        return tuple(x[:n] for x in _kept_halves())
    power = _power(_BASE, n)
    return (power >> _31).astype(np.uint32), (power & _LOW31).astype(np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Coder:
    """Codes byte runs of one array of bytes."""

    def __init__(self, data: np.ndarray, lower: bool = True):
        n = len(data)
        value, (high, low) = (_VALUE_LOWER if lower else _VALUE)[data], _halves(n)
        self.high, self.low = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        for part, sums in ((high, self.high[1:]), (low, self.low[1:])):
            np.multiply(part, value, out=sums, dtype=np.uint64)
            np.cumsum(sums, out=sums)
        self.back = _power(_BASE_INVERSE, n + 1)

    def code(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        high, low = self.high[ends] - self.high[starts], self.low[ends] - self.low[starts]
        high, low = (high & _P) + (high >> _61), (low & _P) + (low >> _61)
        both = ((high & _LOW30) << _31) + (high >> _30) + low
        out = mix(_times((both & _P) + (both >> _61), self.back[starts]))
        for i in np.flatnonzero(np.asarray(ends) - np.asarray(starts) > LONGEST):
            cuts = np.append(np.arange(starts[i], ends[i], LONGEST), ends[i])
            total = np.zeros(1, np.uint64)
            for part in self.code(cuts[:-1], cuts[1:]):
                total = mix(total * np.uint64(3) + part)
            out[i] = total[0]
        return out


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The code of two neighbouring (or overlapping) windows from theirs."""
    out = left * np.uint64(0x9E3779B97F4A7C15)
    out += right * np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def window_codes(data: np.ndarray, width: int) -> np.ndarray:
    """Codes of every `width` bytes in a row, of another form than Coder's: two independent codes tell windows apart by 128 bits."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if n > NEAR:  # part by part, so that numpy's passes stay in the processor's cache
        out = np.empty(n, np.uint64)
        for at in range(0, n, NEAR):
            out[at : at + NEAR] = window_codes(data[at : min(at + NEAR, n) + width - 1], width)
        return out
    if width >= 8:
        code, reach = loads(data)[: len(data) - 7], 8
        code ^= code >> np.uint64(32)
        code *= np.uint64(0xD6E8FEB86659FD93)
        code ^= code >> np.uint64(29)
    else:
        code, reach = _BYTE[data], 1
    while reach * 2 <= width:
        code = _joined(code[:-reach], code[reach:])
        reach *= 2
    return _joined(code[:n], code[width - reach : width - reach + n]) if width > reach else code


def codes_at(whole: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Codes of `width` bytes (8 or more) at some places, of the form of window_codes but not equal to them; whole: loads() of the bytes."""
    out = np.zeros(len(at), np.uint64)
    for i in [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]:
        out = _joined(out, whole[at + i])
    return out


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and the n + 1 offsets of each text's words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    stops[:-1] &= ~solid[1:] | edge[1:-1]
    begins, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return begins, stops, np.searchsorted(begins, ends)


def loads(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on, as one number; zeros follow the data."""
    wide = -(-len(data) // 8)
    padded = np.zeros(wide * 8 + 8, np.uint8)
    padded[: len(data)] = data
    out = np.empty(wide * 8, "<u8")
    for i in range(8):
        out[i::8] = np.frombuffer(padded, "<u8", wide, i)
    return out[: len(data)]


_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def same_bytes(left: np.ndarray, starts: np.ndarray, right: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether runs of `sizes` bytes hold the same bytes; left and right are loads() of their arrays. Eight bytes at a time."""
    out, some, at = np.ones(len(sizes), bool), np.flatnonzero(sizes > 0), 0
    while len(some):
        differ = (left[starts[some] + at] ^ right[places[some] + at]) & _KEEP[np.minimum(sizes[some] - at, 8)]
        out[some[differ != 0]] = False
        at += 8
        some = some[(differ == 0) & (sizes[some] > at)]
    return out


def alike(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first, which): different runs, the first place of each and which one every run is. Equal codes are confirmed byte by byte."""
    codes, first, which = np.unique(Coder(data, lower=False).code(starts, ends), return_index=True, return_inverse=True)
    size, head = ends - starts, first[which]
    good = size == size[head]
    some = np.flatnonzero(good & (head != np.arange(len(head))))
    whole = loads(data)
    good[some] = same_bytes(whole, starts[some], whole, starts[head[some]], size[some])
    odd: dict[bytes, int] = {}
    for i in np.flatnonzero(~good):  # other bytes than those whose code they have: on their own, under codes that nothing else has
        word = data[starts[i] : ends[i]].tobytes()
        if word not in odd:
            odd[word] = len(codes)
            codes, first = np.append(codes, np.uint64(0)), np.append(first, i)
        which[i] = odd[word]
    return codes, first, which


def shingles(codes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of k words in a row, and the n + 1 offsets of each text's; a text of fewer words has one for them all."""
    counts = np.diff(bounds)
    full = np.maximum(counts - k + 1, 0)
    n = len(codes)
    rolled = np.zeros(n, np.uint64)
    for i in range(min(k, n)):
        part = codes[i:] * np.uint64((2 * i + 3) * 0x9E3779B97F4A7C15 & (2**64 - 1) | 1)
        rolled[: n - i] += mix(part)
    short = (counts > 0) & (full == 0)
    out_counts = full + short
    out_bounds = np.concatenate([[0], np.cumsum(out_counts)])
    first = np.repeat(bounds[:-1], out_counts) + (np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], out_counts))
    out = mix(rolled[first]) if len(first) else np.zeros(0, np.uint64)
    few, at = np.flatnonzero(short), out_bounds[:-1][short]
    total = counts[few].astype(np.uint64)
    for i in range(k - 1):
        more = counts[few] > i
        total[more] = mix(total[more] + codes[bounds[few[more]] + i] * np.uint64(2 * i + 3))
    out[at] = total
    return out, out_bounds
