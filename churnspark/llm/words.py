"""Words, their hashes and the hashes of word windows, computed for many texts at once with numpy.

The hash of a window of words is a polynomial of word hashes modulo 2^64, a difference of two running sums. Sums
for stretches of any length are taken in the field of 2^61 - 1 elements, where long patterns do not cancel out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Two independent families: (seed of the bytes, base over words). Bases are odd and so can be inverted.
FAMILIES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
MODULUS = (1 << 61) - 1

SPACED = np.ones(256, bool)  # bytes of words between ASCII white space
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    data: np.ndarray  # the texts, one after the other
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # the byte after it
    first: np.ndarray  # index of the first word of each text, and the number of words at the end

    @property
    def text_of(self) -> np.ndarray:
        """For each word, the text it belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(texts: list[bytes | None], inside: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Find the words (runs of bytes that ``inside`` marks) of all texts; a missing text has none."""
    joined = b"\n".join(t or b"" for t in texts)
    data = np.frombuffer(joined, np.uint8)
    if lower:
        data = LOWER[data]
    mask = np.zeros(len(data) + 2, np.int8)
    mask[1:-1] = inside[data]
    step = np.diff(mask)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    at = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    return Words(data, starts, ends, np.searchsorted(starts, at))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the whole result (a bijection of 64-bit values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: Words, family: int = 0) -> np.ndarray:
    """64 bits of every word: the sum of its pieces of eight bytes, each mixed with its place, mixed with its length.

    Words of up to eight bytes have different sums; longer ones meet only as random numbers do.
    """
    size = words.ends - words.starts
    pieces = np.maximum(-(-size // 8), 1)
    first = np.cumsum(pieces) - pieces
    place = np.arange(int(pieces.sum())) - np.repeat(first, pieces)  # of a piece within its word
    at = np.repeat(words.starts, pieces) + 8 * place
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    held = np.minimum(np.repeat(words.ends, pieces) - at, 8).astype(np.uint64)
    value = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * held))
    seed = np.uint64(FAMILIES[family][0])
    value = mixed(value ^ mixed(seed * (place.astype(np.uint64) + np.uint64(1))))
    total = np.add.reduceat(value, first) if len(first) else value
    return mixed(total + size.astype(np.uint64))


def window_hashes(hashes: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """Hash of every window of ``width`` neighbouring words; windows that reach into the next text are included."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    base = FAMILIES[family][1]
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(base, n), out=run[1:])
    down = _powers(pow(base, -1, 1 << 64), n - width + 1)
    return mixed((run[width:] - run[:-width]) * down + np.uint64(width))


def whole_windows(words: Words, width: int) -> np.ndarray:
    """Starts (word indexes) of the windows that lie within one text."""
    first, last = words.first[:-1], words.first[1:]
    n = np.maximum(last - first - width + 1, 0)
    skipped = np.repeat(first - np.cumsum(n) + n, n)
    return np.arange(n.sum()) + skipped


def reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2^64 modulo 2^61 - 1."""
    x = (x >> np.uint64(61)) + (x & np.uint64(MODULUS))
    return np.where(x >= np.uint64(MODULUS), x - np.uint64(MODULUS), x)


def prime_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of values below it, from products of their halves."""
    low, shift = np.uint64((1 << 31) - 1), np.uint64(31)
    a1, a0, b1, b0 = a >> shift, a & low, b >> shift, b & low
    cross = a0 * b1 + a1 * b0
    ends = (a1 * b1 << np.uint64(1)) + (cross >> np.uint64(30)) + ((cross & np.uint64((1 << 30) - 1)) << shift)
    return reduced(ends + a0 * b0)


def prime_powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to ``n`` of ``base`` modulo 2^61 - 1."""
    out = np.ones(1, np.uint64)
    while len(out) <= n:
        out = np.concatenate([out, prime_product(out, np.uint64(pow(base, len(out), MODULUS)))])
    return out[: n + 1]


def prime_sums(values: np.ndarray) -> np.ndarray:
    """Running sums modulo 2^61 - 1 of values below it, with 0 before the first."""
    half = np.uint64(32)
    out = np.zeros(len(values) + 1, np.uint64)
    high = np.cumsum(values >> half, dtype=np.uint64)
    low = np.cumsum(values & np.uint64(0xFFFFFFFF), dtype=np.uint64)
    out[1:] = reduced(prime_product(reduced(high), np.uint64(1 << 32)) + reduced(low))
    return out
