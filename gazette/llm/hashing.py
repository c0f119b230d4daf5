"""Vectorised words and polynomial hashes over the bytes of many texts.

Words are told apart by polynomials modulo a prime: modulo a power of two, long
words of two letters can be made that collide whatever the base.

A text block is one byte array with the texts end to end and the offsets of
their borders. Polynomial hashes are taken modulo 2^64 from prefix sums, so the
hash of any range costs one subtraction and one product; a finaliser spreads
them over all bits.
"""

from __future__ import annotations

import hashlib

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
BLOCK_BYTES = 1 << 20

#: Modulus of the words' hashes, and two bases for independent ones.
PRIME = (1 << 61) - 1
WORD_BASE, SECOND_BASE = 0x1A2B3C4D5E6F7A8B % PRIME, 0x0F1E2D3C4B5A6978 % PRIME
#: Words up to this length are hashed by tables of products.
SHORT_WORD = 32
#: Longer words are hashed one by one.
LONG_WORD = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NOT_ALPHANUMERIC = np.ones(128, bool)
_NOT_ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_NOT_ALPHANUMERIC = np.concatenate([_NOT_ALPHANUMERIC, np.zeros(128, bool)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i up to n."""
    known = _powers.get(base)
    if known is None or len(known[0]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        known = _powers[base] = (both[0], both[1])
    return known


def _times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo PRIME, for values below it."""
    low = (1 << 31) - 1
    a1, a0 = a >> np.uint64(31), a & np.uint64(low)
    b1, b0 = np.uint64(b >> 31), np.uint64(b & low)
    middle = a1 * b0 + a0 * b1
    total = np.uint64(2) * (a1 * b1) + (middle >> np.uint64(30)) + a0 * b0
    total += (middle & np.uint64((1 << 30) - 1)) << np.uint64(31)
    return _reduced(total)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


_word_powers: dict[int, np.ndarray] = {}


def prime_powers(n: int, base: int) -> np.ndarray:
    """base^i modulo PRIME for i below n, at least."""
    known = _word_powers.get(base, np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, _times(known, pow(base, len(known), PRIME))])
    _word_powers[base] = known
    return known


_products: dict[int, list[np.ndarray]] = {}


def products(base: int) -> list[np.ndarray]:
    """For each place of a short word, what each byte adds to its polynomial."""
    if base not in _products:
        symbols = np.arange(1, 257, dtype=np.uint64)
        places = prime_powers(SHORT_WORD, base)[:SHORT_WORD].tolist()
        _products[base] = [_times(symbols, power) for power in places]
    return _products[base]


def _short_hashes(
    body: np.ndarray, starts: np.ndarray, sizes: np.ndarray, base: int
) -> np.ndarray:
    """Polynomials of short words: a byte of all words that are long enough at a time."""
    order = np.argsort(sizes.astype(np.uint8), kind="stable")[::-1]
    longer = len(sizes) - np.cumsum(np.bincount(sizes, minlength=SHORT_WORD))
    at, total = starts[order], np.zeros(len(sizes), np.uint64)
    for place, (added, n) in enumerate(zip(products(base), longer.tolist(), strict=False)):
        if n == 0:
            break
        total[:n] += added[body[at[:n] + place]]
        if place % 7 == 6:  # eight values below PRIME stay below 2^64
            total[:n] = _reduced(total[:n])
    out = np.empty_like(total)
    out[order] = _reduced(total)
    return out


def word_hashes(
    body: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = WORD_BASE
) -> np.ndarray:
    """Hashes of words (none empty), given by their borders in body."""
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    short = np.flatnonzero(sizes <= SHORT_WORD)
    if len(short):
        out[short] = _short_hashes(body, starts[short], sizes[short], base)
    usual = np.flatnonzero((sizes > SHORT_WORD) & (sizes <= LONG_WORD))
    if len(usual):
        own = sizes[usual]
        first = np.cumsum(own) - own
        place = np.arange(int(own.sum())) - np.repeat(first, own)
        symbols = body[place + np.repeat(starts[usual], own)].astype(np.uint64) + np.uint64(1)
        power = prime_powers(int(own.max()), base)[place]
        # sums of the powers' halves stay below 2^64, as do those of their products
        low = np.add.reduceat(symbols * (power & np.uint64(0xFFFFFFFF)), first)
        high = _reduced(np.add.reduceat(symbols * (power >> np.uint64(32)), first))
        turned = ((high & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (high >> np.uint64(29))
        out[usual] = _reduced(_reduced(low) + turned)
    for i in np.flatnonzero(sizes > LONG_WORD):
        word = hashlib.blake2b(body[starts[i] : ends[i]].tobytes(), digest_size=8, salt=b"%d" % (base % 997))
        out[i] = int.from_bytes(word.digest(), "little")
    return mix(out)


class PrefixHash:
    """Hashes of ranges of one array of symbols."""

    def __init__(self, symbols: np.ndarray, base: int = BASE):
        self.base = base
        up, _ = powers(len(symbols), base)
        terms = symbols.astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[: len(symbols)]
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Not finalised: equal ranges have equal values, whatever their place."""
        _, down = powers(len(self.sums), self.base)
        return (self.sums[ends] - self.sums[starts]) * down[starts]

    def windows(self, width: int) -> np.ndarray:
        """The finalised hash of each range of the given width, by its start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        _, down = powers(len(self.sums), self.base)
        return mix((self.sums[width:] - self.sums[:n]) * down[:n])


def distinct(values: np.ndarray) -> np.ndarray:
    """The values once each, sorted; np.unique alone puts them into a hash table first."""
    ranked = np.sort(values)
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return ranked[new]


def among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the finalised hashes are among sorted ones.

    Most of the others have high bits that no key has; the rest are looked up in order.
    """
    out = np.zeros(len(values), bool)
    if not len(keys):
        return out
    rest = np.uint64(64 - min(22, (16 * len(keys)).bit_length()))
    seen = np.zeros(1 << int(64 - rest), bool)
    seen[keys >> rest] = True
    place = np.flatnonzero(seen[values >> rest])
    place = place[np.argsort(values[place])]
    found = np.searchsorted(keys, values[place])
    out[place] = keys[np.minimum(found, len(keys) - 1)] == values[place]
    return out


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES):
    """Runs (first, last) of texts of about `size` bytes together; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


class Words:
    """The words of a block: runs of bytes that are not ASCII white space.

    With `plain`, runs of ASCII letters, digits and any other characters than ASCII.
    """

    def __init__(
        self, body: np.ndarray, offsets: np.ndarray, lower: bool = False, plain: bool = False
    ):
        begin = int(offsets[0])
        self.body = body[begin : int(offsets[-1])]
        if lower:
            self.body = _LOWER[self.body]
        borders = offsets - begin
        space = (_NOT_ALPHANUMERIC if plain else _SPACE)[self.body]
        before, after = np.ones(len(space), bool), np.ones(len(space), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        full = borders[1:] > borders[:-1]
        before[borders[:-1][full]] = True
        after[borders[1:][full] - 1] = True
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        #: borders of the texts in the list of words
        self.borders = np.searchsorted(self.starts, borders)

    def hashes(self, base: int = WORD_BASE) -> np.ndarray:
        return word_hashes(self.body, self.starts, self.ends, base)


def inside(borders: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n - width + 1 windows lie within one text."""
    if n < width:
        return np.zeros(0, bool)
    counts = np.diff(borders)
    ends = np.repeat(borders[1:], counts)
    return np.arange(n - width + 1) + width <= ends[: n - width + 1]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n symbols lie in a window that begins at one of the starts."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]
