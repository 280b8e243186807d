"""Words, shingles and their hashes for a batch of texts, as whole-array numpy operations inside a task.

Texts are UTF-8 bytes. A batch is one buffer in which a separator follows each text; words are runs of other bytes. A
word's hash is a polynomial over random 64-bit codes of its bytes, taken from prefix sums, then mixed. Polynomials modulo
a power of two collide on long strings of a certain structure, so that longer words are hashed one by one, and longer
sequences by polynomials modulo two primes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from .common import SEPARATORS

_RANDOM = np.random.default_rng(20240229)
_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SHINGLE = np.uint64(0xD6E8FEB86659FD93 | 1)

#: Words of more bytes are hashed one by one.
LONG_WORD = 32
#: Primes and a base for each; codes of bytes modulo them.
_PRIMES = ((np.uint64(2**31 - 1), 1_103_515_245), (np.uint64(2**31 - 19), 1_664_525_013))
_powers: dict[tuple[int, int], np.ndarray] = {}

IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True
#: Tables for bytes.translate: A-Z to a-z; the same with ASCII punctuation as separators.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOWER_WORDS = bytes(32 if b < 128 and not chr(b).isalnum() else LOWER[b] for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(items: list[bytes], most: int = 500_000) -> Iterator[slice]:
    """Slices of a list of texts with about that many bytes at most; a longer text is one slice."""
    start, size = 0, 0
    for i, x in enumerate(items):
        if size and size + len(x) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(x) + 1
    if start < len(items):
        yield slice(start, len(items))


def prefix_hash(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, down): mix((sums[b] - sums[a]) * down[a]) is the hash of the values from a to b."""
    n = len(values)
    up = np.full(n + 1, _BASE, np.uint64)
    up[0] = 1
    np.cumprod(up, out=up)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    down = np.full(n + 1, _INVERSE, np.uint64)
    down[0] = 1
    np.cumprod(down, out=down)
    return sums, down


def _power(base: int, prime: np.uint64, n: int) -> np.ndarray:
    """The powers 0 to n of a base modulo a prime, or more of them; known ones are kept."""
    own = _powers.get((base, int(prime)), np.ones(1, np.uint64))
    while len(own) <= n:
        own = np.concatenate([own, own * np.uint64(int(own[-1]) * base % int(prime)) % prime])
    _powers[base, int(prime)] = own
    return own


def residues(values: np.ndarray) -> list[np.ndarray]:
    """Bytes or 64-bit hashes modulo either prime, by different bits of them."""
    if values.dtype == np.uint8:
        return [table[values] for table in residues(_CODES)]
    return [(values >> np.uint64(32 * k)) % prime for k, (prime, _) in enumerate(_PRIMES)]


def span_hash(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The hash of the values from low to high of each span: 62 bits of two polynomials modulo primes, and the length."""
    out = mix((high - low).astype(np.uint64))
    for k, (own, (prime, base)) in enumerate(zip(residues(values), _PRIMES)):
        own *= _power(base, prime, len(values))[: len(values)]
        own %= prime
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(own, out=sums[1:])
        down = _power(pow(base, -1, int(prime)), prime, len(values))
        out = mix(out ^ ((sums[high] - sums[low]) % prime * down[low] % prime) << np.uint64(k))
    return out


class Words:
    """The words of some texts: doc (which text), start and end (in buffer), hash, first (of each text its first word)."""

    def __init__(self, items: list[bytes], table: bytes | None = None):
        joined = b" ".join([*items, b""])
        if table:
            joined = joined.translate(table)
        self.buffer = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter((len(x) + 1 for x in items), np.int64, len(items))
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        inside = ~IS_SEPARATOR[self.buffer]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edge[::2], edge[1::2]
        self.doc = np.searchsorted(self.offset, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(items) + 1))
        sums, down = prefix_hash(_CODES[self.buffer])
        self.hash = mix(((sums[self.end] - sums[self.start]) * down[self.start]) ^ (self.end - self.start).astype(np.uint64))
        for i in np.flatnonzero(self.end - self.start > LONG_WORD):
            self.hash[i] = xxhash.xxh3_64_intdigest(joined[self.start[i] : self.end[i]], 20240229)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of every k words in a row of one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * _SHINGLE + self.hash[j : n - k + 1 + j]
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        return at, mix(out[at])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the k-word shingles; a text of one to k - 1 words has its whole sequence as one."""
        at, found = self.grams(k)
        doc, counts = self.doc[at], self.counts()
        for short in range(1, k):
            if (own := np.flatnonzero(counts == short)).size:
                h = np.zeros(len(own), np.uint64)
                for j in range(short):
                    h = h * _SHINGLE + self.hash[self.first[own] + j]
                doc, found = np.concatenate([doc, own]), np.concatenate([found, mix(h ^ np.uint64(short))])
        return doc, found


def sets(items: list[bytes], k: int, table: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the distinct shingles of text i, in ascending order, are hashes[bounds[i]:bounds[i + 1]]."""
    doc, found = Words(items, table).shingles(k)
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    if len(doc):
        new = np.concatenate([[True], (np.diff(doc) != 0) | (found[1:] != found[:-1])])
        doc, found = doc[new], found[new]
    return np.searchsorted(doc, np.arange(len(items) + 1)), found


def exact_sets(items: list[bytes], k: int, table: bytes | None = None) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending numbers that are equal only where the words are: no hashes."""
    places: dict[bytes, int] = {}
    parts = [(x.translate(table) if table else x).split() for x in items]
    rows = [np.array([places.setdefault(w, len(places) + 1) for w in p], np.int64) for p in parts]
    size = np.array([max(0, len(r) - k + 1) or min(1, len(r)) for r in rows])
    # One row of words for each shingle; those of texts with fewer than k words are filled up by 0, which is no word.
    out = np.zeros((int(size.sum()), k), np.int64)
    for at, r in zip(np.cumsum(size) - size, rows):
        if len(r) >= k:
            out[at : at + len(r) - k + 1] = np.lib.stride_tricks.sliding_window_view(r, k)
        elif len(r):
            out[at, : len(r)] = r
    code, most, count = out[:, 0] if k else np.zeros(0, np.int64), len(places) + 1, len(places) + 1
    for j in range(1, k):
        if count > 2**62 // most:
            code = np.unique(code, return_inverse=True)[1].ravel()
            count = len(code) + 1
        code, count = code * most + out[:, j], count * most
    return [np.unique(code[a - n : a]) for a, n in zip(np.cumsum(size), size)]


def encoded(texts) -> list[bytes]:
    return [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in texts]
