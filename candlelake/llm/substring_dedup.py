"""Repeated word windows by a compressed full-text index.

The contexts of a shard (see ``repeats``) are indexed by an FM-index: the Burrows-Wheeler transform of their words in a
wavelet matrix of packed bits. Contexts are streamed against it: backward search from each of their words narrows the
interval of suffixes that start with what has been read, as long as it is more than the word itself. That gives the
matching statistics: how far back from each word its context occurs elsewhere. Where they reach the threshold, the interval
has all occurrences of the window, and the smallest document among them decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from . import repeats
from .repeats import Shard, apply_spans


#: Of each place in a pack, the bits below it.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class BitVector:
    """Bits packed by 64, with the count of ones before each pack."""

    def __init__(self, bits: np.ndarray):
        self.words = np.packbits(np.concatenate([bits, np.zeros(64 - len(bits) % 64, bits.dtype)]), bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        pack = at >> 6
        return self.before[pack] + np.bitwise_count(self.words[pack] & _BELOW[at & 63])


class WaveletMatrix:
    """A sequence of small integers, bit plane by bit plane, that counts a symbol before a place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.planes = []
        for level in reversed(range(self.bits)):
            bit = (values >> level) & 1
            self.planes.append((BitVector(bit.astype(np.uint8)), int((bit == 0).sum())))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        # Where each symbol's places begin below the last plane; the same for every query of it.
        self.base, symbols = np.zeros(1 << self.bits, np.int64), np.arange(1 << self.bits)
        for k, (ones, zeros) in enumerate(self.planes):
            b = ones.rank(self.base)
            self.base = np.where((symbols >> (self.bits - 1 - k)) & 1, zeros + b, self.base - b)

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each symbol: its count before low and before high (of the same query)."""
        base = self.base[symbol]
        for k, (ones, zeros) in enumerate(self.planes):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            lo, hi = ones.rank(low), ones.rank(high)
            low = np.where(bit, zeros + lo, low - lo)
            high = np.where(bit, zeros + hi, high - hi)
        return low - base, high - base, base


class FMIndex:
    """Backward search over sequences that are set apart by ends, which match nothing."""

    def __init__(self, shard: Shard):
        code, m = shard.values, len(shard.size)  # words are numbered from 0
        # The end of the k-th sequence is the symbol k: ends are distinct, smaller than any word, and never searched for.
        text = np.zeros(len(code) + m, np.int64)
        place = np.arange(len(code)) + shard.of
        text[place] = code + m
        text[np.cumsum(shard.size + 1) - 1] = np.arange(m)
        self.code, self.place = code + m, place
        self.suffixes = _sorted_suffixes(text, int(shard.size.max(initial=0)) + 1)
        self.last = text[self.suffixes - 1]
        counts = np.bincount(text, minlength=m + int(code.max(initial=-1)) + 2)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.matrix = WaveletMatrix(np.where(self.last < m, 0, self.last - m + 1))
        self.ends = m
        owner = np.repeat(np.arange(m), shard.size + 1)
        self.owner = owner[self.suffixes]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of a symbol before what the interval low to high starts with."""
        a, b, _ = self.matrix.rank(symbol - self.ends + 1, low, high)
        return self.before[symbol] + a, self.before[symbol] + b


def _sorted_suffixes(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffix array by doubling; ends are distinct, so ``longest`` symbols tell all suffixes apart."""
    n, width = len(text), 1
    rank = text.copy()
    while width < longest:
        shifted = np.zeros(n, np.int64)
        shifted[: n - width] = rank[width:] + 1
        rank = np.unique(rank * (n + int(text.max(initial=0)) + 2) + shifted, return_inverse=True)[1]
        width *= 2
    return np.argsort(rank, kind="stable")


def matching_statistics(index: FMIndex, shard: Shard, most: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, low, high) for each word of the shard: how many words up to and with it, ``most`` at most, occur elsewhere
    in it as well, and the interval of suffixes that start with them. Words that fewer than ``least - 1`` of their context
    come before can't reach that length; they aren't searched for and have zeros."""
    within = np.arange(len(shard.values)) - shard.first[shard.of]
    length, low, high = (np.zeros(len(within), np.int64) for _ in range(3))
    last = np.flatnonzero(within >= least - 1)
    lo, hi = index.before[index.code[last]], index.before[index.code[last] + 1]
    for step in range(1, most + 1):
        alive = hi - lo > 1  # one suffix is the word's own
        last, lo, hi = last[alive], lo[alive], hi[alive]
        if not len(last):
            break
        length[last], low[last], high[last] = step, lo, hi
        more = within[last] >= step
        last, lo, hi = last[more], lo[more], hi[more]
        if step < most and len(last):
            lo, hi = index.extend(index.code[last - step], lo, hi)
    return length, low, high


def decide(shard: Shard, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the windows that a document with a smaller doc_id has as well."""
    index = FMIndex(shard)
    doc = shard.doc[index.owner]
    length, low, high = matching_statistics(index, shard, width, width)
    last = np.flatnonzero(length >= width)
    if len(last):
        # Smallest document of each interval; equal windows have one interval.
        pairs, which = np.unique(np.stack([low[last], high[last]], 1), axis=0, return_inverse=True)
        smallest = np.minimum.reduceat(np.append(doc, np.iinfo(np.int64).max), pairs.ravel())[::2]
        last = last[shard.doc[shard.of[last]] > smallest[which.ravel()]]
    context = shard.of[last]
    start = last - shard.first[context] - (width - 1)
    return context, start, start + width


def _cut(text: bytes, spans: np.ndarray) -> tuple[int, int, str]:
    words = text.split()  # bytes split at SEPARATORS and nothing else
    kept, at = [], 0
    for start, end in spans.tolist():  # in order and apart
        kept += words[at:start]
        at = end
    kept += words[at:]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def substring_dedup(docs: DataFrame, width: int = 50, gram: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space).

    Words are runs of characters outside ``[\\x20\\x09-\\x0D]``, as they are. A word is removed when a window of ``width``
    words that covers it also starts in a document with a smaller doc_id. Null counts as empty; texts with fewer words keep
    all, and so do rows without a doc_id, which no other row repeats. Rows that repeat a doc_id are parts of one document
    and don't repeat each other; each is judged by its own text, however long. Extra columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    return apply_spans(docs, repeats.Words, decide, gram, width, _cut, "n_words long, n_removed long, kept_sha256 string")


#: DuckDB SQL of the query's result.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM d),
     v AS (SELECT doc_id, i, n, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS k FROM p),
     f AS (SELECT k, min(doc_id) AS m FROM v WHERE i <= n - 49 GROUP BY k),
     g AS (SELECT DISTINCT v.doc_id, unnest(range(v.i, v.i + 50)) AS i FROM v JOIN f USING (k) WHERE v.i <= v.n - 49 AND v.doc_id > f.m)
SELECT d.doc_id, len(d.w) AS n_words, count(g.i) AS n_removed, sha256(coalesce(string_agg(p.x, ' ' ORDER BY p.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY d.doc_id, d.w
"""
