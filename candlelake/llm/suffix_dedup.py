"""Repeated byte strings by suffix array and common-prefix intervals.

The contexts of a shard (see ``repeats``) get an enhanced suffix array: suffixes in order, with the length of the prefix
that each shares with the one before. A scan with a stack builds the tree of common-prefix intervals; an interval whose
suffixes differ in the byte to their left is a maximal repeat, and all of its suffixes are its occurrences.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import grams, repeats
from .common import texts
from .repeats import Shard, apply_spans

#: Symbols that one sort key holds: a byte more one, nine bits each; zero stands for the end of the context.
PER_KEY = 7


def suffix_array(shard: Shard, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): sorted suffixes, and the length of the prefix that each shares with the one before, no more than
    either has in its context.

    Suffixes whose first ``least`` bytes no other has take part in no repeat of that length and are left out beforehand.
    """
    n = len(shard.values)
    end = shard.first[1:][shard.of]
    own = np.flatnonzero(end - np.arange(n) >= least)
    sums, down = grams.prefix_hash(grams._CODES[shard.values])
    _, which, count = np.unique((sums[own + least] - sums[own]) * down[own], return_inverse=True, return_counts=True)
    own = own[count[which] > 1]
    left = end[own] - own
    keys = np.zeros((-(-int(left.max(initial=0)) // PER_KEY), len(own)), np.int64)
    for j, key in enumerate(keys):
        for s in range(PER_KEY):
            ahead = PER_KEY * j + s
            at = np.minimum(own + ahead, n - 1)
            key <<= 9
            key |= np.where(left > ahead, shard.values[at].astype(np.int64) + 1, 0)
    order = np.lexsort(keys[::-1]) if len(keys) else np.zeros(0, np.int64)
    keys, left, own = keys[:, order], left[order], own[order]
    common = np.zeros(len(own), np.int64)
    if len(own) > 1:
        differ = keys[:, 1:] != keys[:, :-1]
        lead = np.where(differ.any(0), differ.argmax(0), len(keys))
        at = np.minimum(lead, len(keys) - 1)
        rest = keys[at, np.arange(1, len(own))] ^ keys[at, np.arange(len(own) - 1)]
        within = sum(((rest >> (9 * (PER_KEY - 1 - s))) == 0).astype(np.int64) for s in range(PER_KEY))
        common[1:] = np.minimum(PER_KEY * lead + np.where(lead < len(keys), within, 0), np.minimum(left[1:], left[:-1]))
    return own, common


def maximal_intervals(common: np.ndarray, before: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """(first, last, length, smallest doc) of the maximal repeats: common-prefix intervals of at least ``least`` whose
    suffixes are preceded by different bytes (before; -1 for none, which differs from all)."""
    out = []
    stack: list[list[int]] = []  # [length, first, byte before or -1 if they differ, smallest doc]
    inside = np.flatnonzero(common >= least)
    ends = np.concatenate([inside[1:], [-1]]) if len(inside) else inside
    for i, after in zip(inside.tolist(), ends.tolist()):
        length = int(common[i])
        if not stack:
            held = [length, i - 1, int(before[i - 1]), int(doc[i - 1])]
            stack.append(held)
        first, byte, low = i - 1, int(before[i - 1]), int(doc[i - 1])
        while stack and stack[-1][0] > length:
            top = stack.pop()
            if top[2] < 0:
                out.append((top[1], i - 1, top[0], top[3]))
            first, byte, low = top[1], top[2], top[3]
            if stack and stack[-1][0] >= length:
                _join(stack[-1], byte, low)
        if not stack or stack[-1][0] < length:
            stack.append([length, first, byte, low])
        _join(stack[-1], int(before[i]), int(doc[i]))
        if after != i + 1:
            while stack:
                top = stack.pop()
                if top[2] < 0:
                    out.append((top[1], i, top[0], top[3]))
                if stack:
                    _join(stack[-1], top[2], top[3])
    return out


def _join(node: list[int], byte: int, low: int) -> None:
    if node[2] != byte:
        node[2] = -1
    node[3] = min(node[3], low)


def decide(shard: Shard, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the occurrences of maximal repeats that a document with a smaller doc_id has as well."""
    order, common = suffix_array(shard, width)
    context = shard.of[order]
    start = order - shard.first[context]
    before = np.where(start > 0, shard.values[np.maximum(order - 1, 0)].astype(np.int64), -1)
    doc = shard.doc[context]
    best = np.zeros(len(order), np.int64)
    # Longer repeats lie inside shorter ones, at most as deep as a context is long; the longest that counts stays.
    for first, last, length, low in sorted(maximal_intervals(common, before, doc, width), key=lambda x: x[2]):
        part = slice(first, last + 1)
        best[part] = np.where(doc[part] > low, length, best[part])
    hit = best > 0
    return context[hit], start[hit], (start + best)[hit]


def _cut(text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
    kept, at = hashlib.sha256(), 0
    for start, end in spans:
        kept.update(text[at:start])
        at = end
    kept.update(text[at:])
    return len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest()


def repeat_groups(docs: DataFrame, width: int = 50, gram: int = 20) -> DataFrame:
    """Maximal repeat groups of the distinct contexts, with all occurrences: group, length, doc_id, start (of bytes).

    A group is a string of at least ``width`` bytes that occurs more than once and whose occurrences differ in the byte to
    their left and to their right; strings end where their context does. Equal contexts are one here, that of the first
    document; its copies have the same groups at the same places of theirs. Rows without a doc_id have none; the start of
    a row whose doc_id has several texts counts from a place of its own, a multiple of 2 ** 32.
    """
    docs = texts(docs)
    placed = docs.withColumn("place", repeats._place(docs)).where("doc_id IS NOT NULL")

    def run(shard: Shard) -> Iterator[pd.DataFrame]:
        order, common = suffix_array(shard, width)
        context = shard.of[order]
        start = order - shard.first[context]
        before = np.where(start > 0, shard.values[np.maximum(order - 1, 0)].astype(np.int64), -1)
        for first, last, length, _ in maximal_intervals(common, before, shard.doc[context], width):
            own = slice(first, last + 1)
            text = shard.values[order[first] : order[first] + length].tobytes()
            name = hashlib.blake2b(text, digest_size=16).hexdigest()
            yield pd.DataFrame({"group": name, "length": length, "doc_id": shard.doc[context[own]], "start": shard.start[context[own]] + start[own]})

    out = None
    for fetched in repeats.open_contexts(placed, repeats.Bytes, gram, width)[1]:
        found = repeats.in_shards(fetched, run, np.uint8, "group string, length long, doc_id long, start long")
        out = found if out is None else out.unionByName(found)
    # A string may be in contexts of several shards.
    return out.distinct()


def suffix_dedup(docs: DataFrame, width: int = 50, gram: int = 20) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    A byte is removed when a string of ``width`` bytes that covers it also starts in a document with a smaller doc_id.
    Null counts as empty; shorter texts keep all, and so do rows without a doc_id, which no other row repeats. Rows that
    repeat a doc_id are parts of one document and don't repeat each other; each is judged by its own text, however long.
    Extra columns are ignored, whatever their names; an empty table gives an empty result.
    """
    return apply_spans(docs, repeats.Bytes, decide, gram, width, _cut, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


#: DuckDB SQL of the query's result; bytes are pairs of hexadecimal digits.
ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     w AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS INT), 100) AS k FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
     f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
     g AS (SELECT w.doc_id, i, i > lag(i, 1, -100) OVER (PARTITION BY w.doc_id ORDER BY i) + 50 AS new FROM w JOIN f USING (k) WHERE w.doc_id > f.m),
     r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
     e AS (SELECT doc_id, a, b FROM r UNION ALL SELECT doc_id, len(h) // 2, NULL FROM d),
     p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS c FROM e)
SELECT d.doc_id, len(any_value(h)) // 2 AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(b) AS n_spans,
       sha256(unhex(string_agg(substr(h, CAST(2 * c + 1 AS INT), CAST(2 * (a - c) AS INT)), '' ORDER BY a, b))) AS kept_sha256
FROM d JOIN p USING (doc_id) GROUP BY d.doc_id
"""
