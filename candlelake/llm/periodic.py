"""Runs of periodic words in documents: scale-tiled distribution.

A run of period q is a stretch of words that equal those q words further on, at as many places as it takes. Documents are
exploded into overlapping tiles per octave of periods (P to 2P - 1), so long that neighbouring tiles see 2P common places;
a tile is solved on its own, and what it finds at its ends is stitched afterwards, by document and period.

Within a tile, boundaries lie so close that every run spans one together with GRAM equal words after it. From a boundary,
the periods at which its gram comes again are followed in both directions as far as the words are equal; pieces of
neighbouring boundaries overlap. Where that holds for many periods of the octave, two Z-functions, of the words after the
boundary and of the reversed words before it, tell for all of them at once, so that no text takes longer than its octaves
times its words. A boundary can only matter if its gram comes again within 2P - 1 words, which a sort of the tile's grams
shows; no run is missed by that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import grams
from .common import materialise, partitions

WORD = r"[^\x20\x09-\x0D]+"
#: A run has so many words, and two periods, at least; it then has six equal places in a row at least.
SHORTEST = 12
GRAM = SHORTEST // 2
#: Periods below it are compared place by place.
SMALL = 8
#: A boundary with more periods gets Z-functions.
DENSE = 32
#: Words that are compared at once.
BLOCK = 1 << 20
#: Most fragments in a batch, about.
FRAGMENTS = 200_000
#: Words of a tile of the lowest octaves, which share their tiles.
TILE = 16_384
FRAGMENT = "row long, period long, low long, high long"


def least_equal(period):
    """Equal places in a row that a run of the period has at least."""
    return np.maximum(SHORTEST - period, period)


def gram_hashes(values: np.ndarray) -> np.ndarray:
    """64-bit hashes of every GRAM values in a row."""
    n, values = max(0, len(values) - GRAM + 1), values.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(GRAM):
        h ^= values[k : k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def next_same(h: np.ndarray, doc: np.ndarray | None = None) -> np.ndarray:
    """For each gram, how far on it comes next (by its hash; a chance hit only costs time). With the documents of several
    documents' words, one after the other, only grams within the same one count."""
    out = np.full(len(h), np.iinfo(np.int64).max)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if doc is not None:
        same &= doc[order[1:] + GRAM - 1] == doc[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def z_function(s: list) -> list[int]:
    """For each place, how many items from there equal the items from the start."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _joined(period: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of one period that touch or overlap, as one."""
    order = np.lexsort((low, period))
    period, low, high = period[order], low[order], high[order]
    base = period * (high.max() + 1)  # sets the places of a period above those of all smaller ones
    at = np.flatnonzero(np.concatenate([[True], (low + base)[1:] > np.maximum.accumulate(high + base)[:-1]]))
    return period[at], low[at], np.maximum.reduceat(high, at)


def _reach(padded: np.ndarray, margin: int, a: np.ndarray, q: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """How many places from a on, and how many before a, equal those q further on: ``most`` at most. The words have a margin
    of places on either side that equal none of them."""
    spans, forward, back = np.lib.stride_tricks.sliding_window_view(padded, 2 * most), [], []
    for block in range(0, len(a), size := max(1, BLOCK // most)):
        at = a[block : block + size] + margin - most
        differ = spans[at] != spans[at + q[block : block + size]]
        for out, own in ((forward, differ[:, most:]), (back, differ[:, most - 1 :: -1])):
            first = own.argmax(1)
            out.append(np.where(own[np.arange(len(own)), first], first, most))
    return np.concatenate(forward), np.concatenate(back)


def equal_stretches(codes: np.ndarray, lowest: int, highest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """period, low, high: for periods from lowest to highest, the stretches of places low to high - 1 that equal the place a
    period further on, among them all with ``least_equal`` places, and those from the first place on with GRAM places or more. What is shorter
    and ends at the last place lies whole in the next tile."""
    n, h, found = len(codes), gram_hashes(codes), []
    follows = next_same(h)
    nearest, margin = follows.min(initial=n), 2 * highest
    for q in range(max(lowest, nearest), min(highest + 1, SMALL, n)):
        equal = np.diff(np.concatenate([[0], (codes[q:] == codes[:-q]).view(np.int8), [0]]))
        low, high = np.flatnonzero(equal > 0), np.flatnonzero(equal < 0)
        found.append((np.full(len(low), q), low, high))
    words, octave = None, max(SMALL, 1 << (lowest.bit_length() - 1))
    while octave <= highest and octave < n:
        at = np.arange(0, len(h), octave - GRAM + 1)
        at = at[follows[at] < 2 * octave]
        if len(at):
            q = np.arange(octave, min(2 * octave, highest + 1))
            again = at[:, None] + q
            hit = (h[np.minimum(again, len(h) - 1)] == h[at][:, None]) & (again < len(h))
            dense = hit.sum(1) > DENSE
            i, j = np.nonzero(hit & ~dense[:, None])
            if len(i):
                if words is None:
                    words = np.concatenate([(none := np.full(margin, -1, np.int32)), codes, none, none])
                forward, back = _reach(words, margin, at[i], q[j], octave)
                found.append((q[j], at[i] - back, at[i] + forward))
            for a in at[dense].tolist():
                # From a on, against each place octave to 2 * octave - 1 further; before a likewise. Neither looks further than octave.
                after = z_function(codes[a : a + 3 * octave].tolist())[octave : 2 * octave]
                end, own = min(a + 2 * octave - 1, n), codes[max(0, a - octave) : a][::-1].tolist()
                before = z_function([*own, None, *codes[a - len(own) : end][::-1].tolist()])
                q = np.arange(octave, octave + len(after))
                forward = np.minimum(np.array(after, np.int64), octave)
                back = np.array(before, np.int64)[len(own) + 1 + end - a - q]  # where the word before a + q is, counted from the end
                keep = (forward >= GRAM) & (q <= highest)
                found.append((q[keep], a - back[keep], a + forward[keep]))
        octave *= 2
    period, low, high = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in found)]) for i in range(3))
    if len(period):
        period, low, high = _joined(period, low, high)
    keep = (high - low >= least_equal(period)) | ((low == 0) | (high == n - period)) & (high - low >= GRAM)
    return period[keep], low[keep], high[keep]


def tiles(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """lowest and highest period, start and end of the tiles of n words. Tiles of an octave from P on start every 8 P words
    (the lowest octaves share tiles of ``tile`` words) and hold 4 P words more: 2 P places that the next tile has as well,
    each with the place that it is compared with."""
    top = n // 2
    if n <= tile:
        yield 1, top, 0, n
        return
    shared = max(1, tile // 16)
    for t in range(0, n, tile):
        yield 1, min(2 * shared - 1, top), t, min(n, t + tile + 4 * shared)
    p = 2 * shared
    while p <= top:
        for t in range(0, n, 8 * p):
            yield p, min(2 * p - 1, top), t, min(n, t + 12 * p)
        p *= 2


_EXPLODED = "row long, doc_id string, n long, text string, sha256 string, lowest long, highest long, start long, codes binary"


def _explode(batches: Iterable[pd.DataFrame], tile: int) -> Iterator[pd.DataFrame]:
    """Of each document: a row with its digest, and with its text if words may go; its tiles in which a gram comes again."""
    columns = [x.split()[0] for x in _EXPLODED.split(", ")]
    for batch in batches:
        rows, ids, items, out, size = batch["row"].tolist(), batch["doc_id"].tolist(), grams.encoded(batch["text"]), [], 0
        for part in grams.chunks(items):
            split = [text.split() for text in items[part]]  # bytes split at the characters that WORD leaves out
            counts = np.fromiter(map(len, split), np.int64, len(split))
            codes = pd.factorize(np.array([*chain.from_iterable(split)], object))[0].astype("<i4")
            follows = next_same(gram_hashes(codes), np.repeat(np.arange(len(split)), counts))
            for row, doc_id, words, end in zip(rows[part], ids[part], split, np.cumsum(counts).tolist()):
                n, text, live = len(words), b" ".join(words), []
                first, own = end - n, follows[end - n : end]
                if own.min(initial=n) <= n // 2:
                    live = [x for x in tiles(n, tile) if own[x[2] : x[3]].min(initial=n) <= x[1]]
                out.append((row, doc_id, n, text.decode() if live else None, hashlib.sha256(text).hexdigest(), *(None,) * 4))
                if live:
                    out += [(row, doc_id, n, None, None, low, high, a, codes[first + a : first + b].tobytes()) for low, high, a, b in live]
                    size += len(text) + sum(4 * (b - a) for *_, a, b in live)
                if size > 1 << 23:
                    yield pd.DataFrame(out, columns=columns)
                    out, size = [], 0
        yield pd.DataFrame(out, columns=columns)


def _fragments(parts: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("row", "period", "low", "high"), zip(*parts))})


def _solve(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The fragments of tiles: row, period, low, high."""
    for batch in batches:
        out, size = [], 0
        for row, n, lowest, highest, start, codes in zip(*(batch[c].tolist() for c in batch)):
            codes = np.frombuffer(codes, "<i4")
            period, low, high = equal_stretches(codes, lowest, highest)
            clipped = (low == 0) & (start > 0) | (high == len(codes) - period) & (start + len(codes) < n)
            keep = clipped | (high - low >= least_equal(period))
            out.append((np.full(int(keep.sum()), row), period[keep], low[keep] + start, high[keep] + start))
            if (size := size + len(out[-1][0])) > FRAGMENTS:
                yield _fragments(out)
                out, size = [], 0
        if out:
            yield _fragments(out)


def _stitched(fragments: DataFrame) -> DataFrame:
    """row, start, length, period of the runs. A run has its words for any multiple of its smallest period as well, so of a
    stretch the smallest one is the run's."""
    own = Window.partitionBy("row", "period").orderBy("low", "high")
    reach = F.max("high").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = fragments.withColumn("begins", F.when(F.col("low") <= reach, 0).otherwise(1))
    whole = begins.withColumn("island", F.sum("begins").over(own)).groupBy("row", "period", "island").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    length = F.col("high") - F.col("start") + F.col("period")
    runs = whole.where(length >= F.greatest(F.lit(SHORTEST), 2 * F.col("period"))).select("row", "start", length.alias("length"), "period")
    return runs.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def _collapsed_sha256(text: pd.Series, runs: pd.Series) -> pd.Series:
    """Digest of the words of a text, one space apart, without those that a run holds after its first period."""

    def one(text, own):
        words = np.array(text.split(" "), object)
        change = np.zeros(len(words) + 1, np.int32)
        for r in own:
            change[r["start"] + r["period"]] += 1
            change[r["start"] + r["length"]] -= 1
        return hashlib.sha256(" ".join(words[np.cumsum(change[:-1]) == 0]).encode()).hexdigest()

    return pd.Series([None if own is None else one(t, own) for t, own in zip(text, runs, strict=True)], dtype=object)


def periodic_runs(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, n_runs; start, length, period and exponent_milli of its longest run (ties: smallest
    start, then period; nulls without a run); runs_sha256 of all its runs as lines ``start,length,period`` by start, then
    period; collapsed_sha256 of its words one space apart, without those that a run holds after its first period; runs, the
    array of (start, period, length). Words are numbered from 0.

    Null and empty texts have no words and no runs; rows without a doc_id or with equal ones are documents of their own;
    other columns are ignored; an empty table has no rows. Runs are gathered by document, whose length bounds them.
    """
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    exploded = materialise(own.mapInPandas(lambda batches: _explode(batches, tile), _EXPLODED))  # also fixes the row numbers
    live = exploded.where("codes IS NOT NULL").select("row", "n", "lowest", "highest", "start", "codes")
    runs = _stitched(live.repartition(4 * partitions(docs.sparkSession), "row", "lowest", "start").mapInPandas(_solve, "row long, period long, low long, high long"))
    by_row = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))

    collapsed = F.pandas_udf(_collapsed_sha256, "string")
    heads, none = exploded.where("codes IS NULL"), F.array().cast(by_row.schema["runs"].dataType)
    cut = heads.where("text IS NOT NULL").join(by_row, "row", "left").select("doc_id", F.coalesce("runs", none).alias("runs"), F.coalesce(collapsed("text", "runs"), "sha256").alias("collapsed_sha256"))
    every = cut.unionByName(heads.where("text IS NULL").select("doc_id", none.alias("runs"), F.col("sha256").alias("collapsed_sha256")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return every.select("runs", "collapsed_sha256", F.col("doc_id").cast("long").alias("doc_id"), longest.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length", (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "runs")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the documents, told by h, the crc32 of the id in decimal, become periodic. Of their n words,
    from a on each is the one that it follows by a multiple of p, where g is h div 10, a is g % n and p is
    1 + (n - a) div (3 + g % 8). Documents without an id stay."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    own = docs.select("doc_id", "text", words.alias("words")).withColumn("g", F.floor(h / 10)).withColumn("n", F.size("words"))
    own = own.withColumn("a", F.expr("cast(g % n as int)")).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    planted = F.array_join(F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))), " ")
    return own.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


#: Of the query with planted runs. Pairs of equal six-word grams of a document give the places that equal those q words
#: further on; stretches of them are the runs. crc32 from its definition.
ORACLE = r"""
WITH tab AS MATERIALIZED (
       SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS t),
     d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)), lambda s, x: xor(t[xor(s, x) % 256 + 1], s >> 8)), 4294967295) AS h FROM documents, tab),
     g AS (SELECT r, doc_id, w, len(w) AS n, h, h // 10 AS g FROM d),
     p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
     x AS MATERIALIZED (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w FROM p),
     six AS (SELECT r, unnest(range(n - 5)) AS i, unnest(list_transform(range(n - 5), lambda i: array_to_string(w[i+1:i+6], ' '))) AS s FROM x WHERE n >= 12),
     pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM six a JOIN six b ON a.r = b.r AND a.s = b.s AND a.i < b.i),
     islands AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 6 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k),
     runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM islands WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
     every AS (SELECT r, count(*) AS n_runs, first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best,
               string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
     gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
     kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT r, unnest(range(n)) AS i, unnest(w) AS word FROM x) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period, best.length * 1000 // best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM x LEFT JOIN every USING (r) LEFT JOIN kept USING (r)
"""
