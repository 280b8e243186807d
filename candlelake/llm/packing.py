"""Packing tokenised documents into sequences by non-negative least squares.

Documents are cut into pieces of at most a window; pieces are counted by length. Shallow combinations of lengths (up to
three) that fill a window exactly are enumerated, and non-negative least squares finds how often each should be repeated
to use up the histogram. The repeats are rounded down to what there is, and what remains is packed greedily. All of that
works on the histogram, whose size is the window's; pieces then find their place by their rank among those of their
length, so no piece ever passes through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SEPARATORS, materialise, texts, tidied

PIECES = "doc_id long, named boolean, start long, length long, ids_crc32 long, doc_tokens long, part int, place long"
_IS = {name: np.isin(np.arange(256), list(own)) for name, own in (("mark", b".,;:!?"), ("letter", bytes(range(97, 123))), ("separator", SEPARATORS))}


class _Places(dict):
    """Gives each new key the next number and lists it in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        self.new.append(key)
        place = self[key] = len(self)
        return place


class Encoder:
    """Token ids of texts, for tokenizers that never join what white space parts, lower-case and drop white space.

    Words are encoded once and remembered, up to a bound.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.is_end = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.is_end[ends] = True
        self.forget()

    def forget(self) -> None:
        """Words that were encoded go, the tokenizer stays."""
        self.places = _Places()
        self.flat = np.zeros(0, np.uint32)
        self.start = self.size = np.zeros(0, np.int64)

    def _ids(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids one after the other, and where those of each line end."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in lines], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.cumsum([len(x) for x in found], dtype=np.int64)

    def _learn(self, words: list[bytes]) -> None:
        plain = np.fromiter(map(_letters, words), bool, len(words))
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for own in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            if not len(own):
                continue
            part, ends = [words[i] for i in own], np.zeros(0)
            if plain[own[0]]:  # letters are one unit of the tokenizer, which ends with a token that says so: many to a line
                ids, _ = self._ids([b" ".join(part[i : i + 1000]) for i in range(0, len(part), 1000)])
                ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):
                ids, ends = self._ids(part)
            size[own] = np.diff(ends, prepend=0)
            start[own] = len(self.flat) + ends - size[own]
            self.flat = np.concatenate([self.flat, ids])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])

    def encode(self, items: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts, each followed by the id ``end``."""
        special = {i: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for i, t in enumerate(items) if "<|" in t}  # may spell special tokens
        split = _split([b"" if i in special else t.encode("utf-8", "replace").lower() for i, t in enumerate(items)])
        if len(self.places) > self.most:
            self.forget()
        at = np.array(list(map(self.places.__getitem__, chain.from_iterable(split))), np.int64)
        if self.places.new:
            self._learn(self.places.new)
            self.places.new = []
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[at] - (ends - size), size) + np.arange(size.sum())]
        edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)]
        last = np.array([end], np.uint32)
        out = [part for i in range(len(items)) for part in (special.get(i, ids[edge[i] : edge[i + 1]]), last)]
        sizes = np.array([len(out[2 * i]) + 1 for i in range(len(items))], np.int64)
        return np.concatenate([ids[:0], *out]), np.concatenate([[0], np.cumsum(sizes)])


def _split(items: list[bytes]) -> list[list[bytes]]:
    """Words of texts in lower case. A mark between a letter and white space is a word of its own, as it is a unit of its
    own for the tokenizer: so fewer words are distinct."""
    buffer = np.frombuffer(b" ".join([*items, b""]), np.uint8)
    offset = np.concatenate([[0], np.cumsum([len(x) + 1 for x in items])]).astype(np.int64)
    mark = np.flatnonzero(_IS["mark"][buffer])
    mark = mark[(mark > 0) & _IS["letter"][buffer[mark - 1]] & _IS["separator"][buffer[mark + 1]]]
    parted = np.insert(buffer, mark, 32).tobytes()
    offset += np.searchsorted(mark, offset)
    return [parted[a:b].split() for a, b in zip(offset[:-1].tolist(), offset[1:].tolist())]


def _letters(word: bytes) -> bool:
    return word.isalpha() or bool(word) and not word.isascii() and word.decode("utf-8", "replace").isalpha()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker; of a tokenizer that is loaded anew, memory isn't all returned."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(docs: DataFrame, tokenizer_path: str, window: int, end: int) -> DataFrame:
    """The pieces of all documents, with their rank (place) among the pieces of their length in their task (part)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen, own_encoder = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64), encoder(tokenizer_path)
        try:
            for batch in batches:
                for i in range(0, len(batch), 500):
                    own = batch.iloc[i : i + 500]
                    ids, bounds = own_encoder.encode(list(own["text"]), end)
                    raw, sizes = memoryview(ids.astype("<u4").tobytes()), np.diff(bounds)
                    count = -(-sizes // window)
                    row = np.repeat(np.arange(len(own)), count)
                    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * window
                    length = np.minimum(window, sizes[row] - start)
                    at = bounds[row] + start
                    crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                    place = seen[length] + pd.Series(length).groupby(length).cumcount().to_numpy()
                    seen += np.bincount(length, minlength=window + 1)
                    yield pd.DataFrame({"doc_id": own["doc_id"].to_numpy()[row], "named": own["named"].to_numpy()[row], "start": start, "length": length, "ids_crc32": crc, "doc_tokens": sizes[row], "part": part, "place": place})
        finally:
            own_encoder.forget()  # the worker stays, and later stages need the room

    named = F.col("doc_id").isNotNull()
    return texts(docs).select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), named.alias("named"), "text").mapInPandas(tidied(run), PIECES)


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of up to three of the lengths, ascending and padded by 0 in front, that sum to the window."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = [np.array([[0, 0, window]])] if have[window] else []
    a = lengths[lengths * 2 <= window]
    a = a[have[window - a]]
    out.append(np.stack([np.zeros_like(a), a, window - a], 1))
    for x in lengths[lengths * 3 <= window]:
        y = lengths[(lengths >= x) & (lengths * 2 <= window - x)]
        y = y[have[window - x - y]]
        out.append(np.stack([np.full_like(y, x), y, window - x - y], 1))
    return np.concatenate(out)


def repeats(rows: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative least squares: how often to use each combination so that the uses of lengths come near the counts.

    Accelerated projected gradient; a combination touches three lengths at most, so a step is a few passes over the rows.
    """
    n = len(counts)
    use = lambda x: sum(np.bincount(rows[:, j], x, n) for j in range(3)) * (np.arange(n) > 0)
    back = lambda r: r[rows].sum(1)
    v = np.ones(len(rows))
    for _ in range(20):
        v = back(use(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        grad = use(y) - counts
        grad[0] = 0
        new = np.maximum(0, y - back(grad) / norm)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        x, y = new, new + (before - 1) / t * (new - x)
    return x


def plan(histogram: dict[int, int], window: int) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences): every piece of the histogram is in one."""
    left = np.zeros(window + 1, np.int64)
    for n, c in histogram.items():
        left[n] = c
    lengths, out = np.flatnonzero(left), []
    if len(lengths):
        rows = combinations(lengths, window)
        if len(rows):
            found = repeats(rows, left.astype(float))
            for i in np.argsort(-found, kind="stable"):
                if found[i] < 0.5:
                    break
                row = [int(n) for n in rows[i] if n]
                uses = {n: row.count(n) for n in row}
                if times := min(round(found[i]), *(int(left[n]) // k for n, k in uses.items())):
                    for n, k in uses.items():
                        left[n] -= k * times
                    out.append((row, times))
    # Residuals: the longest piece first, then always the longest that still fits.
    while left.any():
        row, room, took = [], window, left.copy()
        while room and len(fits := np.flatnonzero(took[: room + 1])):
            n = int(fits[-1])
            took[n] -= 1
            row.append(n)
            room -= n
        uses = {n: row.count(n) for n in row}
        times = min(int(left[n]) // k for n, k in uses.items())
        for n, k in uses.items():
            left[n] -= k * times
        out.append((row, times))
    return out


def slots(strategies: list[tuple[list[int], int]]) -> pd.DataFrame:
    """Which ranks of a length go where: length, first (rank), sequence (of that rank), offset; a row for each slot."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in strategies:
        offset = 0
        for n in lengths:
            rows.append((n, rank.get(n, 0), base, offset))
            rank[n] = rank.get(n, 0) + times
            offset += n
        base += times
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text counts as empty and is the one id ``end``. Longer documents are cut at multiples of the window. Rows that
    repeat a doc_id, or have none, are packed one by one; an empty table gives no pieces; extra columns are ignored,
    whatever their names.
    """
    spark = docs.sparkSession
    pieces = materialise(cut(docs, tokenizer_path, window, end))
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_part = materialise(by_part.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length of the window at most
    table = spark.sparkContext.broadcast(slots(plan(histogram, window)))
    # There is a row for each task and length, so that table grows with the corpus: it is merged, not broadcast.
    bases = by_part.select("part", "length", "base").hint("merge")
    ranked = pieces.join(bases, ["part", "length"]).select("doc_id", "named", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("place")).alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = table.value
        key = own["length"].to_numpy() * (1 << 44) + own["first"].to_numpy()
        first, sequence, offset = (own[c].to_numpy() for c in ("first", "sequence", "offset"))
        for batch in batches:
            rank = batch.pop("rank").to_numpy()
            at = np.searchsorted(key, batch["length"].to_numpy() * (1 << 44) + rank, "right") - 1
            yield batch.assign(sequence_id=sequence[at] + rank - first[at], offset=offset[at])

    out = ranked.mapInPandas(tidied(place), "doc_id long, named boolean, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.select(F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), *out.columns[2:])
