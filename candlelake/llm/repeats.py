"""Windows that repeat across documents: the search that narrows them down to contexts, for bytes or words as symbols.

Each window of ``width`` symbols is filed under its smallest hash of ``gram`` symbols in a row, which equal windows share.
Neighbouring windows with the same smallest gram are one context. Contexts are dealt out by gram. Equal contexts are one:
the first document that has them stands for the others, whose windows all repeat its own; they are told apart by the gram
and 62 bits of two polynomials modulo primes. Of the distinct contexts, one whose gram no other has holds no repeat; all
others go to an index over their bytes or words, a shard of grams at a time, which decides on them exactly.

A gram that very many distinct contexts share is split by longer grams, down to the window itself, so that no shard grows
with the corpus. Within a task, equal contexts of later documents are settled before anything is shuffled, so that a
passage that a third of all documents have reaches a shard once for each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import grams
from .common import materialise, partitions, texts

#: Bits of a start that are the place in a row's text; see ``_place``.
_LOCAL = 32
#: Most windows in a context, for texts that repeat one symbol over and over.
MOST_WINDOWS = 128
#: A gram with more distinct contexts is split by longer grams.
CROWDED = 20_000
#: Bytes of contexts in a shard, about; contexts of one gram stay together.
SHARD_BYTES = 1_000_000
#: Bytes of text whose contexts are compared with each other before they are shuffled.
BATCH_BYTES = 8_000_000
#: Most contexts that a task remembers from batch to batch.
REMEMBERED = 100_000
ENTRY = np.dtype([("gram", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("size", "<u2")])
SPANS = "kind int, key long, doc_id long, start long, end long"


class Bytes:
    """Some texts as one array of bytes; doc (which text), first (of each text its first symbol), values and their hashes."""

    dtype = np.uint8

    def __init__(self, items: list[bytes]):
        self.buffer = b"".join(items)
        self.values = np.frombuffer(self.buffer, np.uint8)
        self.hash = grams._CODES[self.values]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(items)), np.diff(self.first))

    def part(self, i: int, start: int, end: int) -> bytes:
        """The symbols from start to end of text i."""
        return self.buffer[self.first[i] + start : self.first[i] + end]


class Words:
    """The same for words."""

    dtype = np.int64

    def __init__(self, items: list[bytes]):
        words = grams.Words(items)
        self.buffer, self.at, self.end = words.buffer, words.start, words.end
        self.values = self.hash = words.hash
        self.first, self.doc = words.first, words.doc

    def part(self, i: int, start: int, end: int) -> bytes:
        return self.buffer[self.at[self.first[i] + start] : self.end[self.first[i] + end - 1]].tobytes()


def contexts(symbols: Bytes | Words, gram: int, width: int) -> tuple[np.ndarray, ...]:
    """gram, content (hash), doc, start and size in symbols of each context of the texts."""
    values = symbols.hash
    n = len(values) - width + 1
    none = np.zeros(0, np.uint64)
    if n <= 0:
        return none, none, *[np.zeros(0, np.int64)] * 3
    sums, down = grams.prefix_hash(values)
    least = grams.mix((sums[gram:] - sums[:-gram]) * down[: len(values) - gram + 1])
    span, step = width - gram + 1, 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[:n], least[span - step : span - step + n])
    at = np.flatnonzero(symbols.doc[:n] == symbols.doc[width - 1 :])
    if not len(at):
        return none, none, *[np.zeros(0, np.int64)] * 3
    least, doc = least[at], symbols.doc[at]
    new = np.concatenate([[True], (np.diff(at) != 1) | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
    run = np.flatnonzero(new)
    within = np.arange(len(at)) - run[np.cumsum(new) - 1]
    edge = np.flatnonzero(within % MOST_WINDOWS == 0)
    low, high = at[edge], at[np.concatenate([edge[1:], [len(at)]]) - 1] + width
    return least[edge], grams.span_hash(symbols.values, low, high), doc[edge], low - symbols.first[doc[edge]], high - low


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each document, overlapping and touching ones merged."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    # Rows one after the other on a line, so that a running maximum doesn't reach from one to the next.
    place = start >> _LOCAL
    shift = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])])) - place << _LOCAL
    far = np.maximum.accumulate(end + shift) - shift
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > far[:-1])])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(doc) - 1]])
    return doc[new], start[new], far[last]


def _span_frame(kind: int, doc, start, end, key=0) -> pd.DataFrame:
    return pd.DataFrame({"kind": kind, "key": key, "doc_id": doc, "start": start, "end": end}).astype({"kind": "int32", "key": "int64", "doc_id": "int64", "start": "int64", "end": "int64"})


def _pack(own: np.ndarray) -> bytes:
    """Entries field by field and byte by byte, which compresses better than entry by entry."""
    return b"".join(np.ascontiguousarray(own[f]).view(np.uint8).reshape(len(own), -1).T.tobytes() for f in ENTRY.names)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    out, at = np.zeros(n, ENTRY), 0
    for f in ENTRY.names:
        size = ENTRY[f].itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out[f] = np.ascontiguousarray(planes.T).view(ENTRY[f]).ravel()
        at += n * size
    return out


class _Seen:
    """Contexts that a task has met often, with the first document that had them, up to a bound."""

    def __init__(self):
        self.own = np.zeros(0, ENTRY)

    def later(self, own: np.ndarray) -> np.ndarray:
        """Which entries are of a context that a document with a smaller doc_id is known to have."""
        if not len(self.own):
            return np.zeros(len(own), bool)
        at = np.minimum(np.searchsorted(self.own["content"], own["content"]), len(self.own) - 1)
        known = self.own[at]
        return (known["content"] == own["content"]) & (known["gram"] == own["gram"]) & (known["doc"] < own["doc"])

    def add(self, own: np.ndarray) -> None:
        if len(own) and len(self.own) < REMEMBERED:
            both = np.concatenate([self.own, own[: REMEMBERED - len(self.own)]])
            self.own = both[np.argsort(both["content"], kind="stable")]


def _file(rows: DataFrame, read: Callable, gram: int, width: int, buckets: int) -> DataFrame:
    """Entries of the contexts of rows (doc_id, start: of the row's first symbol, text: binary), by bucket; spans that a
    task settles come along as rows without entries."""

    def filed(own: np.ndarray, seen: _Seen) -> Iterator[pd.DataFrame]:
        own = own[np.lexsort((own["start"], own["doc"], own["content"], own["gram"]))]
        edge = np.flatnonzero(np.concatenate([[True], (own["gram"][1:] != own["gram"][:-1]) | (own["content"][1:] != own["content"][:-1])])[: len(own)])
        count = np.diff(np.concatenate([edge, [len(own)]]))
        later = (own["doc"] > np.repeat(own["doc"][edge], count)) | seen.later(own)
        seen.add(own[edge[(count >= 4) & ~later[edge]]])
        gone = own[later]
        doc, start, end = _merged(gone["doc"], gone["start"], gone["start"] + gone["size"])
        yield pd.DataFrame({"bucket": doc % buckets, "doc_id": doc, "start": start, "end": end, "entries": None, "count": 0})
        own = own[~later]
        bucket = (own["gram"] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((own["start"], own["doc"], bucket))
        own, edge = own[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
        packed = [(b, _pack(own[edge[b] : edge[b + 1]]), edge[b + 1] - edge[b]) for b in np.flatnonzero(np.diff(edge))]
        yield pd.DataFrame(packed, columns=["bucket", "entries", "count"]).assign(doc_id=0, start=0, end=0)[["bucket", "doc_id", "start", "end", "entries", "count"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, _Seen()
        for batch in batches:
            items, ids, first = list(batch["text"]), batch["doc_id"].to_numpy(), batch["start"].to_numpy()
            for part in grams.chunks(items):
                key, content, doc, start, length = contexts(read(items[part]), gram, width)
                own = np.zeros(len(key), ENTRY)
                own["gram"], own["content"], own["doc"], own["start"], own["size"] = key, content, ids[part][doc], first[part][doc] + start, length
                held.append(own)
                if (size := size + sum(map(len, items[part]))) >= BATCH_BYTES:
                    yield from filed(np.concatenate(held), seen)
                    held, size = [], 0
        if held:
            yield from filed(np.concatenate(held), seen)

    return rows.mapInPandas(run, "bucket long, doc_id long, start long, end long, entries binary, count long")


def _settle(filed: DataFrame) -> DataFrame:
    """Spans of equal contexts of later documents (kind 0), and the distinct contexts that share a gram with others, if they
    aren't all of one document (kind 1), with their gram as key. Rows come bucket by bucket."""

    def settled(held: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        own = np.concatenate(held)
        own = own[np.lexsort((own["doc"], own["content"], own["gram"]))]
        group = np.concatenate([[True], own["gram"][1:] != own["gram"][:-1]])
        new = group | np.concatenate([[True], own["content"][1:] != own["content"][:-1]])
        first = own["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = own[own["doc"] > first]
        yield _span_frame(0, *_merged(gone["doc"], gone["start"], gone["start"] + gone["size"]))
        at, of = np.flatnonzero(group), np.cumsum(group) - 1
        several = (np.add.reduceat(new.astype(np.int64), at) > 1) & (np.minimum.reduceat(own["doc"], at) < np.maximum.reduceat(own["doc"], at))
        left = own[several[of] & new]
        again = own[several[of] & ~new & (own["doc"] == first)]  # the same context elsewhere in its first document
        for x in (left, again):
            yield _span_frame(1, x["doc"], x["start"], x["start"] + x["size"], x["gram"].view(np.int64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, current = [], None
        for batch in batches:
            done = batch[batch["count"] == 0]
            yield _span_frame(0, done["doc_id"], done["start"], done["end"])
            for bucket, raw, c in zip(batch["bucket"], batch["entries"], batch["count"]):
                if not c:
                    continue
                if bucket != current and held:
                    yield from settled(held)
                    held = []
                current = bucket
                held.append(_unpack(raw, c))
        if held:
            yield from settled(held)

    return filed.mapInPandas(run, SPANS)


def _place(docs: DataFrame) -> Column:
    """What tells rows apart that share a doc_id: where a doc_id has several texts, they are parts of one document, each at
    a place of its own, and its symbols' numbers go on from there; else the place is 0."""
    twins = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")).where("a <> b")
    return F.lit(0).cast("long") if twins.isEmpty() else F.shiftleft(F.xxhash64("text").bitwiseAND(F.lit(2**30 - 1)), _LOCAL)


def _by_document(spans: DataFrame, *fields: str) -> DataFrame:
    """of, at (place) and the spans of each row of a document, as an array: no more than it has symbols."""
    local = F.lit(2**_LOCAL - 1)
    place = F.col("start").bitwiseAND(F.bitwise_not(local))
    own = spans.select(F.col("doc_id").alias("of"), place.alias("at"), F.struct(*[(F.col(f) - place if f in ("start", "end") else F.col(f)).alias(f) for f in fields]).alias("s"))
    return own.groupBy("of", "at").agg(F.collect_list("s").alias("spans")).hint("merge")


def _fetch(docs: DataFrame, wanted: DataFrame, read: Callable) -> DataFrame:
    """key, doc_id, start and text (binary) of contexts (key, doc_id, start, end), from the texts (doc_id, place, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            items = grams.encoded(batch["text"])
            for part in grams.chunks(items):
                symbols, rows = read(items[part]), []
                for i, (doc, place, *spans) in enumerate(zip(*(batch[c].iloc[part] for c in ("doc_id", "place", "key", "low", "high")))):
                    rows += [(k, doc, place + a, symbols.part(i, a, b)) for k, a, b in zip(*map(np.ndarray.tolist, spans))]
                yield pd.DataFrame(rows, columns=["key", "doc_id", "start", "text"]).astype({"key": "int64", "doc_id": "int64", "start": "int64"})

    spans = _by_document(wanted, "key", "start", "end")
    both = docs.join(spans, (F.col("doc_id") == F.col("of")) & (F.col("place") == F.col("at")))
    both = both.select("doc_id", "place", "text", F.col("spans.key").alias("key"), F.col("spans.start").alias("low"), F.col("spans.end").alias("high"))
    return both.mapInPandas(run, "key long, doc_id long, start long, text binary")


class Shard:
    """The contexts of a shard: their symbols in one array, set apart, with document and place of each context. Bytes are
    symbols as they are; words are numbered, equal words alike."""

    def __init__(self, items: list[bytes], doc: np.ndarray, start: np.ndarray, dtype=np.uint8):
        self.doc, self.start = doc, start
        if dtype == np.uint8:
            self.size = np.fromiter(map(len, items), np.int64, len(items))
            self.values = np.frombuffer(b"".join(items), np.uint8)
        else:
            known: dict[bytes, int] = {}
            words = [[known.setdefault(w, len(known)) for w in x.split()] for x in items]
            self.size = np.fromiter(map(len, words), np.int64, len(words))
            self.values = np.fromiter(chain.from_iterable(words), np.int64, int(self.size.sum()))
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.of = np.repeat(np.arange(len(items)), self.size)


def in_shards(fetched: DataFrame, decide: Callable[[Shard], Iterator[pd.DataFrame]], dtype, schema: str) -> DataFrame:
    """What ``decide`` gives for each shard of contexts; a shard holds whole grams and is of bounded size."""
    parts = partitions(fetched.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def shard() -> Iterator[pd.DataFrame]:
            own = pd.concat(held, ignore_index=True)
            order = np.lexsort((own["start"], own["doc_id"], own["key"]))  # the same whatever order rows come in
            own = own.iloc[order]
            yield from decide(Shard(own["text"].tolist(), own["doc_id"].to_numpy(), own["start"].to_numpy(), dtype))

        for batch in batches:
            if not len(batch):
                continue
            key, before = batch["key"].to_numpy(), np.concatenate([[0], np.cumsum(batch["text"].str.len())])
            edge = np.flatnonzero(np.concatenate([[bool(held) and held[-1]["key"].iloc[-1] != key[0]], key[1:] != key[:-1]]))
            at = 0
            while len(cut := edge[(edge >= at) & (size + before[edge] - before[at] >= SHARD_BYTES)]):
                held.append(batch.iloc[at : cut[0]])
                yield from shard()
                held, size, at = [], 0, int(cut[0])
                edge = edge[edge > at]
            held.append(batch.iloc[at:])
            size += int(before[-1] - before[at])
        if held:
            yield from shard()

    return fetched.repartition(parts, "key").sortWithinPartitions("key").mapInPandas(run, schema)


def _narrowed(fetched: DataFrame, read: Callable, gram: int, width: int) -> DataFrame:
    """The contexts by longer grams within fetched ones: key, doc_id, start, end, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            symbols, doc_id, first = read(batch["text"].tolist()), batch["doc_id"].to_numpy(), batch["start"].to_numpy()
            key, _, at, start, size = contexts(symbols, gram, width)
            text = [symbols.part(i, a, a + n) for i, a, n in zip(at.tolist(), start.tolist(), size.tolist())]
            yield pd.DataFrame({"key": key.view(np.int64), "doc_id": doc_id[at], "start": first[at] + start, "end": first[at] + start + size, "text": text})

    return fetched.mapInPandas(run, "key long, doc_id long, start long, end long, text binary")


def open_contexts(docs: DataFrame, read: Callable, gram: int, width: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(spans that are settled, distinct contexts that share a gram, as fetched) of placed texts. Contexts of crowded grams
    go on to longer grams, level by level, from what has been fetched."""
    parts = partitions(docs.sparkSession)
    rows = docs.select("doc_id", F.col("place").alias("start"), F.col("text").cast("binary").alias("text"))
    # Entries take about twice the room of the texts, so they go to twice as many tasks.
    filed = _file(rows, read, gram, width, 8 * parts).repartition(2 * parts, "bucket").sortWithinPartitions("bucket")
    found = materialise(_settle(filed), "kind")
    settled, opened, own = [found.where("kind = 0").select("doc_id", "start", "end")], [], found.where("kind = 1")
    fetched, counted = _fetch(docs, own, read), own
    while gram < width:
        crowded = materialise(counted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).select("key"))
        if crowded.isEmpty():
            break
        fetched = materialise(fetched)
        opened.append(fetched.join(crowded, "key", "left_anti"))
        gram = width if 4 * gram >= 3 * width else (gram + width) // 2
        narrowed = materialise(_narrowed(fetched.join(crowded, "key", "left_semi"), read, gram, width))
        first = narrowed.groupBy("key", "text").agg(F.min("doc_id").alias("first"))
        both = materialise(narrowed.join(first, ["key", "text"]))
        settled.append(both.where("doc_id > first").select("doc_id", "start", "end"))
        fetched = counted = both.where("doc_id = first").select("key", "doc_id", "start", "text")
    return settled, [*opened, fetched]


def repeated_spans(docs: DataFrame, read: Callable, decide: Callable, gram: int, width: int) -> DataFrame:
    """of, at, spans: for each row with windows that start in a document of a smaller doc_id too, the spans of symbols that
    they cover (array of start and end; they may overlap).

    ``decide(shard, width)`` gives (context, start in it, end) of the spans of a shard of contexts that repeat.
    """

    def run(shard: Shard) -> Iterator[pd.DataFrame]:
        context, start, end = decide(shard, width)
        yield _span_frame(0, *_merged(shard.doc[context], shard.start[context] + start, shard.start[context] + end))

    spans, opened = open_contexts(docs, read, gram, width)
    for fetched in opened:
        decided = materialise(in_shards(fetched, run, read.dtype, SPANS))
        spans.append(decided.select("doc_id", "start", "end"))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return _by_document(out, "start", "end")


def apply_spans(docs: DataFrame, read: Callable, decide: Callable, gram: int, width: int, cut: Callable, schema: str) -> DataFrame:
    """doc_id and ``cut(text as bytes, merged spans as an array of start and end)`` of each row."""
    docs = texts(docs)
    placed = docs.withColumn("place", _place(docs))
    spans = repeated_spans(placed.where("doc_id IS NOT NULL"), read, decide, gram, width)

    @F.pandas_udf(schema)
    def run(text: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
        rows = []
        for t, start, end in zip(grams.encoded(text), low, high):
            pairs = np.zeros((0, 2), np.int64)
            if start is not None and len(start):
                pairs = np.stack(_merged(np.zeros(len(start), np.int64), np.asarray(start, np.int64), np.asarray(end, np.int64))[1:], 1)
            rows.append(cut(t, pairs))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    # Rows without a doc_id match no spans and keep all.
    both = placed.join(spans, (F.col("doc_id") == F.col("of")) & (F.col("place") == F.col("at")), "left")
    return both.select("doc_id", run("text", "spans.start", "spans.end").alias("r")).select("doc_id", "r.*")
