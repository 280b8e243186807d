"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A test item is leaked into a document when the document holds at least ``threshold`` of the item's distinct shingles.
Items are partitioned by size; each has as its signature the smallest hashes of its shingles, one more than the shingles
that a leaked item may lack. Documents are probed with the hashes of all their shingles rather than with a signature of
their own, so a document that holds the item holds a part of its signature: the search misses nothing, however long the
document is. Candidates are then counted on the words themselves.

A filter of bounded size, built by Spark from the signatures, goes to all tasks; documents whose shingles pass it, which are
few, are joined to the signatures. So the corpus is read once, and no item passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grams
from .common import free_name, materialise, texts, tidied

SCHEMA = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"
#: Bits of the filter for each hash, probes of a hash, and the most bits of all.
FILTER_BITS, PROBES, MOST_BITS = 64, 4, 1 << 28


def _shingles(words: grams.Words, gram: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the sequences of ``gram`` words; those of fewer than k words are hashed as a short item is."""
    if gram == k:
        at, found = words.grams(k)
        return words.doc[at], found
    n = len(words.hash)
    h = np.zeros(max(0, n - gram + 1), np.uint64)
    for j in range(gram):
        h = h * grams._SHINGLE + words.hash[j : n - gram + 1 + j]
    at = np.flatnonzero(words.doc[: len(h)] == words.doc[gram - 1 :]) if len(h) else np.zeros(0, np.int64)
    return words.doc[at], grams.mix(h[at] ^ np.uint64(gram))


def _lacking(n: np.ndarray, threshold: float) -> np.ndarray:
    """Shingles of n that a leaked item may lack."""
    return n - np.array([math.ceil(threshold * x - 1e-9) for x in n], np.int64)


def signatures(items: DataFrame, k: int, threshold: float) -> DataFrame:
    """item, size_class, gram (words of a shingle), hash: the smallest hashes of each item (item, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts_, ids = list(batch["text"]), batch["item"].to_numpy()
            bounds, hashes = grams.sets(texts_, k, grams.LOWER_WORDS)
            words, size = grams.Words(texts_, grams.LOWER_WORDS).counts(), np.diff(bounds)
            # By powers of two of their size; items of fewer than k words, which are one shingle, by their words.
            gram = np.minimum(words, k)
            own = np.where(words >= k, 100 + np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), gram)
            count = np.where(size > 0, _lacking(size, threshold) + 1, 0)
            row = np.repeat(np.arange(len(ids)), count)
            at = bounds[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            yield pd.DataFrame({"item": ids[row], "size_class": own[row], "gram": gram[row], "hash": hashes[at].view(np.int64)})

    return items.select("item", F.col("text").cast("binary").alias("text")).mapInPandas(tidied(run), "item long, size_class long, gram long, hash long")


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """The places of each hash in a filter of that many bits, a power of two: a row for each probe."""
    step = grams.mix(hashes) | np.uint64(1)
    return np.stack([(hashes + np.uint64(p) * step) & np.uint64(size - 1) for p in range(PROBES)])


def _filter(own: DataFrame, count: int) -> np.ndarray:
    """The words of 64 bits of a Bloom filter of the hashes; Spark merges them."""
    size = min(MOST_BITS, 1 << max(10, (FILTER_BITS * count).bit_length()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.unique(_bits(batch["hash"].to_numpy().view(np.uint64), size))
            yield pd.DataFrame({"word": (bits >> np.uint64(6)).astype(np.int64), "mask": (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)})

    out = np.zeros(size // 64, np.uint64)
    found = own.mapInPandas(tidied(run), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def _passing(docs: DataFrame, bloom, sizes: list[int], k: int) -> DataFrame:
    """row, doc_id, text, gram, hash (array) of the documents with shingles that pass the filter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = bloom.value
        for batch in batches:
            items = [bytes(x) for x in batch["text"]]
            for part in grams.chunks(items):
                own, rows = batch.iloc[part], []
                found = grams.Words(items[part], grams.LOWER_WORDS)
                for gram in sizes:
                    doc, hashes = _shingles(found, gram, k)
                    good = np.ones(len(hashes), bool)
                    for bits in _bits(hashes, 64 * len(words)) if len(hashes) else ():
                        good &= (words[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1) == 1
                    doc, hashes = doc[good], hashes[good].view(np.int64)
                    edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])[: len(doc)])
                    rows += [(doc[a], gram, np.unique(hashes[a:b])) for a, b in zip(edge, [*edge[1:], len(doc)])]
                if not rows:
                    continue
                at = [r[0] for r in rows]
                yield own.iloc[at].reset_index(drop=True).assign(gram=[r[1] for r in rows], hash=[r[2] for r in rows])

    return docs.mapInPandas(tidied(run), "row long, doc_id long, named boolean, text binary, gram long, hash array<long>")


def _verified(pairs: DataFrame, k: int, threshold: float) -> DataFrame:
    """row, item, n_item_shingles, n_shared of the pairs (row, item, text, item_text) that reach the threshold, counted on
    words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = lambda x: bytes(x).translate(grams.LOWER_WORDS).split()
        for batch in batches:
            rows = []
            for row, item, text, item_text in batch[["row", "item", "text", "item_text"]].itertuples(index=False):
                own, words = split(item_text), split(text)
                gram = min(k, len(own))
                wanted = {tuple(own[i : i + gram]) for i in range(len(own) - gram + 1)}
                shared = len(wanted & set(zip(*(words[j:] for j in range(gram)))))
                if shared >= math.ceil(threshold * len(wanted) - 1e-9):
                    rows.append((row, item, len(wanted), shared))
            yield pd.DataFrame(rows, columns=["row", "item", "n_item_shingles", "n_shared"]).astype("int64")

    return pairs.mapInPandas(tidied(run), "row long, item long, n_item_shingles long, n_shared long")


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.75) -> DataFrame:
    """One row per leak: doc_id, item_id, n_item_shingles, n_shared, containment.

    Words are runs of bytes that are neither white space nor ASCII punctuation, with A-Z in lower case. Items of fewer than
    k words count as one shingle of that many words. Null or empty items and texts match nothing; an item that occurs twice
    with one text counts once, and item_ids with several texts are reported for each. Rows that repeat a doc_id, or have
    none, are judged one by one, and so are items without an item_id. Empty tables give an empty result; extra columns are
    ignored, whatever their names; texts may have any length.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    items = materialise(items.withColumn("item", F.monotonically_increasing_id()))
    own = materialise(signatures(items, k, threshold))
    sizes = sorted(r["gram"] for r in own.groupBy("gram").count().collect())  # k and smaller numbers
    bloom = spark.sparkContext.broadcast(_filter(own, own.count()))
    rows = texts(docs).select(F.monotonically_increasing_id().alias("row"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), F.col("text").cast("binary").alias("text"))
    passing = materialise(_passing(rows, bloom, sizes, k))
    probes = passing.select("row", "gram", F.explode("hash").alias("hash"))
    pairs = probes.join(own.select("gram", "hash", "item"), ["gram", "hash"]).select("row", "item").distinct()
    held = passing.select("row", "text").dropDuplicates(["row"])
    pairs = pairs.join(held, "row").join(items.select("item", F.col("text").cast("binary").alias("item_text")), "item")
    found = _verified(pairs.select("row", "item", "text", "item_text"), k, threshold)
    ids = passing.select("row", F.when(F.col("named"), F.col("doc_id")).alias("doc_id")).distinct()
    out = found.join(ids, "row").join(items.select("item", "item_id"), "item")
    return out.select("doc_id", "item_id", "n_item_shingles", "n_shared", (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.75) -> DataFrame:
    """The documents without a leaked item, with all columns of the input. A row without doc_id can't be named and stays."""
    bad = leaks(docs.where("doc_id IS NOT NULL"), benchmark, k, threshold).select(F.col("doc_id").alias(free_name(docs, "leaked"))).distinct()
    return docs.join(bad, docs["doc_id"].cast("long") == bad[bad.columns[0]], "left_anti")


#: DuckDB SQL of the query's result.
ORACLE = r"""
WITH i AS (SELECT item_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
     d AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
     si AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda x: array_to_string(w[x:x+4], ' '))) AS s FROM i),
     sd AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda x: array_to_string(w[x:x+4], ' '))) AS s FROM d),
     n AS (SELECT item_id, count(*) AS n_item_shingles FROM si GROUP BY 1),
     c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM sd JOIN si USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles AS containment
FROM c JOIN n USING (item_id) WHERE 4 * n_shared >= 3 * n_item_shingles
UNION ALL
SELECT doc_id, item_id, 1, 1, 1.0 FROM d JOIN i ON len(i.w) BETWEEN 1 AND 4 AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(i.w, ' ') || ' ')
"""
ORACLE = ORACLE.replace("lower(text)", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
