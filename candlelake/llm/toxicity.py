"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic samples. A text is cut into windows of ``window``
words; each window is compressed with either dictionary, and the difference of the two lengths, relative to the window's
own, is its gain. Windows whose gain reaches a threshold that is calibrated on the training rows count as hits; a logistic
curve over the hits, fitted on the same rows, is the score.

Compressed lengths of a few letters are too coarse to compare, so words are spelt for the compressor: the codes of a
word's first four and first five letters and of the whole word, twelve bytes each. Toxic samples are the words, and words
with the stems, that training documents marked toxic use more often than chance and the number of words tried explain.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, materialise, texts

WORD = re.compile(r"[^\W\d_]+")


def spelt(word: str) -> bytes:
    """The codes of a word, which is in lower case."""
    return b"".join(hashlib.blake2b(f"{n}:{word[:n]}".encode("utf-8", "surrogatepass"), digest_size=12).digest() for n in (4, 5, 99) if n == 99 or len(word) >= n)


@dataclass
class Gains:
    """Compressed length with the ordinary dictionary less that with the toxic one, in percent of the window's length."""

    ordinary: bytes
    toxic: bytes
    level: int = 3
    most: int = 200_000
    _known: dict = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self._pack = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "level": self.level, "most": self.most, "_known": {}, "_pack": None}

    def _compressors(self):
        def one(content: bytes):
            d = zstandard.ZstdCompressionDict(content)
            d.precompute_compress(level=self.level)
            return zstandard.ZstdCompressor(level=self.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress

        return one(self.ordinary), one(self.toxic)

    def __call__(self, window: str) -> int:
        if (gain := self._known.get(window)) is None:
            self._pack = self._pack or self._compressors()
            codes = b"".join(map(spelt, window.split(" ")))
            gain = 100 * (len(self._pack[0](codes)) - len(self._pack[1](codes))) // len(codes)
            if len(self._known) >= self.most:  # a bounded memory of windows seen
                self._known.clear()
            self._known[window] = gain
        return gain


@dataclass
class Model:
    gains: Gains
    threshold: int
    weights: tuple[float, float, float]
    window: int = 1

    def score(self, hits: Column, words: Column) -> Column:
        a, b, c = self.weights
        return 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.least(hits, F.lit(8)) + F.lit(c) * F.try_divide(hits, F.greatest(words, F.lit(1))))))


def windows(text: str, window: int) -> list[str]:
    words = WORD.findall(text.lower())
    return words if window == 1 else [" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))] if words else []


def _found(gains: Gains, window: int, threshold: int):
    """Column function of a text: hits (windows that reach the threshold), words, strongest gain."""

    @F.pandas_udf("hits long, words long, strongest int")
    def run(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            found = np.fromiter(map(gains, w := windows(t, window)), np.int64, len(w)) if t else np.zeros(0, np.int64)
            rows.append((int((found >= threshold).sum()), len(found), int(found.max(initial=0))))
        return pd.DataFrame(rows, columns=["hits", "words", "strongest"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text, toxic (0 or 1) of ``most`` labelled documents at most, those that a hash of the id puts first.

    A document with several labels counts as toxic if one says so; labels without a mark or a doc_id are ignored.
    """
    marks = labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = marks.orderBy(F.xxhash64("labelled"), "labelled").limit(most)
    rows = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    return materialise(rows.select("doc_id", "text", "toxic"))


def _words(rows: DataFrame) -> DataFrame:
    """word, toxic (documents of that kind that use it), ordinary. Documents that agree in the three smallest hashes of their
    words are near copies and count as one: else the chance words of a text that was copied often would look telling. Sets of
    words that differ much hardly ever agree in them, whatever single words they share."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    smallest = F.slice(F.array_sort(F.transform("words", lambda w: F.xxhash64(w))), 1, 3)
    rows = rows.select("toxic", words.alias("words")).withColumn("copies", F.xxhash64(smallest))
    own = rows.select(F.explode("words").alias("word"), "copies", "toxic").distinct()
    return own.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary"))


def _chance(n: dict[int, int]) -> Column:
    """Logarithm of a bound (Chernoff's) on the chance of a unit's share of toxic documents, were it as common among both."""
    q, t, o = n[1] / (n[0] + n[1]), F.col("toxic"), F.col("ordinary")
    part = lambda x, share: F.when(x > 0, x * F.log(x / ((t + o) * share))).otherwise(0.0)
    return F.when(t > (t + o) * q, -(part(t, q) + part(o, 1 - q))).otherwise(0.0)


def telling_units(counts: DataFrame, n: dict[int, int], samples: int) -> tuple[set[str], set[str]]:
    """(words, stems of four letters) that tell toxic documents, of the word counts; n has the documents of each kind.

    By Benjamini and Hochberg's rule, false ones are a hundredth of them at most, or a tenth where a hundredth leaves none;
    and their share among toxic documents has to be eight times that among the others. The ``samples`` most telling of
    either are looked at.
    """
    stems = counts.where(F.length("word") >= 4).groupBy(F.substring("word", 1, 4).alias("unit")).agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    units = counts.select(F.lit(False).alias("stem"), F.col("word").alias("unit"), "toxic", "ordinary").unionByName(stems.select(F.lit(True).alias("stem"), "unit", "toxic", "ordinary"))
    units = materialise(units.where("toxic >= 2"))
    tried = units.count()
    rows = units.withColumn("chance", _chance(n)).orderBy("chance", "unit", "stem").limit(2 * samples).collect()
    discard(units)
    share = lambda c, kind: (c + 0.5) / (n[kind] + 1)
    for rate in (0.01, 0.1):
        below = [i for i, r in enumerate(rows, 1) if r["chance"] <= math.log(rate * i / tried)]
        found = [r for r in rows[: max(below, default=0)] if share(r["toxic"], 1) >= 8 * share(r["ordinary"], 0) and r["toxic"] >= n[1] / (100 if r["stem"] else 200)]
        if found:
            break
    return {r["unit"] for r in found if not r["stem"]}, {r["unit"] for r in found if r["stem"]}


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, window: int = 1, dictionary_bytes: int = 96_000, samples: int = 6_000, level: int = 3) -> Model | None:
    """A model of the labelled rows among docs; None when they don't hold both kinds, or no word tells them apart.

    ``max_rows`` bounds the labelled documents that are used, ``samples`` the distinct words of each kind that are sampled
    for a dictionary. Counts of words are aggregated by Spark; only those samples and the counts of hits reach the driver.
    """
    rows = training_rows(docs, labels, max_rows)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    counts = materialise(_words(rows))
    words, stems = telling_units(counts, n, samples)
    if not words and not stems:
        return None
    telling = F.col("word").isin(sorted(words)) | F.substring("word", 1, 4).isin(sorted(stems))
    chosen = counts.where(telling & (F.col("toxic") > 0)).orderBy(F.desc("toxic"), "word").limit(samples).select("word", "toxic").collect()
    usual = counts.where(~telling & (F.col("ordinary") > 0)).orderBy(F.desc("ordinary"), "word").limit(samples).select("word", "ordinary").collect()
    if not usual:
        return None
    gains = Gains(_dictionary([(r["word"], r["ordinary"]) for r in usual], dictionary_bytes), _dictionary([(r["word"], r["toxic"]) for r in chosen], dictionary_bytes), level)
    # Calibration: of all thresholds, the one that tells the kinds apart best by whether a document has a hit.
    strongest = rows.select("toxic", _found(gains, window, 1)("text")["strongest"].alias("strongest")).groupBy("strongest", "toxic").count().collect()
    tried = sorted({max(1, r["strongest"]) for r in strongest})
    right = {t: sum(r["count"] / n[r["toxic"]] for r in strongest if (r["strongest"] >= t) == bool(r["toxic"])) for t in tried}
    best = [t for t in tried if right[t] >= max(right.values()) - 1e-3]
    threshold = best[0]
    found = rows.select("toxic", _found(gains, window, threshold)("text").alias("f")).select("toxic", "f.*")
    table = found.groupBy(F.least("hits", F.lit(8)).alias("hits"), F.round(F.col("hits") / F.greatest("words", F.lit(1)), 3).alias("rate"), "toxic").count().collect()
    discard(rows, counts)
    return Model(gains, threshold, _logistic([(r["hits"], r["rate"], r["toxic"], r["count"] / n[r["toxic"]]) for r in table]), window)


def _dictionary(samples: list[tuple[str, int]], size: int) -> bytes:
    """A zstandard dictionary trained on spelt words, each repeated by the logarithm of its count."""
    spelled = [spelt(w) for w, c in samples for _ in range(2 + int(math.log2(1 + c)))]
    while len(spelled) < 4000:
        spelled = spelled * 2
    return zstandard.train_dictionary(min(size, max(1024, sum(map(len, spelled)) // 4)), spelled, k=36, d=6, level=3).as_bytes()


def _logistic(rows: list[tuple[float, float, int, float]], ridge: float = 1e-3, steps: int = 50) -> tuple[float, float, float]:
    """Weights of intercept, hits and rate by Newton's method, both kinds weighing the same; ridge keeps them finite."""
    x, y, w = np.array([[1, h, r] for h, r, _, _ in rows], float), np.array([t for *_, t, _ in rows], float), np.array([c for *_, c in rows], float)
    b = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (w * (y - p)) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1]), float(b[2])


def toxicity(docs: DataFrame, model: Model | None, cut: float = 0.7) -> DataFrame:
    """Per document: doc_id, score (0 to 1), predicted (1 if score >= cut), hits, words.

    Null counts as an empty text; a text without words has no hits and the score of that. Texts of any length are scored
    whole. Without a model (no labelled rows of both kinds, or too few for any word to tell them apart) every score is 0.
    Rows that repeat a doc_id, or have none, are scored one by one; an empty table gives an empty result; extra columns are
    ignored, whatever their names.
    """
    if model is None:
        return texts(docs).select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("words"))
    found = texts(docs).select("doc_id", _found(model.gains, model.window, model.threshold)("text").alias("f"))
    score = model.score(F.col("f.hits"), F.col("f.words"))
    return found.select("doc_id", score.alias("score"), (score >= cut).cast("int").alias("predicted"), "f.hits", "f.words")


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for testing: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.7, **options) -> DataFrame:
    """The documents that aren't predicted toxic, with all columns of the input. Held-out labels aren't learnt from.

    Null, empty, repeated and nameless rows as in ``toxicity``; without a model all rows stay."""
    if (model := train(docs, labels.where(~held_out(F.col("doc_id"))), **options)) is None:
        return docs
    # Only texts go to Python; all other columns stay where they are.
    name = free_name(docs, "found")
    found = docs.withColumn(name, _found(model.gains, model.window, model.threshold)(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return found.where(model.score(F.col(f"{name}.hits"), F.col(f"{name}.words")) < cut).drop(name)
