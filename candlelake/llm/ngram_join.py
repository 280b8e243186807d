"""Exact Jaccard self-join of documents on word shingles, with set-relation skipping.

Documents become sets of shingle hashes in one global order: the more common a shingle is in the corpus, the later it comes,
in steps of twice the count; the others come first, by hash. Sets that reach the threshold share a shingle in their prefixes, so prefixes are dealt out by shingle. The list of a
shingle is sorted by size and position; sets that agree in both are a block, and blocks are skipped whole where size and
position leave too little overlap possible.

Relations between sets save most of the work. Equal sets are one set. Each set has a bitmap of the parities of its hashes;
bits that differ between two bitmaps bound the shingles that their sets don't share. Each set is first compared with the
partner that shares most of its prefix, its representative. Sets that turn out to be linked answer for each other: further
pairs are looked at only where their two sides aren't connected yet. For those the representatives are compared first, and
the answer for the sets follows from the representatives' overlap, more or less what each set and its representative have
apart; only pairs that this leaves open are compared themselves. Long lists are compared with leading sets first, and only
what those comparisons leave apart is compared in full: a pair is made in the list of its first common shingle, and in a later
one only if that is out of sight. No link between sets in different components is ever skipped.
Overlaps are counted on the words of both texts, not on hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import grams
from .common import discard, free_name, materialise, partitions, texts, tidied
from .components import components

#: Lists of at most that many sets are compared in full at once; longer ones by way of representatives.
SHORT_LIST = 16
#: Numbers of 64 bits of a sketch.
SKETCH = 8
#: Rounds of comparing long lists with leading sets, and leading sets of a round, before what is left is compared in full.
ROUNDS, LEADS = 2, 8
#: At most that many common shingles are put last in the order. The order is a matter of speed only.
MOST_COMMON = 200_000
#: Shingles are counted in groups of about that many; those that as many sets of a group have count as common.
GROUP, OFTEN = 2_000_000, 3
#: Prefix entries of shingles of that level or a higher one, with 2 ** HOT sets or more, are dealt by document instead of by shingle.
HOT = 10
#: Two sets that share one of that many shingles before a shingle of their prefixes are a pair of that earlier list already.
EARLIER = 8


def _set_keys(bounds: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    total = lambda x: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])[bounds])
    return total(grams.mix(hashes)).view(np.int64), total(grams.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))).view(np.int64)


def parities(bounds: np.ndarray, hashes: np.ndarray) -> list[bytes]:
    """A bitmap for each set, of two to four bits a shingle: bit i is the parity of its hashes that are i modulo the size."""
    n = np.diff(bounds)
    size = (1 << (np.ceil(np.log2(np.maximum(n, 4))).astype(np.int64) + 1))
    first = np.concatenate([[0], np.cumsum(size)])
    place = np.repeat(first[:-1], n) + (hashes & np.repeat(size - 1, n).astype(np.uint64)).astype(np.int64)
    raw = np.packbits((np.bincount(place, minlength=first[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [raw[a // 8 : b // 8] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def least_difference(x: bytes, y: bytes) -> int:
    """Shingles that two sets don't share, at least, by their bitmaps; the larger one is folded to the size of the other."""
    if len(x) > len(y):
        x, y = y, x
    a, b, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(y)
    while size > 8 * len(x):
        size //= 2
        b = (b >> size) ^ (b & ((1 << size) - 1))
    return (a ^ b).bit_count()


def sketches(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """As parities, of one size for all sets: SKETCH numbers of 64 bits, a row for each set."""
    n = len(bounds) - 1
    place = np.repeat(np.arange(n) * 64 * SKETCH, np.diff(bounds)) + (hashes & np.uint64(64 * SKETCH - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=n * 64 * SKETCH) & 1).astype(np.uint8), bitorder="little").view("<i8").reshape(n, SKETCH)


def _sets(batch: pd.DataFrame, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    items, ids = grams.encoded(batch["text"]), batch["doc_id"].to_numpy()
    for part in grams.chunks(items):
        yield (ids[part], *grams.sets(items[part], k, grams.LOWER))


def _survey(docs: DataFrame, k: int) -> DataFrame:
    """Of each document its set (doc_id, n, key1, key2, bits, sketch); of shingles common within a group of sets (key1, n sets of the group)."""

    def common(seen: list[np.ndarray]) -> pd.DataFrame:
        found, count = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, int))
        often = count >= OFTEN
        return pd.DataFrame({"kind": 1, "doc_id": 0, "n": count[often], "key1": found[often].view(np.int64), "key2": 0, "bits": None, "sketch": None})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, keys, size = [], set(), 0
        for batch in batches:
            for ids, bounds, hashes in _sets(batch, k):
                one, two = _set_keys(bounds, hashes)
                n = np.diff(bounds)
                yield pd.DataFrame({"kind": 0, "doc_id": ids, "n": n, "key1": one, "key2": two, "bits": parities(bounds, hashes), "sketch": list(sketches(bounds, hashes))})
                first = np.zeros(len(ids), bool)
                for i, key in enumerate(one.tolist()):  # equal sets count once
                    if key not in keys:
                        keys.add(key)
                        first[i] = True
                seen.append(hashes[np.repeat(first, n)])
                size += len(seen[-1])
                if size >= GROUP:
                    yield common(seen)
                    seen, keys, size = [], set(), 0
        yield common(seen)

    return docs.mapInPandas(tidied(run), "kind int, doc_id long, n long, key1 long, key2 long, bits binary, sketch array<long>")


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of two sets of these sizes that reaches the threshold."""
    return -(-(percent * (a + b)) // (100 + percent))


def _levels(counts: np.ndarray) -> np.ndarray:
    """1 to 15, one more for twice the count."""
    return np.clip(np.floor(np.log2(np.maximum(counts, 1))), 1, 15).astype(np.uint64)


def _tokens(hashes: np.ndarray, last: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Numbers in the order of shingles: the level of common ones (last, ascending), else 0, in four bits; then the hash."""
    if not len(last):
        return hashes >> np.uint64(4)
    at = np.minimum(np.searchsorted(last, hashes), len(last) - 1)
    return (hashes >> np.uint64(4)) | (np.where(last[at] == hashes, level[at], np.uint64(0)) << np.uint64(60))


def _prefixes(docs: DataFrame, common, k: int, percent: int, buckets: int) -> DataFrame:
    """Prefix entries, dealt into buckets: one row for each batch and bucket; entries of common shingles are rows of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, level = common.value
        for batch in batches:
            held, seen = [], set()
            for ids, bounds, hashes in _sets(batch, k):
                one, two = _set_keys(bounds, hashes)
                n = np.diff(bounds)
                new = np.zeros(len(ids), bool)
                for i in np.argsort(ids, kind="stable"):  # of equal sets in a batch the first by id
                    if n[i] and (key := (one[i], two[i])) not in seen:
                        seen.add(key)
                        new[i] = True
                token = _tokens(hashes, last, level)
                owner = np.repeat(np.arange(len(ids)), n)
                order = np.lexsort((token, owner))
                token, owner = token[order], owner[order]
                pos = np.arange(len(token)) - np.repeat(bounds[:-1], n)
                keep = new[owner] & (pos < (n - -(-percent * n // 100) + 1)[owner])
                held.append((token[keep], ids[owner[keep]], n[owner[keep]], pos[keep]))
            token, doc, n, pos = (np.concatenate([h[j] for h in held]) for j in range(4)) if held else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
            hot = token >> np.uint64(60) >= HOT
            yield pd.DataFrame({"bucket": doc[hot] % buckets, "token": token[hot].view(np.int64), "doc_id": doc[hot], "n": n[hot], "pos": pos[hot], "entries": None, "count": 0})
            token, doc, n, pos = token[~hot], doc[~hot], n[~hot], pos[~hot]
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edge)):
                own = order[edge[b] : edge[b + 1]]
                rows.append((b, token[own].tobytes() + doc[own].astype("<i8").tobytes() + n[own].astype("<u4").tobytes() + pos[own].astype("<u4").tobytes(), len(own)))
            out = pd.DataFrame(rows, columns=["bucket", "entries", "count"])
            yield out.assign(token=0, doc_id=0, n=0, pos=0)[["bucket", "token", "doc_id", "n", "pos", "entries", "count"]]

    return docs.mapInPandas(tidied(run), "bucket long, token long, doc_id long, n long, pos long, entries binary, count long")


def _block_pairs(token: np.ndarray, doc: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries (places in the arrays) that can be linked, of entries sorted by token, n and pos."""
    first = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (pos[1:] != pos[:-1])])[: len(token)])
    size = np.diff(np.concatenate([first, [len(token)]]))
    token, n, pos = token[first], n[first], pos[first]
    left, right, i = [], [], np.arange(len(first))
    for step in range(len(first)):
        i = i[i + step < len(first)]
        j = i + step
        # Sizes ascend in a list, so once a block is too large, so are all after it.
        i = i[(token[i] == token[j]) & (100 * n[i] >= percent * n[j])]
        if not len(i):
            break
        j = i + step
        good = np.minimum(n[i] - pos[i], n[j] - pos[j]) >= _needed(n[i], n[j], percent)
        x, y = i[good], j[good]
        count = size[x] * size[y]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        width = np.repeat(size[y], count)
        a, b = np.repeat(first[x], count) + at // width, np.repeat(first[y], count) + at % width
        left.append(a[a < b])
        right.append(b[a < b])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def _lists(prefixes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (kind 0: a < b, shared prefix shingles seen) and the entries of long lists (kind 1). Rows come bucket
    by bucket."""

    def listed(held: list[tuple]) -> Iterator[pd.DataFrame]:
        token, doc, n, pos = (np.concatenate([h[j] for h in held]) for j in range(4))
        order = np.lexsort((doc, pos, n, token))
        token, doc, n, pos = token[order], doc[order], n[order], pos[order]
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        size = np.diff(edge)
        long = np.repeat(size > SHORT_LIST, size)
        yield pd.DataFrame({"kind": 1, "a": doc[long], "b": 0, "shared": 0, "token": token[long].view(np.int64), "n": n[long], "pos": pos[long]})
        short = np.repeat((size > 1) & (size <= SHORT_LIST), size)
        doc = doc[short]
        i, j = _block_pairs(token[short], doc, n[short], pos[short], percent)
        apart = doc[i] != doc[j]
        pairs = pd.DataFrame({"a": np.minimum(doc[i], doc[j])[apart], "b": np.maximum(doc[i], doc[j])[apart]}).value_counts(sort=False).reset_index(name="shared")
        yield pairs.assign(kind=0, token=0, n=0, pos=0)[["kind", "a", "b", "shared", "token", "n", "pos"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        current = None
        for batch in batches:
            common = batch[batch["count"] == 0]
            yield pd.DataFrame({"kind": 1, "a": common["doc_id"], "b": 0, "shared": 0, "token": common["token"], "n": common["n"], "pos": common["pos"]})
            for bucket, raw, c in zip(batch["bucket"], batch["entries"], batch["count"]):
                if not c:
                    continue
                if bucket != current and held:
                    yield from listed(held)
                    held = []
                current = bucket
                held.append((np.frombuffer(raw, "<u8", c), np.frombuffer(raw, "<i8", c, 8 * c), np.frombuffer(raw, "<u4", c, 16 * c).astype(np.int64), np.frombuffer(raw, "<u4", c, 20 * c).astype(np.int64)))
        if held:
            yield from listed(held)

    return prefixes.mapInPandas(tidied(run), "kind int, a long, b long, shared long, token long, n long, pos long")


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps leave the threshold possible."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            most = ((100 - percent) * (batch["na"] + batch["nb"]) // (100 + percent)).tolist()
            good = [least_difference(x, y) <= m for x, y, m in zip(batch["left"], batch["right"], most)]
            yield batch.loc[good, ["a", "b"]]

    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "left", "right").mapInPandas(tidied(run), "a long, b long")


def _counted(pairs: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """a, b, na, nb, common: the sizes and the overlap, counted from the words of the two texts.

    Texts travel instead of sets: compressed, they take less than half the room of their shingles' hashes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = [x for pair in zip(batch["left"], batch["right"]) for x in pair]
            rows = []
            for i in range(0, len(both), 20):
                own = grams.exact_sets(both[i : i + 20], k, grams.LOWER)
                for x, y in zip(own[::2], own[1::2]):
                    a, b = (x, y) if len(x) < len(y) else (y, x)
                    rows.append((len(x), len(y), int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0))
            yield pd.DataFrame(rows, columns=["na", "nb", "common"]).assign(a=batch["a"], b=batch["b"])[["a", "b", "na", "nb", "common"]]

    left = held.select(F.col("doc_id").alias("a"), F.col("text").cast("binary").alias("left"))
    right = held.select(F.col("doc_id").alias("b"), F.col("text").cast("binary").alias("right"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInPandas(tidied(run), "a long, b long, na long, nb long, common long")


def _linked(percent: int) -> Column:
    return (F.col("common") > 0) & (100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))


def _represented(near: DataFrame, done: DataFrame) -> DataFrame:
    """node, rep, own (shingles that the node has and its representative hasn't), more (the other way round)."""
    rows = near.select(F.col("b").alias("node"), F.col("a").alias("rep"), F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(done, ["a", "b"])
    of_b = F.col("node") == F.col("b")
    rows = rows.select("node", "rep", (F.when(of_b, F.col("nb")).otherwise(F.col("na")) - F.col("common")).alias("own"), (F.when(of_b, F.col("na")).otherwise(F.col("nb")) - F.col("common")).alias("more")).distinct()
    # A doc_id with several texts stands for itself.
    return rows.groupBy("node").agg(F.first("rep").alias("rep"), F.first("own").alias("own"), F.first("more").alias("more"), F.count(F.lit(1)).alias("c")).where("c = 1").drop("c")


def _about(sizes: DataFrame, reps: DataFrame) -> DataFrame:
    """node, n (null for doc_ids with texts of several sizes), rep, own and more (null without a representative)."""
    n = F.when(F.min("n") == F.max("n"), F.min("n"))
    return sizes.groupBy(F.col("doc_id").alias("node")).agg(n.alias("n")).join(reps, "node", "left")


def _with_representatives(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """a, b, na, nb, ra, rb (their representatives, in order), own and more (of both together)."""
    one = about.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("rep").alias("r1"), F.col("own").alias("o1"), F.col("more").alias("m1"))
    two = about.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rep").alias("r2"), F.col("own").alias("o2"), F.col("more").alias("m2"))
    rows = pairs.select("a", "b").join(one, "a", "left").join(two, "b", "left")
    r1, r2, zero = F.coalesce("r1", "a"), F.coalesce("r2", "b"), F.lit(0)
    return rows.select("a", "b", "na", "nb", F.least(r1, r2).alias("ra"), F.greatest(r1, r2).alias("rb"), (F.coalesce("o1", zero) + F.coalesce("o2", zero)).alias("own"), (F.coalesce("m1", zero) + F.coalesce("m2", zero)).alias("more"))


def _derived(rows: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """a, b, answer: whether the pair is linked, as far as the overlap of the representatives tells; else null. It stays null
    for doc_ids with texts of several sizes."""
    known = done.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "common")
    rows = rows.join(known, ["ra", "rb"], "left")
    need = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    answer = F.when(F.col("common") + F.col("own") < need, F.lit(False)).when(F.col("common") - F.col("more") >= need, F.lit(True))
    return rows.groupBy("a", "b").agg(F.max(answer).alias("answer"), F.max(answer.isNull()).alias("open")).select("a", "b", F.when(~F.col("open"), F.col("answer")).alias("answer"))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id that is reachable by links, itself included).

    Words are runs of characters outside ``[\\x20\\x09-\\x0D]`` with A-Z in lower case; a set holds the distinct k-word
    shingles, of a text with fewer words its whole sequence. Documents link when 100 times their intersection is at least
    ``percent`` times their union. A text that is null, empty or without words has the empty set, which links with nothing.
    Rows that repeat a doc_id are one node: its links are those of any of its rows. A row without a doc_id can't be linked
    to; its component_id is null. Extra columns are ignored, whatever their names; an empty table gives an empty result;
    texts may have any length.
    """
    spark = docs.sparkSession
    docs = texts(docs)
    # Rows without a doc_id only want their number of shingles.
    lone = _survey(docs.where("doc_id IS NULL").withColumn("doc_id", F.lit(0).cast("long")), k).where("kind = 0")
    lone = lone.select(F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    docs = docs.where("doc_id IS NOT NULL")
    survey = materialise(_survey(docs, k), "kind")
    rows = survey.where("kind = 0").select("doc_id", "n", "key1", "key2")
    # Counts are of the groups that have the shingle often enough, so at least those.
    often = survey.where("kind = 1").groupBy("key1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key1").limit(MOST_COMMON).toPandas()
    last, order = often["key1"].to_numpy(np.int64).view(np.uint64), np.argsort(often["key1"].to_numpy(np.int64).view(np.uint64))
    common = spark.sparkContext.broadcast((last[order], _levels(often["n"].to_numpy())[order]))

    parts = partitions(spark)
    prefixes = _prefixes(docs, common, k, percent, 8 * parts).repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = materialise(_lists(prefixes, percent), "kind")
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    lists = found.where("kind = 1").select("token", F.col("a").alias("doc_id"), "n", "pos")
    # Equal sets are one; the first document stands for them.
    first = rows.where("n > 0").groupBy("key1", "key2").agg(F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1")
    equal = rows.where("n > 0").join(first, ["key1", "key2"]).select(F.col("doc_id").alias("a"), "b").where("a <> b")
    links = materialise(equal.distinct())

    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(lists.select(F.col("doc_id").alias("node"))).distinct()
    held = materialise(docs.join(nodes, F.col("doc_id") == F.col("node"), "left_semi"))
    sizes = survey.where("kind = 0").select("doc_id", "n", "bits")
    done: DataFrame | None = None

    def counted(more: DataFrame) -> DataFrame:
        """The pairs that weren't counted yet and that bitmaps leave possible, with their overlap."""
        nonlocal done
        more = _plausible(more, sizes, percent).distinct()
        more = materialise(more if done is None else more.join(done, ["a", "b"], "left_anti"))
        new = materialise(_counted(more, held, k))
        done = new if done is None else done.unionByName(new)
        discard(more)
        return new

    def unseen(pairs: DataFrame) -> DataFrame:
        """The pairs that weren't counted yet. An anti-join would be moved below the distinct that made them, onto a row for
        each shingle that a pair shares."""
        return pairs.join(done.select("a", "b", F.lit(True).alias("seen")), ["a", "b"], "left").where("seen IS NULL").select("a", "b")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
        """Of pairs, those whose sides aren't connected yet."""
        one = known.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        two = known.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        return pairs.join(one, "a", "left").join(two, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    def grown(known: DataFrame, new: DataFrame) -> DataFrame:
        new = new.select("a", "b")
        return known if new.isEmpty() else components(new, known)

    def star(entries: DataFrame, *seeds: int) -> DataFrame:
        """a (a leading set among the list's sets of about that size, one for each seed) and b, of the entries that can be
        linked with it."""
        entries = entries.withColumn("scale", _scale(percent))
        leads = [F.min_by(F.struct("doc_id", "n", "pos"), F.struct(F.xxhash64("doc_id", F.lit(i)), "doc_id")) for i in seeds]
        lead = entries.groupBy("token", "scale").agg(F.array_distinct(F.array(*leads)).alias("leads"))
        both = entries.join(lead, ["token", "scale"]).withColumn("lead", F.explode("leads")).where((F.col("lead.doc_id") != F.col("doc_id")) & _possible(F.col("lead.n"), F.col("lead.pos"), F.col("n"), F.col("pos"), percent))
        return both.select(F.col("lead.doc_id").alias("a"), F.col("doc_id").alias("b"))

    # First each set with the one partner that shares most of its prefix, a leading set of long lists or another set.
    near = pairs.unionByName(star(lists, 0).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))).groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    near = materialise(near.select("a", "b"))
    known = components(links.unionByName(counted(ordered(near)).where(_linked(percent)).select("a", "b")))
    about = materialise(_about(sizes, _represented(near, done)))

    def settle(more: DataFrame, known: DataFrame) -> DataFrame:
        """The components with the links among the pairs: those of their representatives, those that follow, the rest."""
        more = materialise(_with_representatives(apart(unseen(ordered(more)), known), about))
        if more.isEmpty():
            return known
        between = more.select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        known = grown(known, counted(apart(ordered(between), known)).where(_linked(percent)))
        answers = materialise(_derived(more, done, percent))
        known = grown(known, answers.where("answer"))
        rest = apart(answers.where("answer IS NULL"), known)
        known = grown(known, counted(ordered(rest)).where(_linked(percent)))
        discard(more, answers)
        return known

    known = settle(pairs.select("a", "b"), known)
    # Other leading sets, for the lists that hold several components still: each round links a good part of what is left
    # of a large group, with as many pairs as the lists have entries, times LEADS.
    for i in range(ROUNDS):
        split = materialise(_split_lists(lists, known))
        known = settle(star(split, *range(1 + LEADS * i, 1 + LEADS * (i + 1))), known)
        discard(split)
    split = materialise(_split_lists(lists, known))
    known = settle(_remaining(split, survey.where("kind = 0"), percent), known)
    discard(split, held, found, near, about)
    out = rows.join(known, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return out.unionByName(lone)


def _remaining(split: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of a list's entries that can be linked and aren't in one component. Sketches rule most pairs out within
    the join. Sets that have a shingle in common shortly before are left to the list of that one: it holds both, at places
    where they can be linked if they can here. A doc_id with several texts has no such sets."""
    sketch = [F.get("sketch", F.lit(j)).alias(f"s{j}_") for j in range(SKETCH)]
    sets = sets.select("doc_id", *sketch, F.count(F.lit(1)).over(Window.partitionBy("doc_id")).alias("texts"))
    before = F.collect_list("token").over(Window.partitionBy("doc_id").orderBy("pos").rowsBetween(-EARLIER, -1))
    split = split.withColumn("scale", _scale(percent)).join(sets, "doc_id").withColumn("earlier", F.when(F.col("texts") == 1, before).otherwise(F.array().cast("array<long>"))).drop("texts")
    # Sets that can be linked are at most one scale apart.
    left = split.select(*[F.col(c).alias(f"{c}1") for c in split.columns]).withColumn("scale1", F.explode(F.array(F.col("scale1"), F.col("scale1") + 1)))
    right = split.select(*[F.col(c).alias(f"{c}2") for c in split.columns])
    new = (F.col("n1") <= F.col("n2")) & (F.col("component1") != F.col("component2")) & _possible(F.col("n1"), F.col("pos1"), F.col("n2"), F.col("pos2"), percent) & _alike(percent) & ~F.arrays_overlap("earlier1", "earlier2")
    return left.join(right, (F.col("token1") == F.col("token2")) & (F.col("scale1") == F.col("scale2")) & new).select(F.col("doc_id1").alias("a"), F.col("doc_id2").alias("b"))


def _alike(percent: int) -> Column:
    """Whether the sketches of two sets leave the threshold possible."""
    apart = sum((F.bit_count(F.col(f"s{j}_1").bitwiseXOR(F.col(f"s{j}_2"))) for j in range(1, SKETCH)), F.bit_count(F.col("s0_1").bitwiseXOR(F.col("s0_2"))))
    return (100 + percent) * apart <= (100 - percent) * (F.col("n1") + F.col("n2"))


def _scale(percent: int) -> Column:
    return F.floor(F.log(F.col("n")) / math.log(100 / percent))


def _possible(n1: Column, pos1: Column, n2: Column, pos2: Column, percent: int) -> Column:
    """Whether two sets with a shingle at these places of their order can reach the threshold, if it is their first in common."""
    need = F.ceil(percent * (n1 + n2) / (100 + percent))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (F.least(n1 - pos1, n2 - pos2) >= need)


def _split_lists(lists: DataFrame, known: DataFrame) -> DataFrame:
    """The entries of lists that hold more than one component, with their component."""
    own = lists.join(known, F.col("doc_id") == F.col("node"), "left").select("token", "doc_id", "n", "pos", F.coalesce("component", "doc_id").alias("component"))
    several = own.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    return own.join(several, "token", "left_semi")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """One document of each group of linked ones, the first by doc_id, with all columns; documents without a link stay.

    Of rows that repeat a doc_id all stay or go together; rows without one stay.
    """
    gone = jaccard_components(docs, k, percent).where("component_id <> doc_id").select(F.col("doc_id").alias(free_name(docs, "gone"))).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone[gone.columns[0]], "left_anti")


#: DuckDB SQL of the query's result.
ORACLE = r"""
WITH RECURSIVE
     d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM d),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
     e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
     r AS (SELECT doc_id AS node, doc_id AS reached FROM d UNION SELECT e.b, r.reached FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(reached) AS component_id FROM r GROUP BY node) m ON m.node = d.doc_id
"""
