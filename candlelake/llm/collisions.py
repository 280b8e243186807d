"""Nearest neighbours by collision counting.

Each vector is projected on single directions; per direction a shard keeps its projections sorted. A query's window on such
an array is centred at its own projection, and widens with the radius (virtual rehashing: nothing is hashed again for it, the
window's ends move outwards). A vector collides where it is in the window; one that collides in as many arrays as a vector
at the radius would nearly always reach is verified by its exact inner product. A query stops in a shard once its k best so
far are within the radius, or the radius is that of the k-th best which another shard has given it.

Inner products become distances: shards hold vectors of similar norms, and one more coordinate fills them up to the largest
norm of the shard, so that the nearest vector is the one with the largest inner product. Directions are orthonormal, which
makes the number of collisions of a vector at a given distance vary less than independent ones would.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Numbers in the vectors of a shard, of the queries that it is searched for in one task and of a block of queries, on
#: average, which bound a task's memory whatever the length of vectors; queries of a step.
SHARD_VALUES, TASK_VALUES, BLOCK_VALUES, STEP = 1 << 18, 1 << 22, 1 << 14, 64
#: Directions at most; one more than there are components if these are fewer.
DIRECTIONS = 128
#: Share of the vectors at exactly the radius that reach the threshold; nearer ones reach it more often.
REACH = 0.94
#: Half of a window's width, as a multiple of the radius times a direction's mean share, and the factor between radii.
WIDTH, WIDEN = 1.5, 1.1


@lru_cache(4)
def directions(dimension: int) -> np.ndarray:
    """Orthonormal directions as columns, the same wherever they are asked for."""
    q, _ = np.linalg.qr(np.random.default_rng(dimension).standard_normal((dimension, dimension)))
    return np.ascontiguousarray(q[:, : min(dimension, DIRECTIONS)])


@lru_cache(4)
def threshold(dimension: int) -> int:
    """Collisions that a vector at the radius has with probability REACH, by simulation on the unit sphere."""
    x = np.random.default_rng(7).standard_normal((20_000, dimension))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = (np.abs(x[:, : min(dimension, DIRECTIONS)]) <= WIDTH / np.sqrt(dimension)).sum(1)
    return int(np.quantile(hits, 1 - REACH))


class Shard:
    """The sorted projections of vectors, filled up to their largest norm."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        squares = (vectors**2).sum(1)
        self.top, self.axes, self.least = np.sqrt(squares.max()), directions(vectors.shape[1] + 1), threshold(vectors.shape[1] + 1)
        filled = np.concatenate([vectors / self.top, np.sqrt(np.maximum(0, 1 - squares / self.top**2))[:, None]], 1)
        projected = (filled @ self.axes).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, 1)
        self.rank = np.empty(self.order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.rank, self.order, np.arange(len(ids), dtype=self.rank.dtype)[None, :], 1)

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """places, scores of the k best of each query, without its own id; fewer if no others reach its bound (NaN: none)."""
        # On the unit sphere |q - x|^2 = 2 - 2 q.x, and a score is q.x times both norms.
        norms = np.linalg.norm(queries, axis=1)
        centres = np.concatenate([queries / norms[:, None], np.zeros((len(queries), 1))], 1) @ self.axes
        radius = lambda score, i: np.sqrt(np.maximum(0.0, 2 - 2 * np.maximum(score / (norms[i] * self.top), -1)))
        all_of = np.arange(len(queries))
        limit = np.where(np.isnan(bounds), np.inf, radius(np.nan_to_num(bounds), all_of) * (1 + 1e-9))
        spread = np.arange(0, len(self.ids), max(1, len(self.ids) // 256))
        near = np.where(self.ids[spread][:, None] == own, -np.inf, self.vectors[spread] @ queries.T).max(0)
        r = np.minimum(np.maximum(radius(near, all_of) / WIDEN, 1e-3), limit)

        at_centre = np.stack([s.searchsorted(c) for s, c in zip(self.sorted, centres.T, strict=True)])
        low, high = at_centre, at_centre
        counts, seen = np.zeros((len(queries), len(self.ids)), np.uint8), np.zeros((len(queries), len(self.ids)), bool)
        found = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        floors, active = np.where(np.isnan(bounds), -np.inf, bounds), all_of
        while len(active):
            reach = r[active] * WIDTH / np.sqrt(self.vectors.shape[1] + 1)
            left = np.stack([s.searchsorted(c - reach, "left") for s, c in zip(self.sorted, centres[active].T, strict=True)])
            right = np.stack([s.searchsorted(c + reach, "right") for s, c in zip(self.sorted, centres[active].T, strict=True)])
            for j, i in enumerate(active):
                self._collide(counts[i], low[:, j], high[:, j], left[:, j], right[:, j])
                new = np.flatnonzero((counts[i] >= self.least) & ~seen[i])
                seen[i, new] = True
                new = new[self.ids[new] != own[i]]
                # A product that is fast but may be off in its last bits leaves out what can't be among the best.
                floor = max(found[i][1][-1] if len(found[i][1]) == k else -np.inf, floors[i])
                new = new[self.vectors[new] @ queries[i] >= floor - 1e-9 * norms[i] * self.top]
                places, scores = np.concatenate([found[i][0], new]), np.concatenate([found[i][1], (self.vectors[new] * queries[i]).sum(1)])
                best = np.lexsort((self.ids[places], -scores))[:k]
                found[i] = places[best], scores[best]
            last = np.array([found[i][1][-1] if len(found[i][1]) == k else -np.inf for i in active])
            done = (r[active] >= limit[active]) | (last > -np.inf) & (radius(last, active) <= r[active]) | seen[active].all(1)
            r[active] = np.minimum(r[active] * WIDEN, limit[active])
            active, low, high = active[~done], left[:, ~done], right[:, ~done]
        return [(p, s) if np.isnan(b) else (p[s >= b], s[s >= b]) for (p, s), b in zip(found, bounds, strict=True)]

    def _collide(self, counts, low, high, left, right) -> None:
        """Count the vectors that come in as windows from low to high widen to left and right."""
        if (low - left + right - high).sum() < self.rank.size / 8:
            rim = [o[a:b] for o, a, b in zip(self.order, left, low, strict=True)] + [o[a:b] for o, a, b in zip(self.order, high, right, strict=True)]
            counts += np.bincount(np.concatenate(rim), minlength=len(counts)).astype(np.uint8)
        else:  # so much of the arrays is cheaper to count by the places that the vectors have on them
            inside = self.rank - left.astype(self.rank.dtype)[:, None] < (right - left).astype(self.rank.dtype)[:, None]
            np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8, out=counts)


def _search(k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(vectors) and len(queries):
            shard = Shard(vectors["vec_id"].to_numpy(), np.stack(vectors["embedding"].to_numpy()))
            asked = [q for block in queries["block"] for q in block]
            for at in range(0, len(asked), STEP):
                part = asked[at : at + STEP]
                own = np.array([q["query_id"] for q in part])
                bounds = np.array([np.nan if q["bound"] is None else q["bound"] for q in part])
                found = shard.search(np.stack([np.asarray(q["query"], np.float64) for q in part]), own, bounds, k)
                out += [pd.DataFrame({"query_id": i, "vec_id": shard.ids[p], "score": s}) for i, (p, s) in zip(own, found, strict=True)]
        return pd.concat(out)

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array of doubles), norm: rows with an id whose vector is neither null, empty nor zero and has
    finite components only; of rows that share an id, the one with the smallest vector."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
    own = own.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return own.withColumn("norm", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))).where("norm > 0")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that is_query (a condition on vec_id) holds for, the k other rows found with
    the largest inner products, nearest first (ties: smaller vec_id). All rows are indexed. About REACH of the true ones in
    the k-th place are found, and more of the nearer ones. Scores are exact, in double precision.

    Rows without an id, and vectors that are null, empty or zero or that hold null or non-finite components, take no part;
    rows that share an id count once (the smallest vector). A query meets vectors of its own length only. With k other rows or
    fewer, all are given; other columns are ignored; an empty table has no rows.
    """
    # A shard has vectors of one length and, within a factor of two, one norm; there are as many as their rows need.
    own = materialise(usable(vectors).withColumn("size", F.size("embedding")).withColumn("octave", F.floor(F.log2("norm") + 0.5)))
    kinds = own.groupBy("size", "octave").agg(F.ceil(F.count(F.lit(1)) * F.col("size") / SHARD_VALUES).alias("shards"))
    own = own.join(F.broadcast(kinds), ["size", "octave"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("shards"))).select("vec_id", "embedding", "size", "octave", "part")
    asked = materialise(own.where(is_query).select("size", "octave", "part", F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")))
    schema, by_shard, search = "query_id long, vec_id long, score double", ["size", "octave", "part"], _search(k)

    # First each query in its own shard, which bounds what the others have to give.
    home = asked.groupBy(*by_shard).agg(F.collect_list(F.struct("query_id", "query", F.lit(None).cast("double").alias("bound"))).alias("block"))
    first = materialise(own.groupBy(*by_shard).cogroup(home.groupBy(*by_shard)).applyInPandas(search, schema))
    bounds = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))

    # Then all queries of a length, in blocks, in all shards of it but their own; vectors go to each task's queries.
    counted = asked.groupBy("size").agg(F.ceil(F.count(F.lit(1)) * F.col("size") / BLOCK_VALUES).alias("blocks"))
    dealt = asked.join(bounds, "query_id", "left").join(F.broadcast(counted), "size").withColumn("number", F.pmod(F.xxhash64(F.lit(1), "query_id"), F.col("blocks")))
    blocks = dealt.groupBy("size", "octave", "part", "number").agg(F.collect_list(F.struct("query_id", "query", "bound")).alias("block"))
    task = F.floor(F.col("number") * BLOCK_VALUES / TASK_VALUES)
    shards = kinds.select("size", F.col("octave").alias("to_octave"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("to_part"))
    sent = blocks.join(shards, "size").where("octave <> to_octave OR part <> to_part").select("size", F.col("to_octave").alias("octave"), F.col("to_part").alias("part"), task.alias("task"), "block")
    tasks = dealt.select("size", task.alias("task")).distinct()
    by_task = [*by_shard, "task"]
    others = own.join(F.broadcast(tasks), "size").groupBy(*by_task).cogroup(sent.groupBy(*by_task)).applyInPandas(search, schema)

    ranked = first.unionByName(others).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
