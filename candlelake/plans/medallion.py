"""Compositions: layers from raw to gold, incremental features, incremental scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.functions.stretches import STRETCH
from candlelake.operators.clean import KEY, bronze_candles, silver_candles, valid_feature_rows
from candlelake.operators.features import gold_features, reach_seconds
from candlelake.operators.joins import restrict_to_keys, restrict_to_symbols
from candlelake.operators.ml import score_batches
from candlelake.plans.halo import OLDER_ROWS, gold_features_by_stretch
from candlelake.sources.io import advance_state, last_processed_by_symbol, read_incremental_by_key, upsert

#: Seconds that a row may be late by.
LATE = 86400


def batch_medallion(raw: DataFrame, interval_s: int, source: str = "batch", stretch_s: int = STRETCH) -> DataFrame:
    """Raw candles to gold in one plan, in as many tasks as there are symbols and stretches of time."""
    return gold_features_by_stretch(silver_candles(bronze_candles(raw, source)), interval_s, stretch_s)


def _history(batch: DataFrame, history: DataFrame, first: DataFrame, reach: Column) -> DataFrame:
    """The rows of the batch's symbols that its features may need, from the days that hold them.

    A one-row minimum over the batch bounds the date, so that a table partitioned by date is read from there on. Symbols
    with too few rows between that bound and their reach are looked for further back, eight times as far each time.
    """
    own = batch.columns
    if "date" not in history.columns:
        return restrict_to_symbols(history.select(*own), batch)
    low = first.agg(F.to_date(F.min("__first") - reach).alias("low")).first()["low"]
    if low is None:
        return history.select(*own).limit(0)
    days, rows, wanted = 1, [], first
    upper: dt.date | None = None
    while True:
        bound = low - dt.timedelta(days=days)
        part = history.where(F.col("date") >= F.lit(bound))
        part = part if upper is None else part.where(F.col("date") < F.lit(upper))
        part = restrict_to_symbols(part.select(*own), wanted)
        rows.append(part)
        found = rows[0]
        for more in rows[1:]:
            found = found.unionByName(more)
        older = found.join(first, "symbol").where(F.col("open_time") < F.col("__first") - reach).groupBy("symbol").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= OLDER_ROWS)
        wanted = first.join(older, "symbol", "left_anti")
        earlier = restrict_to_symbols(history.where(F.col("date") < F.lit(bound)).select("symbol"), wanted)
        if wanted.isEmpty() or earlier.isEmpty():
            return found
        upper, days = bound, 8 * days


def tail_of(rows: DataFrame, interval_s: int, late_s: int = LATE) -> DataFrame:
    """The tail of a table of candles: what features of later rows need of it. Per symbol it has the rows within their reach
    and ``late_s`` seconds of its newest row, and the few rows before those that lags count. Its size follows from the number
    of symbols, not from the length of the history."""
    newest = rows.groupBy("symbol").agg(F.max("open_time").alias("__newest"))
    reach = F.make_interval(secs=F.lit(reach_seconds(interval_s) + late_s))
    bound = rows.join(newest, "symbol").withColumn("__near", F.col("open_time") >= F.col("__newest") - reach)
    # The rank of the older rows is cut off at OLDER_ROWS before they are shuffled.
    order = Window.partitionBy("symbol").orderBy(F.desc("open_time"))
    older = bound.where("NOT __near").withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= OLDER_ROWS)
    return bound.where("__near").select(*rows.columns).unionByName(older.select(*rows.columns))


def advance_tail(tail: DataFrame, batch: DataFrame, interval_s: int, late_s: int = LATE) -> DataFrame:
    """The tail once a batch has come."""
    return tail_of(upsert(tail, batch), interval_s, late_s)


def too_late(batch: DataFrame, tail: DataFrame, late_s: int = LATE) -> DataFrame:
    """Rows of the batch that come so late that the tail may not hold all that their features need."""
    newest = tail.groupBy("symbol").agg(F.max("open_time").alias("__newest"))
    return batch.join(newest, "symbol").where(F.col("open_time") < F.col("__newest") - F.make_interval(secs=F.lit(late_s))).select(*batch.columns)


def gold_incremental(batch: DataFrame, tail: DataFrame, interval_s: int, reemit: bool = False) -> DataFrame:
    """Features of the batch's rows, equal to those of a full run over all rows so far: one plan over the batch and the tail
    of what came before (see ``tail_of``), whatever the length of the history. The whole history serves as well.

    Symbols that the tail doesn't have begin with the batch. A row may be late by as much as the tail allows for (see
    ``too_late``); with ``reemit``, rows after a late one that its arrival changes are given as well.
    """
    # Of a key in both, the batch's row is the newer one.
    gold = gold_features(upsert(restrict_to_symbols(tail.select(*batch.columns), batch), batch), interval_s)
    return _of_batch(gold, batch, batch.groupBy("symbol").agg(F.min("open_time").alias("__first")), reemit)


def _of_batch(gold: DataFrame, batch: DataFrame, first: DataFrame, reemit: bool) -> DataFrame:
    if not reemit:
        return restrict_to_keys(gold, batch)
    return gold.join(first, "symbol").where(F.col("open_time") >= F.col("__first")).select(*gold.columns)


def gold_with_history(batch: DataFrame, history: DataFrame, interval_s: int, reemit: bool = False) -> DataFrame:
    """As ``gold_incremental`` for rows that are too late for a tail: what they need is looked for in the history.

    Per symbol the history is read as far back as features reach from the batch's first row, and the newest few rows
    before that for the lags, which count rows whatever the gaps. A history with a date column is read from the first
    day that is needed on, whatever its length. The batch is evaluated several times; persist it where that is costly.
    """
    own = batch.columns
    first = batch.groupBy("symbol").agg(F.min("open_time").alias("__first"))
    reach = F.make_interval(secs=F.lit(reach_seconds(interval_s)))
    past = _history(batch, history, first, reach).join(first, "symbol")
    low = F.col("__first") - reach
    near = past.where(F.col("open_time") >= low).select(*own)
    older = past.where(F.col("open_time") < low).withColumn("__n", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("open_time")))).where(F.col("__n") <= OLDER_ROWS).select(*own)
    return _of_batch(gold_features(upsert(near.unionByName(older), batch), interval_s), batch, first, reemit)


def incremental_score(gold: DataFrame, state: DataFrame, symbols: list[str], fallback: dt.datetime, features: list[str], scorer: Callable, schema: str, predictions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Scores the valid rows after each symbol's mark; gives the predictions (merged into those there are) and new marks."""
    marks = last_processed_by_symbol(state, symbols, fallback)
    rows = valid_feature_rows(read_incremental_by_key(gold, marks), features)
    scored = score_batches(rows.select(*KEY, *features), scorer, schema)
    return (scored if predictions is None else upsert(predictions, scored)), advance_state(marks, rows)
