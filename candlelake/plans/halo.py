"""Frames by time for tables with few symbols: windows that run in parallel within a symbol.

Partitioned by symbol alone, a window has as many tasks as there are symbols. Here rows are dealt by symbol and stretch of
time; each stretch also gets the rows before it that its frames reach into, and drops them afterwards. It is exact for
range frames up to the reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions.columns import epoch_seconds
from candlelake.operators.features import gold_features, reach_seconds

#: Rows before the reach that lags need: five, and the one before for the return of the first.
OLDER_ROWS = 6


def with_halo(df: DataFrame, reach_s: int, stretch_s: int, columns: Callable[[WindowSpec], dict], by: str = "symbol", time: str = "open_time") -> DataFrame:
    """Adds ``columns(window)``, whose range frames reach ``reach_s`` seconds back at most."""
    t = epoch_seconds(time)
    own = F.floor(t / stretch_s).cast("long")
    last = F.floor((t + reach_s) / stretch_s).cast("long")
    spread = df.withColumns({"__own": own, "__stretch": F.explode(F.sequence(own, last))})
    window = Window.partitionBy(by, "__stretch").orderBy(epoch_seconds(time))
    return spread.withColumns(columns(window)).where("__own = __stretch").drop("__own", "__stretch")


def gold_features_by_stretch(df: DataFrame, interval_s: int, stretch_s: int | None = None) -> DataFrame:
    """As ``gold_features``, with a task for each symbol and stretch of time instead of one for each symbol.

    A stretch gets the rows of the one before, which holds all that range frames reach back to, and the last rows before
    that for the lags, which count rows whatever the gaps. Those are the ends of earlier stretches: a table of a row for
    each symbol and stretch.
    """
    stretch_s = max(stretch_s or 0, reach_seconds(interval_s))
    rows = df.withColumn("__own", F.floor(epoch_seconds("open_time") / stretch_s).cast("long"))
    last = rows.withColumn("__n", F.row_number().over(Window.partitionBy("symbol", "__own").orderBy(F.desc("open_time")))).where(F.col("__n") <= OLDER_ROWS)
    ends = F.collect_list(F.struct(*df.columns)).over(Window.partitionBy("symbol").orderBy("open_time").rowsBetween(1 - OLDER_ROWS, 0))
    summary = last.select("symbol", "__own", "__n", ends.alias("__ends")).where("__n = 1")
    before = F.last("__ends").over(Window.partitionBy("symbol").orderBy("__own").rangeBetween(Window.unboundedPreceding, -2))
    older = summary.select(F.col("__own").alias("__stretch"), before.alias("__before")).select("__stretch", F.explode("__before").alias("__row")).select("__row.*", "__stretch", F.lit(False).alias("__mine"))
    near = rows.select(*df.columns, "__own", F.explode(F.array(F.col("__own"), F.col("__own") + 1)).alias("__stretch"))
    near = near.select(*df.columns, "__stretch", (F.col("__own") == F.col("__stretch")).alias("__mine"))
    # Features are windows by symbol: a symbol of a stretch is one of its own for them.
    both = near.unionByName(older).withColumns({"name_": F.col("symbol"), "mine_": F.col("__mine"), "symbol": F.concat_ws("\n", "symbol", "__stretch")}).drop("__stretch", "__mine")
    out = gold_features(both, interval_s).where("mine_")
    return out.withColumn("symbol", F.col("name_")).drop("name_", "mine_")
