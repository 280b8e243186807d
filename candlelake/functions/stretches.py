"""Windows by symbol that run in parallel within a symbol.

A window that is partitioned by symbol has as many tasks as there are symbols. Here rows are dealt by symbol and stretch of
time. What a stretch needs from others comes from a summary, a row for each symbol and stretch: totals of earlier stretches
for running sums, products, maxima and row numbers (a blocked prefix scan), and for frames of rows the rows on either side of
a block of row numbers.

Null symbols are a symbol, and null times come first, as in the windows that these take the place of.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions.columns import col, epoch_seconds

#: Seconds of a stretch, and rows of a block of row numbers.
STRETCH = 64 * 86400
BLOCK = 16_384


def _dealt(df: DataFrame, time: str, stretch_s: int) -> DataFrame:
    return df.withColumn("__stretch", F.coalesce(F.floor(epoch_seconds(time) / stretch_s).cast("long"), F.lit(-(1 << 62))))


def _inside(by: str, time: str) -> WindowSpec:
    return Window.partitionBy(by, "__stretch").orderBy(time)


def _earlier(by: str) -> WindowSpec:
    """Over the summary: the stretches of the symbol before this one."""
    return Window.partitionBy(by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)


def _with_summary(rows: DataFrame, summary: DataFrame, by: str) -> DataFrame:
    """Joins a row for each symbol and stretch; Spark broadcasts it where it is small."""
    summary = summary.withColumnsRenamed({by: "__by", "__stretch": "__at"})
    return rows.join(summary, rows[by].eqNullSafe(summary["__by"]) & (rows["__stretch"] == summary["__at"]), "left").drop("__by", "__at")


def _or_other(both: Column, a: Column, b: Column) -> Column:
    return F.coalesce(both, a, b)


#: The aggregate of a scan, and how the results of two parts are put together.
_SCANS = {"sum": (F.sum, lambda a, b: _or_other(a + b, a, b)), "product": (F.product, lambda a, b: _or_other(a * b, a, b)), "max": (F.max, F.greatest)}


def with_running(df: DataFrame, columns: dict[str, tuple[str, Column | str]], maxima: dict[str, str] | None = None, by: str = "symbol", time: str = "open_time", stretch_s: int = STRETCH) -> DataFrame:
    """Adds running values by symbol: name -> ("sum", "product" or "max", value). ``maxima`` adds running maxima of running
    sums and products: name -> name of one of those.

    Nulls are left out, as by aggregates. Sums may differ from those of a plain window in the last bits.
    """
    maxima = maxima or {}
    run = _inside(by, time).rowsBetween(Window.unboundedPreceding, 0)
    local = _dealt(df, time, stretch_s).withColumns({f"__{n}": _SCANS[kind][0](col(value)).over(run) for n, (kind, value) in columns.items()})
    # A running maximum within a stretch, once all of it is multiplied by what came before, is that of the smallest value
    # where the factor is negative.
    local = local.withColumns({f"__{end}_{n}": f(f"__{of}").over(run) for n, of in maxima.items() for end, f in (("high", F.max), ("low", F.min))})

    def end(kind: str, n: str) -> Column:
        return F.max(f"__{n}") if kind == "max" else F.max_by(F.struct(f"__{n}"), F.col("__place"))[f"__{n}"]

    last = local.withColumn("__place", F.row_number().over(_inside(by, time)))
    totals = last.groupBy(by, "__stretch").agg(*[end(kind, n).alias(f"__total_{n}") for n, (kind, _) in columns.items()], *[F.max(f"__high_{n}").alias(f"__top_{n}") for n in maxima], *[F.min(f"__low_{n}").alias(f"__bottom_{n}") for n in maxima])
    totals = totals.withColumns({f"__before_{n}": _SCANS[kind][0](f"__total_{n}").over(_earlier(by)) for n, (kind, _) in columns.items()})

    def joined(of: str, a: str, b: str) -> Column:
        return _SCANS[columns[of][0]][1](F.col(a), F.col(b))

    both = lambda n, of, high, low: F.greatest(joined(of, f"__before_{of}", high), joined(of, f"__before_{of}", low))
    totals = totals.withColumns({f"__max_{n}": both(n, of, f"__top_{n}", f"__bottom_{n}") for n, of in maxima.items()})
    totals = totals.withColumns({f"__max_before_{n}": F.max(f"__max_{n}").over(_earlier(by)) for n in maxima})
    summary = totals.select(by, "__stretch", *[f"__before_{n}" for n in columns], *[f"__max_before_{n}" for n in maxima])

    out = _with_summary(local, summary, by).withColumns({n: joined(n, f"__before_{n}", f"__{n}") for n in columns})
    out = out.withColumns({n: F.greatest(F.col(f"__max_before_{n}"), both(n, of, f"__high_{n}", f"__low_{n}")) for n, of in maxima.items()})
    return out.select(*[c for c in df.columns if c not in columns and c not in maxima], *columns, *maxima)


def with_row_numbers(df: DataFrame, output: str, by: str = "symbol", time: str = "open_time", stretch_s: int = STRETCH) -> DataFrame:
    """Adds the number of each row by time within its symbol, from 1."""
    rows = _dealt(df, time, stretch_s)
    counts = rows.groupBy(by, "__stretch").agg(F.count(F.lit(1)).alias("__c"))
    before = counts.select(by, "__stretch", F.coalesce(F.sum("__c").over(_earlier(by)), F.lit(0)).alias("__before"))
    rows = rows.withColumn("__place", F.row_number().over(_inside(by, time)))
    return _with_summary(rows, before, by).withColumn(output, F.col("__place") + F.col("__before")).select(*[c for c in df.columns if c != output], output)


def with_row_frames(df: DataFrame, columns: Callable[[WindowSpec], dict[str, Column]], before: int = 0, after: int = 0, by: str = "symbol", time: str = "open_time", stretch_s: int = STRETCH, block: int = BLOCK) -> DataFrame:
    """Adds ``columns(window)``: lags, leads and frames of rows that reach ``before`` rows back and ``after`` rows ahead at
    most. Blocks of row numbers get that many rows from their neighbours and drop them afterwards."""
    block = max(block, before + after)
    place = lambda k: F.floor((F.col("__row") - 1 + k) / block).cast("long")
    rows = with_row_numbers(df, "__row", by, time, stretch_s).withColumn("__home", place(0))
    spread = rows.withColumn("__block", F.explode(F.sequence(F.greatest(place(-after), F.lit(0)), place(before))))
    window = Window.partitionBy(by, "__block").orderBy("__row")
    return spread.withColumns(columns(window)).where("__home = __block").drop("__home", "__block", "__row")


def with_last_before(df: DataFrame, value: Column | str, output: str, by: str = "symbol", time: str = "open_time", stretch_s: int = STRETCH) -> DataFrame:
    """Adds the value of the row before, by time within the symbol; null for the first row."""
    rows = _dealt(df, time, stretch_s).withColumn("__v", col(value))
    ends = rows.groupBy(by, "__stretch").agg(F.max_by(F.struct("__v"), F.struct(time, "__v")).alias("__end"))
    before = ends.select(by, "__stretch", F.last("__end").over(_earlier(by)).alias("__before"))
    w = _inside(by, time)
    own = rows.withColumns({"__lag": F.lag("__v").over(w), "__place": F.row_number().over(w)})
    return _with_summary(own, before, by).withColumn(output, F.when(F.col("__place") > 1, F.col("__lag")).otherwise(F.col("__before")["__v"])).select(*[c for c in df.columns if c != output], output)


def with_ewm(df: DataFrame, c: str, span: int, output: str, by: str = "symbol", time: str = "open_time", stretch_s: int = STRETCH) -> DataFrame:
    """Adds the exponentially weighted mean of the values that aren't null, up to each row: weights (1 - alpha)^i of the
    i-th last.

    Values go in runs, so long that a weight from the run before last is below a double's precision. A row's sum is the
    running sum of its run and the total of the one before, each scaled by its distance: no row holds an array.
    """
    keep, x = 1 - 2 / (span + 1), F.col(c)
    rows = with_running(df, {"__n": ("sum", x.isNotNull().cast("long"))}, by=by, time=time, stretch_s=stretch_s)
    if keep <= 0:  # the last value is all
        return rows.withColumn(output, F.when(F.col("__n") > 0, F.max(x).over(Window.partitionBy(by, "__n"))).cast("double")).drop("__n")
    length = math.ceil(math.log(1e-17) / math.log(keep))
    place = F.greatest(F.col("__n") - 1, F.lit(0))
    rows = rows.withColumns({"__b": F.floor(place / length), "__p": place % length})
    kept = lambda e: F.pow(F.lit(keep), e)
    scaled = lambda value, e: F.sum(F.when(x.isNotNull(), value * kept(e)))

    rest = length - 1 - F.col("__p")
    ends = rows.groupBy(F.col(by).alias("__by"), (F.col("__b") + 1).alias("__at")).agg(scaled(x, rest).alias("__sum"), scaled(F.lit(1.0), rest).alias("__weight"))
    inside = Window.partitionBy(by, "__b").orderBy("__n").rangeBetween(Window.unboundedPreceding, 0)

    def total(value: Column, end: str) -> Column:
        own, earlier = scaled(value, -F.col("__p")).over(inside) * kept(F.col("__p")), F.col(end) * kept(F.col("__p") + 1)
        return F.coalesce(own, F.lit(0.0)) + F.coalesce(earlier, F.lit(0.0))

    rows = rows.join(ends, rows[by].eqNullSafe(ends["__by"]) & (rows["__b"] == ends["__at"]), "left")
    mean = F.try_divide(total(x, "__sum"), total(F.lit(1.0), "__weight"))
    return rows.withColumn(output, F.when(F.col("__n") > 0, mean)).drop("__n", "__b", "__p", "__by", "__at", "__sum", "__weight")
