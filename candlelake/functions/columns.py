"""Column expressions shared by the operators. All are built-in functions, so plans stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

#: Below this a denominator counts as zero.
TINY = 1e-6
#: Truncated on purpose: the encoded hours have to equal those of existing feature tables.
PI = 3.1415926535


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den; 0.0 where den is null or about zero."""
    den = col(den)
    return F.when(den.isNull() | (F.abs(den) < TINY), F.lit(0.0)).otherwise(col(num) / den)


def epoch_seconds(c: Column | str) -> Column:
    return col(c).cast("timestamp").cast("long")


def normalize_epoch(c: Column | str) -> Column:
    """Long epoch in micro-, milli- or whole seconds, told apart by magnitude, to a timestamp of whole seconds."""
    c = col(c).cast("long")
    return F.timestamp_seconds(F.when(c > 10**15, F.floor(c / 10**6)).when(c > 10**12, F.floor(c / 10**3)).otherwise(c).cast("long"))


def finite(c: Column | str) -> Column:
    """The value, or null where it is NaN or infinite."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson's r as an aggregate; null where a side is constant."""
    x, y = col(x), col(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y)))


def ordered(by: str = "symbol", time: str = "open_time") -> WindowSpec:
    """For frames of rows. The order is a column rather than an expression: windows in a row then share one sort."""
    return Window.partitionBy(by).orderBy(time)


def trailing(rows: int, interval_s: int, by: str = "symbol", time: str = "open_time") -> WindowSpec:
    """The frame of that many candles up to the current one, by time: a missing candle leaves a frame short."""
    return Window.partitionBy(by).orderBy(epoch_seconds(time)).rangeBetween(-(rows - 1) * interval_s, 0)
