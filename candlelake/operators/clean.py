"""Projections, filters, cleaning and quality checks."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.functions.columns import finite, normalize_epoch
from candlelake.sources.schemas import SILVER, SILVER_COLUMNS

KEY = ("symbol", "open_time")
CRITICAL = ("symbol", "open_time", "open", "high", "low", "close", "volume")
#: Days of a range label without a number.
MAX_DAYS = 3650
_UNIT_DAYS = {"minute": 1 / 1440, "hour": 1 / 24, "day": 1, "week": 7, "month": 30, "year": 365}


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def to_utc_auto(df: DataFrame, column: str) -> DataFrame:
    """A numeric or text column as timestamps: the largest magnitude tells milliseconds from seconds for all rows."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return df.withColumn(column, F.expr(f"try_to_timestamp(`{column}`)"))
    if not isinstance(kind, T.NumericType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    scale = df.agg(F.when(F.max(F.abs(column)) > 10**12, 1000.0).otherwise(1.0).alias("__scale"))
    value = F.expr(f"timestamp_micros(CAST(`{column}` * 1000000 / __scale AS BIGINT))") if isinstance(kind, (T.DoubleType, T.FloatType)) else F.timestamp_micros((F.col(column).cast("decimal(30,0)") * 1000000 / F.col("__scale").cast("int")).cast("long"))
    return df.crossJoin(F.broadcast(scale)).withColumn(column, value).drop("__scale")


def dedupe_latest(df: DataFrame, keys: list[str] | tuple[str, ...] = KEY, order_by: list[Column | str] | None = None) -> DataFrame:
    """One row per key, the first in the order given; rows that tie are told apart by all their columns."""
    order = list(order_by or []) + [F.col(c) for c in df.columns if c not in keys]
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def bronze_candles(df: DataFrame, source: str = "batch") -> DataFrame:
    """Raw candles with a plausible epoch, times as timestamps, date and source, one row per key. Batch or stream."""
    out = df.where(F.col("open_time") > 10**12).withColumns({"open_time": normalize_epoch("open_time"), "close_time": normalize_epoch("close_time")})
    out = out.withColumns({"date": F.to_date("open_time"), "source": F.lit(source)})
    return out.dropDuplicates(list(KEY)) if df.isStreaming else dedupe_latest(out)


def drop_null_critical(df: DataFrame, cols: list[str] | tuple[str, ...] = CRITICAL) -> DataFrame:
    return df.dropna(subset=list(cols))


def valid_candle_rules(df: DataFrame) -> DataFrame:
    """Rows whose open and close lie within low and high and whose amounts aren't negative; null fails."""
    inside = F.col("open").between(F.col("low"), F.col("high")) & F.col("close").between(F.col("low"), F.col("high"))
    for c in ("volume", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote"):
        inside = inside & (F.col(c) >= 0)
    return df.where(inside)


def silver_candles(df: DataFrame) -> DataFrame:
    """Declared columns, without nulls in critical ones, in declared types, within the rules. Batch or stream."""
    out = drop_null_critical(df.select(*SILVER_COLUMNS))
    return valid_candle_rules(out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER if f.name in SILVER_COLUMNS]))


def quality_report(df: DataFrame) -> DataFrame:
    """One row: rows, null symbols and times, negative volumes, is_valid, errors."""
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("rows"), count(F.col("symbol").isNull()).alias("null_symbol"), count(F.col("open_time").isNull()).alias("null_open_time"), count(F.coalesce(F.col("volume") < 0, F.lit(False))).alias("negative_volume"))
    errors = F.concat_ws("; ", F.when(F.col("rows") == 0, "empty"), F.when(F.col("null_symbol") > 0, "null symbol"), F.when(F.col("null_open_time") > 0, "null open_time"), F.when(F.col("negative_volume") > 0, "negative volume"))
    return r.withColumn("errors", errors).withColumn("is_valid", F.col("errors") == "")


def sanitize_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Infinite, NaN and null to 0 in numeric columns, then without numeric columns that are constant."""
    cols = numeric(df) if cols is None else cols
    df = df.withColumns({c: F.coalesce(finite(F.col(c).cast("double")) if df.schema[c].dataType in (T.DoubleType(), T.FloatType()) else F.col(c), F.lit(0)).cast(df.schema[c].dataType) for c in cols})
    if not cols:
        return df
    spread = df.agg(*[F.stddev_pop(c).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if spread[c] == 0])


def fill_gold(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Infinite to 0 and numeric null to 0; NaN stays as it is, and so do flags, dates, times and the columns to keep."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    rest = [c for c in numeric(df) if c not in floats and c not in keep]
    zero = {c: F.when(F.abs(c) == float("inf"), 0.0).otherwise(F.coalesce(c, F.lit(0.0))) for c in floats}
    return df.withColumns(zero | {c: F.coalesce(c, F.lit(0)).cast(df.schema[c].dataType) for c in rest})


def encode_symbol(df: DataFrame, symbols: list[str], output: str = "symbol_id") -> DataFrame:
    """The place of the symbol in the list; -1 for others and null."""
    place = F.create_map(*[x for i, s in enumerate(symbols) for x in (F.lit(s), F.lit(i))]) if symbols else F.create_map().cast("map<string,int>")
    return df.withColumn(output, F.when(F.col("symbol").isNull(), -1).otherwise(F.coalesce(F.try_element_at(place, F.col("symbol")), F.lit(-1))))


def align_features(df: DataFrame, features: list[str]) -> DataFrame:
    """The features in order; those that are missing are 0, other columns go."""
    return df.select(*[F.col(f) if f in df.columns else F.lit(0.0).alias(f) for f in features])


def valid_feature_rows(df: DataFrame, features: list[str]) -> DataFrame:
    return df.where("is_valid_feature_row").dropna(subset=[f for f in features if f in df.columns])


def trailing_window(df: DataFrame, days: int, time: str = "open_time") -> DataFrame:
    last = df.agg(F.max(time).alias("__last"))
    return df.join(F.broadcast(last), F.col(time) >= F.col("__last") - F.make_interval(days=F.lit(days)), "left_semi")


def range_days(label: str) -> float:
    """Days of "6 hours", "1 year" or "Max"."""
    if m := re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", label.lower()):
        return int(m[1]) * _UNIT_DAYS[m[2]]
    return MAX_DAYS


def relative_range(df: DataFrame, label: str, now: dt.datetime, time: str = "open_time") -> DataFrame:
    """Rows from that long before now up to now."""
    return df.where((F.col(time) >= F.lit(now - dt.timedelta(days=range_days(label)))) & (F.col(time) <= F.lit(now)))


def filter_model_version(df: DataFrame, version: str) -> DataFrame:
    return df if version == "All" else df.where(F.col("model_version") == version)


def model_versions(df: DataFrame) -> DataFrame:
    """Sorted distinct versions; the row "default" when there are none."""
    if "model_version" not in df.columns:
        return df.sparkSession.createDataFrame([("default",)], "model_version string")
    found = df.where("model_version IS NOT NULL").select(F.col("model_version").cast("string").alias("model_version")).distinct()
    none = df.sparkSession.range(1).select(F.lit("default").alias("model_version"))
    some = found.limit(1).select(F.lit(1).alias("__one"))
    return found.unionByName(none.join(F.broadcast(some), F.lit(True), "left_anti")).orderBy("model_version")


def input_checks(df: DataFrame, features: list[str], target: str, task: str = "regression") -> DataFrame:
    """One row: null, NaN and infinite feature values, null targets, and labels outside 0, 1, 2 for a classifier."""
    count = lambda cs: sum((F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0)) for c in cs), F.lit(0)).cast("long")
    d = [F.col(f).cast("double") for f in features]
    wrong = ~F.col(target).isin(0, 1, 2) if task == "classification" else F.lit(False)
    return df.agg(F.count(F.lit(1)).alias("rows"), count([c.isNull() for c in d]).alias("null_features"), count([F.isnan(c) for c in d]).alias("nan_features"),
                  count([F.abs(c) == float("inf") for c in d]).alias("inf_features"), count([F.col(target).isNull()]).alias("null_target"), count([wrong]).alias("bad_labels"))
