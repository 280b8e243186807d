"""Time-ordered reads: newest rows first, up to a limit that is capped. Spark answers them by a distributed top-k."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest(df: DataFrame, symbol: str | None, columns: list[str], limit: int, cap: int, start=None, end=None, time: str = "open_time", valid: bool = True) -> DataFrame:
    if symbol is not None:
        df = df.where(F.upper("symbol") == symbol.upper())
    if valid and "is_valid_feature_row" in df.columns:
        df = df.where("is_valid_feature_row")
    for bound, above in ((start, True), (end, False)):
        if bound is not None:
            df = df.where(F.col(time) >= F.lit(bound) if above else F.col(time) <= F.lit(bound))
    ties = [c for c in ("symbol",) if c in df.columns and time != "symbol"]
    return df.orderBy(F.desc(time), *ties).limit(min(limit, cap)).select("symbol", time, *columns)


def _series(columns: list[str], cap: int):
    def read(gold: DataFrame, symbol: str, start: dt.datetime | None = None, end: dt.datetime | None = None, limit: int = 500) -> DataFrame:
        return _newest(gold, symbol, columns, limit, cap, start, end)

    read.__doc__ = f"{', '.join(columns)} of a symbol's valid rows; {cap} at most."
    return read


candles = _series(["open", "high", "low", "close", "volume", "trades", "ma_5", "ma_20"], 1000)
returns_series = _series(["log_return", "log_return_lag1", "log_return_lag2"], 5000)
volatility_series = _series(["volatility", "volatility_5", "volatility_ratio"], 2000)
orderflow_series = _series(["imbalance_ratio", "buy_ratio", "buy_ratio_5", "taker_buy_base"], 1000)
momentum_series = _series(["momentum", "trend_strength", "volume_spike"], 1000)
microstructure_series = _series(["body_size", "price_range_ratio"], 2000)


def forecast(preds: DataFrame, symbol: str, limit: int = 15) -> DataFrame:
    return _newest(preds.where("predicted_close IS NOT NULL"), symbol, ["prediction", "predicted_close"], limit, 60, valid=False)


def sentiment_timeline(df: DataFrame, symbol: str, start: dt.datetime | None = None, end: dt.datetime | None = None, limit: int = 500) -> DataFrame:
    return _newest(df, symbol, ["sentiment_index", "avg_confidence", "message_count"], limit, 2000, start, end, "window_start", False)


def _last(df: DataFrame, time: str, columns: list[str]) -> list[Column]:
    return [F.max_by(F.struct(*columns), time).alias("__row"), F.max(time).alias(time)]


def sentiment_summary(df: DataFrame) -> DataFrame:
    """The newest window of each symbol."""
    columns = ["sentiment_index", "avg_confidence", "message_count"]
    return df.groupBy("symbol").agg(*_last(df, "window_start", columns)).select("symbol", "window_start", "__row.*")


def expected_move(candles: DataFrame, preds: DataFrame) -> DataFrame:
    """Per symbol: newest close and newest predicted close, the change in percent and its direction."""
    close = candles.groupBy("symbol").agg(F.max_by("close", "open_time").alias("last_close"))
    guess = preds.where("predicted_close IS NOT NULL").groupBy("symbol").agg(F.max_by("predicted_close", "open_time").alias("predicted_close"))
    change = F.try_divide(F.col("predicted_close") - F.col("last_close"), F.col("last_close")) * 100
    out = close.join(guess, "symbol").withColumn("change_pct", change)
    return out.withColumn("direction", F.when(F.col("change_pct") > 0, "up").when(F.col("change_pct") < 0, "down").otherwise("flat"))


def drift_top_features(history: DataFrame, n: int = 8, latest: bool = True) -> DataFrame:
    """Features with the highest drift score, of the latest run or of the whole history."""
    rows = history.where("drift_type = 'data'")
    if latest:
        last = rows.agg(F.max("timestamp").alias("__last"))
        rows = rows.join(F.broadcast(last), F.col("timestamp") == F.col("__last"), "left_semi")
    return rows.orderBy(F.desc("drift_score"), "feature_name", "timestamp").limit(n).select("timestamp", "feature_name", "drift_score", "drift_detected")


def retraining_events(history: DataFrame) -> DataFrame:
    """Runs that triggered a training, newest first."""
    return history.where("triggered").groupBy("timestamp").agg(F.max("overall_drift_score").alias("overall_drift_score"), F.max("trigger_reason").alias("trigger_reason")).orderBy(F.desc("timestamp"))


def newest_per(df: DataFrame, n: int, by: str = "symbol", time: str = "open_time") -> DataFrame:
    """The newest n rows of each group."""
    w = Window.partitionBy(by).orderBy(F.desc(time))
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")
