"""Joins of candles with predictions, sentiment and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.functions.stretches import STRETCH, with_last_before, with_row_frames

KEY = ["symbol", "open_time"]


def restrict_to_symbols(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.join(other.select("symbol"), "symbol", "left_semi")


def restrict_to_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.select(*KEY), KEY, "left_semi")


def _outcomes(gold: DataFrame, stretch_s: int) -> DataFrame:
    """Of each candle its close and that of the candle after it, with the return between the two."""
    rows = with_row_frames(gold.select(*KEY, "close"), lambda w: {"actual_close": F.lead("close").over(w)}, after=1, stretch_s=stretch_s)
    return rows.withColumn("actual_log_return_lead1", F.when((F.col("close") > 0) & (F.col("actual_close") > 0), F.ln(F.col("actual_close") / F.col("close"))))


def _judged(df: DataFrame) -> DataFrame:
    guess, real = F.coalesce("prediction", F.lit(0.0)), F.col("actual_log_return_lead1")
    df = df.withColumns({"predicted_close": F.col("close") * F.exp(guess), "residual": real - F.col("prediction")})
    return df.withColumns({"abs_error": F.abs("residual"), "direction_correct": F.when(F.signum(real) != 0, F.signum("prediction") == F.signum(real))})


def align_predictions(preds: DataFrame, gold: DataFrame, version: str = "All", stretch_s: int = STRETCH) -> DataFrame:
    """Predictions with what came of them: the next candle of their symbol. Unmatched ones keep nulls."""
    from candlelake.operators.clean import filter_model_version

    return _judged(filter_model_version(preds, version).join(_outcomes(gold, stretch_s), KEY, "left"))


def align_gold(gold: DataFrame, prediction: str = "log_return_lag1", stretch_s: int = STRETCH) -> DataFrame:
    """As align_predictions, for tables without predictions: a column of gold stands in for them."""
    return _judged(gold.select(*KEY, F.col(prediction).alias("prediction")).join(_outcomes(gold, stretch_s), KEY, "left"))


def predicted_close(preds: DataFrame, candles: DataFrame) -> DataFrame:
    """Adds close * exp(prediction) of the same candle; null where that is missing or 0."""
    closes = candles.select(*KEY, F.col("close").alias("__close"))
    return preds.join(closes, KEY, "left").withColumn("predicted_close", F.when(F.col("__close") != 0, F.col("__close") * F.exp("prediction"))).drop("__close")


def fill_actuals(preds: DataFrame, candles: DataFrame, stretch_s: int = STRETCH) -> DataFrame:
    """Fills actual_close, error and direction_correct of predictions that lack them, from their own candle and the one
    before; the first candle of a symbol has none before and fills nothing."""
    known = with_last_before(candles.select(*KEY, F.col("close").alias("__close")), "__close", "__before", stretch_s=stretch_s)
    open_ = F.col("actual_close").isNull() & F.col("__before").isNotNull()
    df = preds if "actual_close" in preds.columns else preds.withColumns({"actual_close": F.lit(None).cast("double"), "error": F.lit(None).cast("double"), "direction_correct": F.lit(None).cast("boolean")})
    right = (F.col("predicted_close") > F.col("__before")) == (F.col("__close") > F.col("__before"))
    return df.join(known, KEY, "left").withColumns({
        "error": F.when(open_, F.col("__close") - F.col("predicted_close")).otherwise(F.col("error")),
        "direction_correct": F.when(open_, right).otherwise(F.col("direction_correct")),
        "actual_close": F.when(open_, F.col("__close")).otherwise(F.col("actual_close")),
    }).drop("__close", "__before")


def sentiment_returns(sentiment: DataFrame, gold: DataFrame) -> DataFrame:
    """symbol, open_time, sentiment_index, log_return of windows and valid candles that start together."""
    s = sentiment.where("sentiment_index IS NOT NULL").select("symbol", F.col("window_start").alias("open_time"), "sentiment_index")
    return s.join(gold.where("is_valid_feature_row AND log_return IS NOT NULL").select(*KEY, "log_return"), KEY)


def sentiment_price_overlay(sentiment: DataFrame, candles: DataFrame) -> DataFrame:
    """symbol, open_time, sentiment_index, price of windows that have a candle."""
    s = sentiment.select("symbol", F.col("window_start").alias("open_time"), "sentiment_index")
    return s.join(candles.where("close IS NOT NULL").select(*KEY, F.col("close").alias("price")), KEY)


def rolling_stats_table(candles: DataFrame, returns: DataFrame, n: int = 20) -> DataFrame:
    """The newest n candles of all symbols, with their return where there is one."""
    newest = candles.orderBy(F.desc("open_time"), "symbol").limit(n)
    return newest.join(returns.select(*KEY, F.col("log_return").alias("return")), KEY, "left")


def regime_join(preds: DataFrame, gold: DataFrame, column: str) -> DataFrame:
    return preds.join(gold.select(*KEY, F.col(column).alias("regime")), KEY)
