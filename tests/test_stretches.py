"""Windows by stretch against plain windows by symbol: gaps, nulls, ties, null symbols and times, products that change sign."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlelake.functions import stretches
from candlelake.operators import aggs, evaluate, features, joins, labels

T0 = dt.datetime(2024, 1, 1)
DAY = 86400


@pytest.fixture(scope="module")
def series(spark):
    """Two symbols and none, with gaps of weeks, nulls and values around -1; times of a symbol differ."""
    rng = np.random.default_rng(4)
    rows = []
    for s in ("a", "b", None):
        hours = np.sort(rng.choice(np.concatenate([np.arange(200), np.arange(900, 1000), [3000]]), 180, replace=False))
        rows += [(s, T0 + dt.timedelta(hours=int(h)), None if rng.random() < 0.1 else float(rng.normal()), float(rng.normal(1, 0.8)), i % 3) for i, h in enumerate(hours)]
    rows.append(("a", None, 5.0, -1.0, 1))
    return spark.createDataFrame(rows, "symbol string, open_time timestamp, x double, y double, extra int").repartition(3).cache()


def same(ours, plain):
    key = lambda d: d.toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    a, b = key(ours), key(plain)
    pd.testing.assert_frame_equal(a, b[a.columns], check_dtype=False, rtol=1e-9, atol=1e-12)
    assert set(ours.columns) == set(plain.columns)


def row():
    return Window.partitionBy("symbol").orderBy("open_time")


def run():
    return row().rowsBetween(Window.unboundedPreceding, 0)


@pytest.mark.parametrize("stretch_s", [3600, DAY, 7 * DAY, 1000 * DAY])
def test_running_values(series, stretch_s):
    ours = stretches.with_running(series, {"s": ("sum", "x"), "p": ("product", F.col("y") - 1), "m": ("max", "x")}, {"s_top": "s", "p_top": "p"}, stretch_s=stretch_s)
    plain = series.withColumns({"s": F.sum("x").over(run()), "p": F.product(F.col("y") - 1).over(run()), "m": F.max("x").over(run())})
    same(ours, plain.withColumns({"s_top": F.max("s").over(run()), "p_top": F.max("p").over(run())}))


@pytest.mark.parametrize("stretch_s", [3600, DAY, 1000 * DAY])
@pytest.mark.parametrize("block", [3, 50, 10_000])
def test_frames_of_rows(series, stretch_s, block):
    columns = lambda w: {"l": F.lag("x", 2).over(w), "d": F.lead("y", 3).over(w), "f": F.sum("y").over(w.rowsBetween(-4, 1))}
    same(stretches.with_row_frames(series, columns, before=4, after=3, stretch_s=stretch_s, block=block), series.withColumns(columns(row())))


def test_row_numbers_and_the_row_before(series):
    same(stretches.with_row_numbers(series, "n", stretch_s=DAY), series.withColumn("n", F.row_number().over(row())))
    same(stretches.with_last_before(series, "x", "before", stretch_s=DAY), series.withColumn("before", F.lag("x").over(row())))
    assert stretches.with_running(series.limit(0), {"s": ("sum", "x")}, {"t": "s"}).count() == 0
    assert stretches.with_row_frames(series.limit(0), lambda w: {"l": F.lag("x").over(w)}, before=1).count() == 0


@pytest.fixture(scope="module")
def candles(series):
    return series.where("symbol IS NOT NULL AND open_time IS NOT NULL").select("symbol", "open_time", (F.abs("y") + 0.1).alias("close"), F.coalesce("x", F.lit(0.0)).alias("prediction")).cache()


@pytest.mark.parametrize("operator", [
    lambda c, s: joins.align_predictions(c.select("symbol", "open_time", "prediction"), c, stretch_s=s),
    lambda c, s: joins.fill_actuals(c.select("symbol", "open_time", "prediction", F.col("prediction").alias("predicted_close")), c, s),
    lambda c, s: labels.forward_returns(c, {"short": 1, "long": 24}, stretch_s=s),
    lambda c, s: evaluate.backtest(c.withColumn("actual_log_return_lead1", F.col("close") - 1), 0.2, 0.01, stretch_s=s),
    lambda c, s: evaluate.simulate_pnl(c.withColumn("actual_log_return_lead1", F.col("close") - 1), 0.2, s),
    lambda c, s: evaluate.sign_strategy(c.withColumn("actual_log_return_lead1", F.col("close") - 1), stretch_s=s),
    lambda c, s: evaluate.rolling_rmse(c.withColumn("residual", F.col("close") - 1), s),
    lambda c, s: evaluate.rolling_score(c, "close", s),
])
def test_operators_give_the_same_for_any_stretch(candles, operator):
    same(operator(candles, 6 * 3600), operator(candles, 1000 * DAY))


def test_lag_correlation_for_any_stretch(candles):
    pairs = candles.select("symbol", "open_time", F.col("prediction").alias("sentiment_index"), F.col("close").alias("log_return"))
    for compat in (False, True):
        ours, plain = (sorted(map(tuple, aggs.lag_correlation(pairs, 5, compat, stretch_s=s).collect())) for s in (6 * 3600, 1000 * DAY))
        assert ours == plain and len(ours) == 22


def test_direct_signals_are_rounded_and_kept_within_bounds(spark):
    p = [0.3, 0.5, 0.51, -0.7, 1.5, -9.0, None, float("nan")]
    df = spark.createDataFrame([("x", T0 + dt.timedelta(hours=i), v, 0.1) for i, v in enumerate(p)], "symbol string, open_time timestamp, prediction double, actual_log_return_lead1 double")
    assert [r.signal for r in evaluate.backtest(df, direct=True).orderBy("open_time").collect()] == [0.0, 0.0, 1.0, -1.0, 1.0, -1.0, None, None]


def test_no_window_over_rows_is_partitioned_by_symbol_alone(candles):
    rows = candles.withColumns({"actual_log_return_lead1": F.col("close") - 1, "residual": F.col("close") - 1, "predicted_close": F.col("close")})
    for out in (evaluate.backtest(rows), evaluate.simulate_pnl(rows), evaluate.sign_strategy(rows), evaluate.rolling_rmse(rows), evaluate.rolling_score(rows, "close"), labels.forward_returns(rows), joins.fill_actuals(rows, candles),
                joins.align_predictions(rows.select("symbol", "open_time", "prediction"), candles), aggs.lag_correlation(rows, x="close", y="prediction")):
        windows = re.findall(r"\bWindow \[.*\], \[(symbol#\d+(?:, \w+#\d+L?)*)\], \[(\w+)#", out._jdf.queryExecution().executedPlan().toString())
        assert windows and all("," in by or order == "__stretch" for by, order in windows), windows


@pytest.mark.parametrize("span", [1, 3, 10])
@pytest.mark.parametrize("stretch_s", [3600, DAY, 1000 * DAY])
def test_exponential_means_for_any_stretch(series, stretch_s, span):
    df = series.where("symbol IS NOT NULL AND open_time IS NOT NULL").select("symbol", "open_time", "x")
    plain = df.toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    plain["e"] = plain.groupby("symbol").x.transform(lambda v: v.ewm(span=span, adjust=True, ignore_na=True).mean())
    ours = stretches.with_ewm(df, "x", span, "e", stretch_s=stretch_s)
    pd.testing.assert_frame_equal(ours.toPandas().sort_values(["symbol", "open_time"], ignore_index=True), plain, rtol=1e-9, atol=1e-12)


@pytest.fixture(scope="module")
def rows_of_features(series):
    """The series as candles, as trades and as open interest; ``extra`` and null symbols stay."""
    s = series.where("open_time IS NOT NULL")
    c = s.select("symbol", "open_time", "extra", (F.abs("y") + 1).alias("close"), (F.abs("y") + 0.5).alias("open"), (F.abs("y") + 2).alias("high"), F.abs("y").alias("low"), F.abs("x").alias("volume"))
    t = s.select("symbol", F.col("open_time").alias("timestamp"), (F.col("extra") == 1).alias("is_buyer_maker"), F.abs("x").alias("qty"))
    o = s.select("symbol", F.col("open_time").alias("timestamp"), "extra", F.col("x").alias("sum_open_interest"), F.col("y").alias("sum_taker_long_short_vol_ratio"))
    return c, t, o


def test_features_over_frames_of_rows(rows_of_features):
    """Against plain windows by symbol, for short stretches."""
    c, t, o = rows_of_features
    w5, w20 = row().rowsBetween(-5, 0), row().rowsBetween(-20, 0)
    plain = c.withColumns({"log_return": F.ln(F.col("close") / F.col("open")), "volatility": F.col("high") - F.col("low"), "ma_5": F.avg("close").over(w5), "ma_20": F.avg("close").over(w20), "volume_5": F.avg("volume").over(w5)})
    plain = plain.withColumns({"volatility_5": F.avg("volatility").over(w5), "log_return_lag1": F.lag("log_return").over(row()), "log_return_lag2": F.lag("log_return", 2).over(row()), "target": F.lead("log_return").over(row()),
                               "momentum": F.col("close") - F.col("ma_5"), "trend_strength": F.col("ma_5") - F.col("ma_20"), "volume_spike": F.when(F.col("volume_5") < 1e-6, 0.0).otherwise(F.coalesce(F.col("volume") / F.col("volume_5"), F.when(F.col("volume_5").isNull(), 0.0)))})
    same(features.feat_row_windows(c, stretch_s=DAY), plain)
    by_time = lambda d: d.withColumnRenamed("timestamp", "open_time")
    x, ratio, f = F.col("sum_open_interest"), F.col("sum_taker_long_short_vol_ratio"), row().rowsBetween(-9, 0)
    plain = by_time(o).withColumns({"oi_delta": x - F.lag(x).over(row()), "oi_zscore": F.when(F.count(x).over(f) >= 10, (x - F.avg(x).over(f)) / F.stddev(x).over(f)), "ratio_delta": ratio - F.lag(ratio).over(row())})
    same(by_time(features.open_interest_features(o, roll=10, stretch_s=DAY)), plain)
    of_minutes = lambda s: features.trade_imbalance(t, roll=5, stretch_s=s).withColumnRenamed("minute", "open_time")
    same(of_minutes(6 * 3600), of_minutes(10_000 * DAY))
    for empty in (features.feat_row_windows(c.limit(0)), features.trade_imbalance(t.limit(0)), features.open_interest_features(o.limit(0))):
        assert empty.count() == 0


def test_features_over_frames_of_rows_have_no_window_by_symbol(rows_of_features):
    c, t, o = rows_of_features
    for out in (features.feat_row_windows(c), features.trade_imbalance(t), features.open_interest_features(o)):
        windows = re.findall(r"\bWindow \[.*\], \[(symbol#\d+(?:, \w+#\d+L?)*)\], \[(\w+)#", out._jdf.queryExecution().executedPlan().toString())
        assert windows and all("," in by or order == "__stretch" for by, order in windows), windows
