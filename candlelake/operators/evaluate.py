"""Prediction quality and backtests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.functions.columns import correlation
from candlelake.functions.stretches import STRETCH, with_last_before, with_row_frames, with_row_numbers, with_running


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: rmse, mae, correlation (0 if undefined), r2 (0 for a constant target), n."""
    rows = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()).select(F.col(y).cast("double").alias("y"), F.col(yhat).cast("double").alias("p"))
    e = F.col("y") - F.col("p")
    return rows.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.coalesce(F.nanvl(correlation("y", "p"), F.lit(0.0)), F.lit(0.0)).alias("correlation"),
                    F.coalesce(1 - F.try_divide(F.sum(e * e), F.var_pop("y") * F.count("y")), F.lit(0.0)).alias("r2"), F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: accuracy and macro precision, recall, f1 over all classes of either side; 0 where undefined."""
    rows = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()).select(F.col(y).cast("int").alias("y"), F.rint(yhat).cast("int").alias("p"))
    pairs = rows.groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    side = F.explode(F.array(F.struct(F.col("y").alias("class"), F.lit(1).alias("real")), F.struct(F.col("p").alias("class"), F.lit(0).alias("real")))).alias("s")
    per = pairs.select("y", "p", "n", side).groupBy("s.class").agg(F.sum(F.when(F.col("s.real") == 1, F.col("n")).otherwise(0)).alias("real"), F.sum(F.when(F.col("s.real") == 0, F.col("n")).otherwise(0)).alias("said"),
                                                                   F.sum(F.when((F.col("y") == F.col("p")) & (F.col("s.real") == 1), F.col("n")).otherwise(0)).alias("right"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    per = per.withColumns({"precision": ratio("right", "said"), "recall": ratio("right", "real")})
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    return per.agg(F.try_divide(F.sum("right").cast("double"), F.sum("real")).alias("accuracy"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("real").alias("n"))


def binned_actual_sign(df: DataFrame, column: str, threshold: float, output: str = "actual_sign") -> DataFrame:
    """0 up to -threshold, 1 up to the threshold, 2 above; right-closed."""
    x = F.col(column)
    return df.withColumn(output, F.when(x <= -threshold, 0).when(x <= threshold, 1).when(x > threshold, 2))


#: Rows of the widest rolling frame.
WIDEST = 120


def _rolling(df: DataFrame, value, output: str, stretch_s: int) -> DataFrame:
    """Mean of the last w values per symbol, w a sixth of the symbol's rows within 20 to 120; null for fewer than w / 4. Adds
    __overall too, the mean of all values of the symbol."""
    df = df.withColumn("__v", value).where("__v IS NOT NULL")
    # A row for each symbol: its width and mean.
    per = df.groupBy(F.col("symbol").alias("__symbol")).agg(F.count("__v").alias("__count"), F.avg("__v").alias("__overall"))
    per = per.select("__symbol", F.greatest(F.lit(20), F.least(F.lit(WIDEST), F.floor(F.col("__count") / 6))).cast("int").alias("__w"), "__overall")
    df = with_row_numbers(df, "__n", stretch_s=stretch_s).join(per, F.col("symbol").eqNullSafe(F.col("__symbol"))).drop("__symbol")

    # Row numbers in units of the width make the frame a constant range: the row w before is one unit away, just outside.
    df = df.withColumn("__k", F.col("__n") / F.col("__w"))
    over = "OVER (PARTITION BY symbol, __block ORDER BY __k RANGE BETWEEN 0.99999D PRECEDING AND CURRENT ROW)"
    df = with_row_frames(df, lambda _: {"__mean": F.expr(f"avg(__v) {over}"), "__own": F.expr(f"count(__v) {over}")}, before=WIDEST - 1, stretch_s=stretch_s)
    least = F.greatest(F.lit(5), F.floor(F.col("__w") / 4))
    return df.withColumn(output, F.when(F.col("__own") >= least, F.col("__mean")))


def rolling_rmse(df: DataFrame, stretch_s: int = STRETCH) -> DataFrame:
    """symbol, open_time, rolling_rmse and the symbol's overall_rmse."""
    out = _rolling(df, F.col("residual") * F.col("residual"), "__rolling", stretch_s)
    return out.select("symbol", "open_time", F.sqrt("__rolling").alias("rolling_rmse"), F.sqrt("__overall").alias("overall_rmse"))


def rolling_score(df: DataFrame, column: str, stretch_s: int = STRETCH) -> DataFrame:
    """symbol, open_time, rolling_score: rolling mean of a flag or score."""
    return _rolling(df, F.col(column).cast("double"), "rolling_score", stretch_s).select("symbol", "open_time", "rolling_score")


def backtest(df: DataFrame, threshold: float = 0.0, cost: float = 0.0, direct: bool = False, predicted: str = "prediction", actual: str = "actual_log_return_lead1", stretch_s: int = STRETCH) -> DataFrame:
    """Signals, turnover, strategy and benchmark returns, their cumulative products and drawdowns, per symbol. ``direct``
    takes the prediction, rounded and kept within -1 to 1, as the signal; null or NaN is none."""
    p, r = F.col(predicted), F.coalesce(actual, F.lit(0.0))
    signal = F.when(p.isNotNull() & ~F.isnan(p), F.least(F.greatest(F.rint(p), F.lit(-1.0)), F.lit(1.0))) if direct else F.when(p > threshold, 1.0).when(p < -threshold, -1.0).otherwise(0.0)
    rows = with_last_before(df.select("symbol", "open_time", signal.alias("signal"), r.alias("benchmark_return")), "signal", "__before", stretch_s=stretch_s)
    rows = rows.withColumn("turnover", F.coalesce(F.abs(F.col("signal") - F.col("__before")), F.lit(0.0))).drop("__before")
    rows = rows.withColumn("strategy_return", F.col("signal") * F.col("benchmark_return") - F.col("turnover") * cost)
    products = {"cumulative": ("product", 1 + F.col("strategy_return")), "benchmark_cumulative": ("product", 1 + F.col("benchmark_return"))}
    rows = with_running(rows, products, {"__top": "cumulative", "__benchmark_top": "benchmark_cumulative"}, stretch_s=stretch_s)
    drawdown = lambda c, top: F.try_divide(F.col(c), F.col(top)) - 1
    return rows.withColumns({"drawdown": drawdown("cumulative", "__top"), "benchmark_drawdown": drawdown("benchmark_cumulative", "__benchmark_top")}).drop("__top", "__benchmark_top")


def simulate_pnl(aligned: DataFrame, threshold: float = 0.0, stretch_s: int = STRETCH) -> DataFrame:
    """Trades whose prediction exceeds the threshold: signal, trade_return, running sum, drawdown, per symbol."""
    p, r = F.col("prediction"), F.col("actual_log_return_lead1")
    rows = aligned.where(r.isNotNull() & (F.abs(p) > threshold)).select("symbol", "open_time", F.signum(p).alias("signal"), (F.signum(p) * r).alias("trade_return"))
    rows = with_running(rows, {"cumulative_pnl": ("sum", "trade_return")}, {"__top": "cumulative_pnl"}, stretch_s=stretch_s)
    return rows.withColumn("drawdown", F.col("cumulative_pnl") - F.col("__top")).drop("__top")


def pnl_summary(aligned: DataFrame, threshold: float = 0.0, periods: int = 252 * 24) -> DataFrame:
    """One row: trades, share of winning ones, total, annualised sharpe (null without spread)."""
    p, r = F.col("prediction"), F.col("trade_return")
    rows = aligned.where(F.col("actual_log_return_lead1").isNotNull() & (F.abs(p) > threshold)).select((F.signum(p) * F.col("actual_log_return_lead1")).alias("trade_return"))
    return rows.agg(F.count(F.lit(1)).alias("n_trades"), F.avg((r > 0).cast("double")).alias("hit_ratio"), F.sum(r).alias("total_return"), (F.try_divide(F.avg(r), F.stddev(r)) * F.sqrt(F.lit(float(periods)))).alias("sharpe"))


def sign_strategy(df: DataFrame, predicted: str = "prediction", actual: str = "actual_log_return_lead1", stretch_s: int = STRETCH) -> DataFrame:
    """Per symbol and time: strategy and buy-and-hold running sums, and the symbol's sharpe (population deviation)."""
    rows = df.where(F.col(actual).isNotNull()).select("symbol", "open_time", F.col(actual).alias("hold_return"), F.when(F.col(predicted) > 0, F.col(actual)).otherwise(-F.col(actual)).alias("strategy_return"))
    sharpe = rows.groupBy(F.col("symbol").alias("__symbol")).agg(F.try_divide(F.avg("strategy_return"), F.stddev_pop("strategy_return")).alias("sharpe"))
    rows = with_running(rows, {"strategy_total": ("sum", "strategy_return"), "hold_total": ("sum", "hold_return")}, stretch_s=stretch_s)
    return rows.join(sharpe, F.col("symbol").eqNullSafe(F.col("__symbol"))).drop("__symbol")


def direction_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: share of right directions, precision and recall of upward moves (0 where undefined)."""
    rows = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    up, said = F.col(y) > 0, F.col(yhat) > 0
    count = lambda c: F.sum(c.cast("double"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return rows.agg(F.avg((up == said).cast("double")).alias("direction_accuracy"), zero(F.try_divide(count(up & said), count(said))).alias("precision_up"), zero(F.try_divide(count(up & said), count(up))).alias("recall_up"), F.count(F.lit(1)).alias("n"))
