"""Aggregations and statistics. Scalars that a second pass needs are one-row tables that are broadcast, never collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.functions.columns import correlation
from candlelake.functions.stretches import STRETCH, with_row_frames
from candlelake.operators.clean import numeric
from candlelake.operators.reads import newest_per


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct().orderBy("symbol")


def symbol_info(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.min("open_time").alias("first_time"), F.max("open_time").alias("last_time"), F.count(F.lit(1)).alias("n_rows"))


def return_heatmap(gold: DataFrame, start=None, end=None) -> DataFrame:
    """Mean return and volume of valid rows by day of week (1 is Sunday) and hour."""
    df = gold.where("is_valid_feature_row")
    df = df.where(F.col("open_time") >= F.lit(start)) if start else df
    df = df.where(F.col("open_time") <= F.lit(end)) if end else df
    return df.groupBy("day_of_week", "hour").agg(F.avg("log_return").alias("avg_return"), F.avg("volume").alias("avg_volume"), F.count(F.lit(1)).alias("n_rows"))


def prediction_accuracy(preds: DataFrame, limit: int = 100) -> DataFrame:
    """Per symbol over its newest matched predictions: counts, mean absolute error, accuracy in percent.

    Rows without an outcome are left out beforehand, so total equals matched; an unknown direction counts as wrong.
    """
    rows = newest_per(preds.where("actual_close IS NOT NULL"), limit)
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("actual_close").isNotNull(), 1)).alias("matched"), F.avg(F.abs("error")).alias("avg_abs_error"),
                                      (100 * F.avg(F.coalesce(F.col("direction_correct"), F.lit(False)).cast("double"))).alias("accuracy_pct"))


def sentiment_by_source(df: DataFrame, start=None, end=None) -> DataFrame:
    df = df.where(F.col("event_time") >= F.lit(start)) if start else df
    df = df.where(F.col("event_time") <= F.lit(end)) if end else df
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("messages"), F.sum("engagement").alias("engagement")).orderBy(F.desc("messages"), "source")


def lag_correlation(pairs: DataFrame, max_lag: int = 10, compat: bool = False, x: str = "sentiment_index", y: str = "log_return", stretch_s: int = STRETCH) -> DataFrame:
    """symbol, lag, correlation, n: Pearson's r of x[t + lag] and y[t] for each lag, of symbols with at least twice as many
    rows as lags. With compat, lag k pairs x[t - |k|] and y[t] for either sign, as older results do."""
    lags = range(-max_lag, max_lag + 1)
    name = lambda lag: f"__x{lag + max_lag}"
    rows = pairs.select("symbol", "open_time", F.struct(F.col(x).alias("x")).alias("__x"), F.col(y).alias("__y"))
    # One window gives every row the values of x around it; a null struct says that there is no row so far off.
    shifts = {abs(lag) if compat else -lag for lag in lags}
    around = lambda w: {f"__at{s}": F.lag("__x", s).over(w) for s in sorted(shifts)}
    rows = with_row_frames(rows, around, before=max_lag, after=0 if compat else max_lag, stretch_s=stretch_s)
    rows = rows.select("symbol", "__y", *[F.col(f"__at{abs(lag) if compat else -lag}").alias(name(lag)) for lag in lags])
    per = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("__rows"), *[F.struct(F.lit(lag).alias("lag"), F.round(correlation(F.col(name(lag))["x"], "__y"), 4).alias("correlation"), F.count(name(lag)).alias("n")).alias(name(lag)) for lag in lags])
    found = per.where(F.col("__rows") >= 2 * max_lag).select("symbol", F.explode(F.array(*[name(lag) for lag in lags])).alias("r"))
    return found.select("symbol", "r.lag", "r.correlation", "r.n").where("n > 0")


def regime_performance(aligned: DataFrame, column: str = "regime") -> DataFrame:
    return aligned.groupBy(F.col(column).alias("regime")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("direction_correct").cast("double")).alias("accuracy"), F.avg("abs_error").alias("mae"))


def confidence_bins(aligned: DataFrame, bins: int = 10) -> DataFrame:
    """Accuracy in equal-width bins of the absolute prediction, closed on the right: bin, midpoint, n, accuracy."""
    rows = aligned.where("prediction IS NOT NULL").withColumn("__c", F.abs("prediction"))
    ends = rows.agg(F.min("__c").alias("__low"), F.max("__c").alias("__high"))
    width = (F.col("__high") - F.col("__low")) / bins
    place = F.least(F.greatest(F.ceil(F.try_divide(F.col("__c") - F.col("__low"), width)), F.lit(1)), F.lit(bins))
    rows = rows.crossJoin(F.broadcast(ends)).withColumns({"bin": F.coalesce(place, F.lit(1)).cast("int"), "__mid": F.col("__low") + width * (F.coalesce(place, F.lit(1)) - 0.5)})
    return rows.groupBy("bin").agg(F.max("__mid").alias("midpoint"), F.count(F.lit(1)).alias("n"), F.avg(F.col("direction_correct").cast("double")).alias("accuracy"))


def direction_by_horizon(aligned: DataFrame, actual: str = "actual_log_return_lead1", horizons: tuple[str, ...] = ("return_short", "return_long")) -> DataFrame:
    """Share of rows whose predicted sign is the actual one, per horizon."""
    long = aligned.unpivot([actual], list(horizons), "horizon", "predicted").where(f"predicted IS NOT NULL AND {actual} IS NOT NULL")
    return long.groupBy("horizon").agg(F.avg((F.signum("predicted") == F.signum(actual)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, pivot: bool = False) -> DataFrame:
    rows = df.where(f"{actual} IS NOT NULL AND {predicted} IS NOT NULL").select(F.col(actual).cast("int").alias("actual"), F.rint(predicted).cast("int").alias("predicted"))
    if pivot:
        return rows.groupBy("actual").pivot("predicted", [0, 1, 2]).count().na.fill(0)
    return rows.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def symbol_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "symbol")


def rows_per_interval(df: DataFrame, step: str = "1 minute", time: str = "open_time") -> DataFrame:
    """interval, n: rows per step, with 0 for steps between the first and the last that have none."""
    counts = df.where(f"{time} IS NOT NULL").groupBy(F.window(time, step)["start"].alias("interval")).agg(F.count(F.lit(1)).alias("n"))
    grid = counts.agg(F.min("interval").alias("__a"), F.max("interval").alias("__b")).where("__a IS NOT NULL").select(F.explode(F.sequence("__a", "__b", F.expr(f"INTERVAL {step}"))).alias("interval"))
    return grid.join(counts, "interval", "left").select("interval", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def cumulative_rows(df: DataFrame, step: str = "5 minutes", time: str = "open_time") -> DataFrame:
    """interval, n, total: as rows_per_interval, with a running sum.

    Running sums go by day, on top of the totals of the days before; only daily totals are summed in one place.
    """
    per = rows_per_interval(df, step, time).withColumn("__day", F.to_date("interval"))
    days = per.groupBy("__day").agg(F.sum("n").alias("__n"))
    days = days.withColumn("__before", F.sum("__n").over(Window.orderBy("__day")) - F.col("__n")).drop("__n")
    inside = F.sum("n").over(Window.partitionBy("__day").orderBy("interval"))
    return per.join(days, "__day").select("interval", "n", (F.col("__before") + inside).alias("total"))


def ingestion_latency(df: DataFrame) -> DataFrame:
    """symbol, open_time, latency_s of rows with both times."""
    rows = df.where("ingestion_time IS NOT NULL AND open_time IS NOT NULL")
    return rows.select("symbol", "open_time", (F.unix_micros("ingestion_time") / 1e6 - F.unix_micros("open_time") / 1e6).alias("latency_s"))


def _unpivoted(row: DataFrame, names: list[str], value: str, key: str = "column") -> DataFrame:
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in names])).alias("__x")).select("__x.*")


def null_rates(df: DataFrame, cols: list[str] | None = None, counts: bool = False) -> DataFrame:
    """column, null_pct of the columns that have nulls, highest first; with counts, null_count of all columns."""
    cols = df.columns if cols is None else cols
    if counts:
        return _unpivoted(df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]), cols, "null_count")
    share = df.agg(*[(100 * F.avg(F.col(c).isNull().cast("double"))).alias(c) for c in cols])
    return _unpivoted(share, cols, "null_pct").where("null_pct > 0").orderBy(F.desc("null_pct"), "column")


#: Ranges that the values of a column are counted in, before the ones that hold a quantile are looked into.
RANGES = 256


def exact_quantiles(values: DataFrame, shares: list[float], by: str = "feature", value: str = "x") -> DataFrame:
    """by, and q0, q1, ...: the quantiles of the values of each series, interpolated between neighbours; null without values.

    A sketch deals the values of a series into ranges; counts of the ranges say which of them hold the ranks that are asked
    for, and only their values are counted one by one. No task or buffer holds a series, and where the ranges end doesn't
    matter for the result. NaN counts as the largest value.
    """
    rows = values.where(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("__x"))
    ends = rows.groupBy(by).agg(F.percentile_approx("__x", [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("__ends"), F.count(F.lit(1)).alias("__n"))
    # A range goes from the end before it, left out, to its own; equal values share one.
    place = F.size(F.filter("__ends", lambda e: e < F.col("__x")))
    dealt = rows.join(F.broadcast(ends), by).select(by, "__x", "__n", place.alias("__range"))
    counts = dealt.groupBy(by, "__range").agg(F.count(F.lit(1)).alias("__c"), F.first("__n").alias("__n"))
    before = F.sum("__c").over(Window.partitionBy(by).orderBy("__range")) - F.col("__c")
    low = lambda s: F.floor((F.col("__n") - 1) * F.lit(float(s))).cast("long")
    high = lambda s: F.least(low(s) + 1, F.col("__n") - 1)
    wanted = F.array(*[rank(s) for s in shares for rank in (low, high)])
    ranges = counts.withColumn("__before", before).withColumn("__wanted", F.filter(wanted, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__c")))).where(F.size("__wanted") > 0)
    # Values of those ranges, once each with their number: a value that is as common as a range is one row.
    inside = dealt.join(F.broadcast(ranges.select(by, "__range", "__before")), [by, "__range"]).groupBy(by, "__range", "__before", "__x").agg(F.count(F.lit(1)).alias("__c"))
    last = F.col("__before") + F.sum("__c").over(Window.partitionBy(by, "__range").orderBy("__x"))
    inside = inside.withColumn("__last", last).withColumn("__first", F.col("__last") - F.col("__c")).join(F.broadcast(ends.select(by, "__n")), by)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("__first")) & (rank < F.col("__last")), F.col("__x")))

    found = inside.groupBy(by).agg(F.first("__n").alias("__n"), *[at(r(s)).alias(f"__{n}{i}") for i, s in enumerate(shares) for n, r in (("low", low), ("high", high))])
    part = lambda i, s: (F.col("__n") - 1) * F.lit(float(s)) - low(s)
    return found.select(by, *[F.when(part(i, s) == 0, F.col(f"__low{i}")).otherwise(F.col(f"__low{i}") + (F.col(f"__high{i}") - F.col(f"__low{i}")) * part(i, s)).alias(f"q{i}") for i, s in enumerate(shares)])


def baseline_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """feature, mean, std, min, p25, p75, max of numeric columns: one pass for the moments, and exact quantiles of all columns
    together."""
    cols = numeric(df) if cols is None else cols
    fn = {"mean": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
    row = df.agg(*[F.struct(*[f(F.col(c).cast("double")).alias(n) for n, f in fn.items()]).alias(c) for c in cols])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in cols])).alias("__v")).select("__v.*")
    stats = _unpivoted(row, cols, "__s", "feature").select("feature", "__s.*")
    return stats.join(exact_quantiles(long, [0.25, 0.75]).withColumnsRenamed({"q0": "p25", "q1": "p75"}), "feature", "left").select("feature", "mean", "std", "min", "p25", "p75", "max")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """x, y, correlation for all pairs of at most a few columns, over rows that have all of them; in one pass."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = rows.agg(*[(F.when(F.stddev_pop(a) > 0, F.lit(1.0)) if a == b else correlation(a, b)).alias(f"{a}|{b}") for a, b in pairs])
    both = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{k}`").alias("correlation")) for a, b, k in both])).alias("__x")).select("__x.*")


def histogram(df: DataFrame, column: str, bins: int = 40, side: str | None = None) -> DataFrame:
    """bin, low, high, n of equal-width bins that hold rows; the last is closed. With ``side``, a column that tells several
    series apart, the bins are common to all of them and each bin is counted by side."""
    by = [side] if side else []
    rows = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("__v"))
    ends = rows.agg(F.min("__v").alias("__a"), F.max("__v").alias("__b"))
    width = (F.col("__b") - F.col("__a")) / bins
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col("__v") - F.col("__a"), width)), F.lit(bins - 1)), F.lit(0)).cast("int")
    rows = rows.crossJoin(F.broadcast(ends)).withColumns({"bin": place, "__w": width})
    return rows.groupBy(*by, "bin").agg(F.min(F.col("__a") + F.col("bin") * F.col("__w")).alias("low"), F.min(F.col("__a") + (F.col("bin") + 1) * F.col("__w")).alias("high"), F.count(F.lit(1)).alias("n"))


def compared_histograms(sides: dict[str, DataFrame], column: str, bins: int = 50) -> DataFrame:
    """side, bin, low, high, n: a column of several tables on common bins, such as live rows and the baseline, or
    predictions before and after a retraining."""
    rows = [df.select(F.lit(name).alias("side"), column) for name, df in sides.items()]
    return histogram(reduce(DataFrame.unionByName, rows), column, bins, "side")


def residual_summary(aligned: DataFrame) -> DataFrame:
    return aligned.agg(F.avg("residual").alias("mean"), F.stddev("residual").alias("std"), F.count("residual").alias("n"))


def health_kpis(gold: DataFrame, preds: DataFrame, drift: DataFrame) -> DataFrame:
    """One row: latest prediction and their number, valid and invalid feature rows, latest drift score."""
    p = preds.agg(F.max("open_time").alias("last_prediction_time"), F.count(F.lit(1)).alias("predictions"))
    g = gold.agg((100 * F.avg(F.col("is_valid_feature_row").cast("double"))).alias("valid_pct"), F.count(F.when(~F.col("is_valid_feature_row"), 1)).alias("invalid_rows"))
    d = drift.agg(F.max_by("overall_drift_score", F.struct("timestamp", "overall_drift_score")).alias("last_drift_score"))
    return p.crossJoin(F.broadcast(g)).crossJoin(F.broadcast(d))


def layer_freshness(gold: DataFrame) -> DataFrame:
    """One row: newest times, last close and return that are known, rows."""
    known = lambda c: F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.struct("open_time", "symbol")))
    newest = [F.max("ingestion_time").alias("last_ingestion_time")] if "ingestion_time" in gold.columns else []
    return gold.agg(F.max("open_time").alias("last_open_time"), *newest, known("close").alias("last_close"), known("log_return").alias("last_return"), F.count(F.lit(1)).alias("n_rows"))


def target_stats(df: DataFrame, target: str, features: list[str], label: str | None = None) -> DataFrame:
    """Per split: rows, mean and deviation of the target, class counts, and of the features NaN count, mean, deviation."""
    classes = [F.count(F.when(F.col(label) == k, 1)).alias(f"class_{k}") for k in (0, 1, 2)] if label else []
    nans = reduce(lambda a, b: a + b, [F.count(F.when(F.isnan(F.col(c).cast("double")) | F.col(c).isNull(), 1)) for c in features], F.lit(0))
    stats = [e for c in features for e in (F.avg(c).alias(f"{c}_mean"), F.stddev(c).alias(f"{c}_std"))]
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(target).alias("target_mean"), F.stddev(target).alias("target_std"), *classes, nans.cast("long").alias("feature_nans"), *stats)


def resample_candles(df: DataFrame, interval: str) -> DataFrame:
    """Candles of a longer interval, such as "1 day"."""
    time = F.col("open_time")
    return (df.groupBy("symbol", F.window("open_time", interval)["start"].alias("open_time"))
            .agg(F.min_by("open", time).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", time).alias("close"), F.sum("volume").alias("volume"),
                 F.sum("quote_volume").alias("quote_volume"), F.sum("trades").alias("trades"), F.sum("taker_buy_base").alias("taker_buy_base"), F.sum("taker_buy_quote").alias("taker_buy_quote")))


def drift_summary(history: DataFrame) -> DataFrame:
    """One row for the latest run: its scores, from the overall row or else the maxima, and whether it triggered."""
    last = history.agg(F.max("timestamp").alias("__last"))
    run = history.join(F.broadcast(last), F.col("timestamp") == F.col("__last"), "left_semi")
    overall = F.col("feature_name") == "__overall__"
    score = lambda c, kind: F.coalesce(F.max(F.when(overall, F.col(c))), F.max(F.when(F.col("drift_type") == kind if kind else F.lit(True), F.col("drift_score"))))
    return run.agg(F.max("timestamp").alias("timestamp"), score("overall_drift_score", None).alias("overall_drift_score"), score("data_drift_score", "data").alias("data_drift_score"), score("model_drift_score", "model").alias("model_drift_score"),
                   F.bool_or("drift_detected").alias("drift_detected"), F.bool_or("triggered").alias("triggered"), F.count(F.when((F.col("drift_type") == "data") & F.col("drift_detected"), 1)).alias("drifted_features"))
