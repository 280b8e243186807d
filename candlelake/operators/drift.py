"""Distribution drift of features and predictions, and the decision to train again.

Features are unpivoted, so that all of them share one job; the cumulative distributions of the Kolmogorov-Smirnov
statistic are windows within ranges of a feature's values, over one row for each distinct value.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that aren't features: keys, times, prices, calendar.
NOT_FEATURES = frozenset("symbol open_time close_time date ingestion_time open high low close hour day_of_week is_valid_feature_row source".split())


#: Ranges of values of a feature whose distributions are compared.
RANGES = 64


@dataclass
class DriftConfig:
    threshold: float = 0.2
    min_rows: int = 100
    recent_rows: int = 5_000
    baseline_rows: int = 200_000


def feature_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in NOT_FEATURES]


def _long(df: DataFrame, features: list[str], side: int) -> DataFrame:
    """feature, x, side: one row for each value that isn't null or NaN."""
    x = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("v")
    return df.select(x).select("v.feature", "v.x", F.lit(side).alias("side")).where("x IS NOT NULL AND NOT isnan(x)")


def _both(base: DataFrame, recent: DataFrame, features: list[str]) -> DataFrame:
    return _long(base, features, 0).unionByName(_long(recent, features, 1))


def ks_statistic(base: DataFrame, recent: DataFrame, features: list[str]) -> DataFrame:
    """feature, ks_statistic: largest distance of the two distribution functions; 0 where a side has fewer than 2 values."""
    count = lambda s: F.sum((F.col("side") == s).cast("long"))
    values = _both(base, recent, features).groupBy("feature", "x").agg(count(0).alias("b"), count(1).alias("r"))
    # A feature's values are dealt into ranges of about equal size, so that no task sorts all of them; where the ranges end
    # doesn't matter for the result. What earlier ranges hold is a row for each feature and range.
    ends = values.groupBy("feature").agg(F.percentile_approx("x", [i / RANGES for i in range(1, RANGES)], 1000).alias("ends"))
    dealt = values.join(F.broadcast(ends), "feature").select("feature", "x", "b", "r", F.size(F.filter("ends", lambda e: e < F.col("x"))).alias("range"))
    ranges = dealt.groupBy("feature", "range").agg(F.sum("b").alias("b"), F.sum("r").alias("r"))
    before, all_ = Window.partitionBy("feature").orderBy("range"), Window.partitionBy("feature")
    ranges = ranges.select("feature", "range", (F.sum("b").over(before) - F.col("b")).alias("b0"), (F.sum("r").over(before) - F.col("r")).alias("r0"), F.sum("b").over(all_).alias("nb"), F.sum("r").over(all_).alias("nr"))
    up = Window.partitionBy("feature", "range").orderBy("x")
    steps = dealt.join(F.broadcast(ranges), ["feature", "range"]).select("feature", (F.col("b0") + F.sum("b").over(up)).alias("cb"), (F.col("r0") + F.sum("r").over(up)).alias("cr"), "nb", "nr")
    found = steps.groupBy("feature").agg(F.max("nb").alias("nb"), F.max("nr").alias("nr"), F.max(F.abs(F.try_divide(F.col("cb"), F.col("nb")) - F.try_divide(F.col("cr"), F.col("nr")))).alias("d"))
    names = base.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(found, "feature", "left").select("feature", F.when((F.col("nb") >= 2) & (F.col("nr") >= 2), F.col("d")).otherwise(0.0).alias("ks_statistic"))


#: Size of the quantile sketches, and the quantiles at which distributions are compared. Ranks from a sketch are off by 0.4 %
#: at most, with 99 % confidence, so KS by not much more than twice that.
SKETCH, POINTS = 1024, 1000


def _quantiles(sketch: str) -> Column:
    # Literals: the functions of sketches take no others.
    return F.expr(f"kll_sketch_get_quantile_double({sketch}, array({', '.join(f'{i / POINTS}D' for i in range(POINTS + 1))}))")


def _ks_of_sketches(base: DataFrame, recent: DataFrame) -> DataFrame:
    """feature, ks_statistic from feature, sketch, n of either side; compared at the quantiles of both."""
    side = lambda d, s: d.select("feature", _quantiles("sketch").alias(f"q_{s}"), F.col("n").alias(f"n_{s}"))
    rank = lambda q, x: F.size(F.filter(q, lambda v: v <= x)) / (POINTS + 1)
    gap = F.array_max(F.transform(F.array_distinct(F.concat("q_b", "q_r")), lambda x: F.abs(rank("q_b", x) - rank("q_r", x))))
    return side(base, "b").join(side(recent, "r"), "feature").select("feature", F.when((F.col("n_b") >= 2) & (F.col("n_r") >= 2), gap).otherwise(0.0).alias("ks_statistic"))


def ks_approximate(base: DataFrame, recent: DataFrame, features: list[str]) -> DataFrame:
    """As ks_statistic from quantile sketches, for samples whose distinct values are too many to sort."""
    sketch = lambda df: _long(df, features, 0).groupBy("feature").agg(F.expr(f"kll_sketch_agg_double(x, {SKETCH})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    return _ks_of_sketches(sketch(base), sketch(recent))


def drift_sketches(df: DataFrame, features: list[str] | None = None, time: str = "open_time") -> DataFrame:
    """feature, date, sketch, n, mean, squares: what drift needs of each day's values, a row per feature and day. Sketches of
    new rows are appended to those that are kept; several of a day are as good as one."""
    features = features or feature_names(df)
    x = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("v")
    long = df.select(F.to_date(time).alias("date"), x).select("date", "v.*").where("x IS NOT NULL AND NOT isnan(x)")
    # squares: the sum of squared differences from the mean.
    return long.groupBy("feature", "date").agg(F.expr(f"kll_sketch_agg_double(x, {SKETCH})").alias("sketch"), F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count(F.lit(1))).alias("squares"))


def newest_days(sketches: DataFrame, rows: int) -> DataFrame:
    """The sketches of each feature's newest days that have that many values together (all, if they have fewer)."""
    days = sketches.groupBy("feature", "date").agg(F.sum("n").alias("__n"))
    newer = F.sum("__n").over(Window.partitionBy("feature").orderBy(F.desc("date"))) - F.col("__n")
    return sketches.join(days.withColumn("__newer", newer).where(F.col("__newer") < rows).select("feature", "date"), ["feature", "date"], "left_semi")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """feature, sketch, n, mean, std (population): all days of a feature as one."""
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
    return sketches.groupBy("feature").agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"), n.alias("n"), mean.alias("mean"), F.sqrt(F.greatest((F.sum("squares") + between) / n, F.lit(0.0))).alias("std"))


def drift_from_sketches(base: DataFrame, recent: DataFrame, features: list[str], cfg: DriftConfig | None = None, kind: str = "data", prefix: str = "") -> DataFrame:
    """As data_drift and model_drift, from kept sketches of either side (see ``drift_sketches``): no row of the baseline is read
    again. The newest days with as many values as the configuration has rows are compared; KS is as near as sketches are,
    shifts are exact."""
    cfg = cfg or DriftConfig()
    b, r = (merged_sketches(newest_days(d.where(F.col("feature").isin(features)), n)) for d, n in ((base, cfg.baseline_rows), (recent, cfg.recent_rows)))
    moments = lambda d, s: d.select("feature", F.col("n").alias(f"n{s}"), F.col("mean").alias(f"m{s}"), F.col("std").alias(f"s{s}"))
    names = base.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    both = names.join(moments(b, "b"), "feature", "left").join(moments(r, "r"), "feature", "left").join(_ks_of_sketches(b, r), "feature", "left")
    out = _shifts(both, F.coalesce("ks_statistic", F.lit(0.0)).alias("ks_statistic"), "nb", "nr")
    enough = (F.col("nb") >= cfg.min_rows) & (F.col("nr") >= cfg.min_rows)
    score = F.when(enough, F.greatest("ks_statistic", "shift_score")).otherwise(0.0)
    return out.select(F.concat(F.lit(prefix), "feature").alias("feature_name"), F.lit(kind).alias("drift_type"), score.alias("drift_score"), (score >= cfg.threshold).alias("drift_detected"), "ks_statistic", "mean_shift", "std_shift")


def mean_std_shift(base: DataFrame, recent: DataFrame, features: list[str]) -> DataFrame:
    """feature, mean_shift, std_shift, shift_score: changes relative to the baseline, and their mean; 0 where a side has fewer
    than 2 values."""
    x = lambda s: F.when(F.col("side") == s, F.col("x"))
    return _shifts(_both(base, recent, features).groupBy("feature").agg(F.count(x(0)).alias("nb"), F.count(x(1)).alias("nr"), F.avg(x(0)).alias("mb"), F.avg(x(1)).alias("mr"), F.stddev_pop(x(0)).alias("sb"), F.stddev_pop(x(1)).alias("sr")))


def _shifts(moments: DataFrame, *keep) -> DataFrame:
    """The shifts from nb, mb, sb of the baseline and nr, mr, sr of recent values."""
    shift = lambda a, b: F.when((F.col("nb") >= 2) & (F.col("nr") >= 2), F.abs(F.col(b) - F.col(a)) / (F.abs(F.col(a)) + 1e-6)).otherwise(0.0)
    out = moments.select("feature", *keep, shift("mb", "mr").alias("mean_shift"), shift("sb", "sr").alias("std_shift"))
    return out.withColumn("shift_score", (F.col("mean_shift") + F.col("std_shift")) / 2)


def newest_rows(df: DataFrame, n: int, time: str = "open_time", by: str = "symbol") -> DataFrame:
    """The n newest rows; of one time, those of the smallest symbols. Rows are counted by time, and times summed up by day, so
    that no task sorts all rows or holds the n."""
    own = df.withColumn("__day", F.to_date(time))
    times = own.groupBy("__day", F.col(time).alias("__t")).agg(F.count(F.lit(1)).alias("__c"))
    days = times.groupBy("__day").agg(F.sum("__c").alias("__c"))
    newer = lambda w: F.sum("__c").over(w) - F.col("__c")
    days = days.select(F.col("__day").alias("__d"), newer(Window.orderBy(F.desc_nulls_last("__day"))).alias("__newer")).where(F.col("__newer") < n)
    times = times.join(days, F.col("__day").eqNullSafe(F.col("__d")))
    times = times.withColumn("__newer", F.col("__newer") + newer(Window.partitionBy("__day").orderBy(F.desc("__t")))).where(F.col("__newer") < n).drop("__day", "__d")
    rows = df.join(times, F.col(time).eqNullSafe(F.col("__t")))  # hardly more than n
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("__t").orderBy(by))).where(F.col("__newer") + F.col("__n") <= n).select(*df.columns)


def _drift(base: DataFrame, recent: DataFrame, features: list[str], cfg: DriftConfig, kind: str) -> DataFrame:
    found = ks_statistic(base, recent, features).join(mean_std_shift(base, recent, features), "feature", "left")
    n = base.agg(F.count(F.lit(1)).alias("__b")).crossJoin(F.broadcast(recent.agg(F.count(F.lit(1)).alias("__r"))))
    enough = (F.col("__b") >= cfg.min_rows) & (F.col("__r") >= cfg.min_rows)
    score = F.when(enough, F.greatest("ks_statistic", F.coalesce("shift_score", F.lit(0.0)))).otherwise(0.0)
    return found.crossJoin(F.broadcast(n)).select(F.col("feature").alias("feature_name"), F.lit(kind).alias("drift_type"), score.alias("drift_score"), (score >= cfg.threshold).alias("drift_detected"), "ks_statistic", F.coalesce("mean_shift", F.lit(0.0)).alias("mean_shift"), F.coalesce("std_shift", F.lit(0.0)).alias("std_shift"))


def data_drift(base: DataFrame, recent: DataFrame, features: list[str] | None = None, cfg: DriftConfig | None = None) -> DataFrame:
    """A row per feature, of the newest rows of either side; too few rows score 0."""
    cfg = cfg or DriftConfig()
    features = features or [f for f in feature_names(base) if f in recent.columns]
    return _drift(newest_rows(base, cfg.baseline_rows).select(*features), newest_rows(recent, cfg.recent_rows).select(*features), features, cfg, "data")


def model_drift(preds: DataFrame, base: DataFrame, targets: list[str], cfg: DriftConfig | None = None) -> DataFrame:
    """A row per prediction target: predictions against the labels of training, named __model__.target."""
    cfg = cfg or DriftConfig()
    out = _drift(newest_rows(base, cfg.baseline_rows).select(*targets), newest_rows(preds, cfg.recent_rows).select(*targets), targets, cfg, "model")
    return out.withColumn("feature_name", F.concat(F.lit("__model__."), "feature_name"))


def drift_report(data: DataFrame, model: DataFrame, cfg: DriftConfig | None = None) -> DataFrame:
    """Rows of data and model drift, with __model__ and __overall__ rows for the maxima, and the overall scores in each."""
    cfg = cfg or DriftConfig()
    rows = data.unionByName(model)
    top = rows.agg(F.coalesce(F.max(F.when(F.col("drift_type") == "data", F.col("drift_score"))), F.lit(0.0)).alias("data_drift_score"), F.coalesce(F.max(F.when(F.col("drift_type") == "model", F.col("drift_score"))), F.lit(0.0)).alias("model_drift_score"))
    top = top.withColumn("overall_drift_score", F.greatest("data_drift_score", "model_drift_score"))
    total = lambda name, score, kind: top.select(F.lit(name).alias("feature_name"), F.lit(kind).alias("drift_type"), F.col(score).alias("drift_score"), (F.col(score) >= cfg.threshold).alias("drift_detected"),
                                                 *[F.lit(0.0).alias(c) for c in ("ks_statistic", "mean_shift", "std_shift")])
    rows = rows.unionByName(total("__model__", "model_drift_score", "model")).unionByName(total("__overall__", "overall_drift_score", "overall"))
    return rows.crossJoin(F.broadcast(top)).withColumn("threshold", F.lit(cfg.threshold))


def retrain_decision(report: DataFrame, last_trigger: dt.datetime | None, cooldown_min: int, now: dt.datetime) -> DataFrame:
    """One row: timestamp, triggered, trigger_reason (no_drift, cooldown_active or drift_detected)."""
    drifted = F.coalesce(F.bool_or((F.col("feature_name") == "__overall__") & F.col("drift_detected")), F.lit(False))
    cooling = last_trigger is not None and now - last_trigger < dt.timedelta(minutes=cooldown_min)
    reason = F.when(~F.col("__d"), "no_drift").when(F.lit(cooling), "cooldown_active").otherwise("drift_detected")
    return report.agg(drifted.alias("__d")).select(F.lit(now).alias("timestamp"), reason.alias("trigger_reason")).withColumn("triggered", F.col("trigger_reason") == "drift_detected")


def drift_history(report: DataFrame, decision: DataFrame) -> DataFrame:
    """The report's rows with the decision about them, to be appended to the history."""
    metric = F.when(F.col("drift_type") == "model", F.col("drift_score"))
    # A decision is one row; the limit makes that a bound.
    return report.crossJoin(F.broadcast(decision.limit(1))).withColumn("model_metric", metric)
