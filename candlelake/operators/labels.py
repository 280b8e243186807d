"""Forward returns, labels, time splits and weights."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.functions.columns import col
from candlelake.functions.stretches import STRETCH, with_row_frames
from candlelake.operators.clean import encode_symbol, trailing_window, valid_feature_rows

_MINUTES = {"m": 1, "h": 60, "d": 1440}
#: Targets when a configuration names none: the name and its horizon.
DEFAULT_TARGETS = {"return_short": "short", "return_long": "1d"}


def interval_minutes(interval: str) -> int:
    """Minutes of "5m", "1h" or "1d"."""
    text = interval.strip().lower()
    return int(text[:-1]) * _MINUTES[text[-1]]


def horizon_steps(horizon: str, interval: str) -> int:
    """Candles of a horizon: "short" is the next one, "1d", "day" and "long" are a day's."""
    text = horizon.strip().lower()
    if text == "short":
        return 1
    minutes = 1440 if text in ("1d", "day", "long") else interval_minutes(text)
    return max(1, minutes // interval_minutes(interval))


def forward_returns(df: DataFrame, horizons: dict[str, int] | None = None, interval: str = "5m", stretch_s: int = STRETCH) -> DataFrame:
    """ln(close h candles on / close) per target; also as log_return_lead1 for the next candle."""
    horizons = {"log_return_lead1": 1} | (horizons or {n: horizon_steps(h, interval) for n, h in DEFAULT_TARGETS.items()})

    def returns(w) -> dict:
        ahead = {n: F.lead("close", h).over(w) for n, h in horizons.items()}
        return {n: F.when((F.col("close") > 0) & (later > 0), F.ln(later / F.col("close"))) for n, later in ahead.items()}

    out = with_row_frames(df, returns, after=max(horizons.values()), stretch_s=stretch_s)
    return out.select(*[c for c in df.columns if c not in horizons], *horizons)


def sign_labels(df: DataFrame, column: str, threshold: float, output: str | None = None) -> DataFrame:
    """2 above the threshold, 0 below its negative, else 1, also for NaN; null stays null."""
    x = F.col(column)
    # Spark sorts NaN above all numbers.
    return df.withColumn(output or f"sign_{column}", F.when(F.isnan(x), 1).when(x > threshold, 2).when(x < -threshold, 0).when(x.isNotNull(), 1))


@dataclass
class TrainingConfig:
    features: list[str]
    symbols: list[str]
    horizons: dict[str, int] = field(default_factory=lambda: {"return_short": 1, "return_long": 24})
    threshold: float = 0.0002
    drop_neutral: bool = False
    days: int = 3650


def training_frame(gold: DataFrame, cfg: TrainingConfig) -> DataFrame:
    """Valid rows with forward returns, labels and symbol ids, of the trailing days."""
    df = forward_returns(valid_feature_rows(gold, cfg.features), cfg.horizons)
    for name in cfg.horizons:
        df = sign_labels(df, name, cfg.threshold, name.replace("return", "sign", 1))
    df = df.dropna(subset=list(cfg.horizons))
    if cfg.drop_neutral:
        df = df.where(F.col(next(iter(cfg.horizons)).replace("return", "sign", 1)) != 1)
    return trailing_window(encode_symbol(df, cfg.symbols), cfg.days)


#: Days of each part of a split where neither a model nor the general settings say otherwise.
SPLIT_DAYS = {"train": 90, "val": 14, "test": 7}


def split_days(model: dict[str, int] | None = None, general: dict[str, int] | None = None) -> dict[str, int]:
    """Days of train, val and test for a model: its own settings first, then the general ones, then SPLIT_DAYS."""
    return {part: int((model or {}).get(part, (general or {}).get(part, days))) for part, days in SPLIT_DAYS.items()}


def time_split(df: DataFrame, train: int, val: int, test: int, gap: int = 1, time: str = "open_time") -> DataFrame:
    """Adds split: the last ``test`` days, before them ``val``, before those ``train``, with gaps of ``gap`` days between
    them; half-open ranges. Rows in gaps or before the first range go."""
    last = df.agg(F.max(time).alias("__last"))
    back = lambda days: F.col("__last") - F.make_interval(days=F.lit(days))
    t, v0, v1 = F.col(time), test + gap + val, test + gap
    split = F.when(t >= back(test), "test").when((t >= back(v0)) & (t < back(v1)), "val").when((t >= back(v0 + gap + train)) & (t < back(v0 + gap)), "train")
    return df.crossJoin(F.broadcast(last)).withColumn("split", split).where("split IS NOT NULL").drop("__last")


def split_metadata(df: DataFrame, time: str = "open_time") -> DataFrame:
    return df.groupBy("split").agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(F.lit(1)).alias("n_rows"))


def assert_split_rows(df: DataFrame, least: int, splits: tuple[str, ...] = ("train", "val", "test")) -> None:
    """Raises when a split has fewer rows."""
    have = {r["split"]: r["n_rows"] for r in split_metadata(df).collect()}
    if short := [s for s in splits if have.get(s, 0) < least]:
        raise ValueError(f"fewer than {least} rows in {', '.join(short)}")


def decay_weights(df: DataFrame, days: float, time: str = "open_time") -> DataFrame:
    """Adds weight: exp(-age / days), by age from the newest row."""
    last = df.agg(F.max(time).alias("__last"))
    age = F.unix_micros("__last") / 1e6 - F.unix_micros(time) / 1e6
    return df.crossJoin(F.broadcast(last)).withColumn("weight", F.exp(-age / (86400.0 * days))).drop("__last")


def balanced_class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Multiplies weight by n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    total = counts.agg(F.sum("__c").alias("__n"), F.count(F.lit(1)).alias("__k"))
    own = F.col("__n") / (F.col("__k") * F.col("__c"))
    base = col(weight) if weight in df.columns else F.lit(1.0)
    # A label has a few classes; the counts are broadcast when Spark finds them small.
    return df.join(counts, label).crossJoin(F.broadcast(total)).withColumn("class_weight", own * base).drop("__c", "__n", "__k")


def ordered_split(df: DataFrame, frac: float = 0.8, time: str = "open_time") -> DataFrame:
    """Adds split: train for the first share of rows by time, test for the rest.

    Ranks go by day on top of the counts of the days before, so that no task holds all rows.
    """
    from pyspark.sql import Window

    df = df.withColumn("__day", F.to_date(time))
    days = df.groupBy("__day").agg(F.count(F.lit(1)).alias("__c"))
    whole = Window.orderBy("__day")
    days = days.select("__day", (F.sum("__c").over(whole) - F.col("__c")).alias("__before"), F.sum("__c").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__all"))
    rank = F.col("__before") + F.row_number().over(Window.partitionBy("__day").orderBy(time, "symbol"))
    return df.join(days, "__day").withColumn("split", F.when(rank <= F.floor(F.col("__all") * frac), "train").otherwise("test")).drop("__day", "__before", "__all")
