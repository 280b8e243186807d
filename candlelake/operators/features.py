"""Window features per candle.

All frames share one window, partitioned by symbol and ordered by the column ``__t``, time in seconds, so a plan has one
exchange and one sort for all of them. Groups can be used one by one; ``gold_features`` builds them one after the other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions.columns import PI, epoch_seconds, ordered, safe_divide
from candlelake.functions.stretches import STRETCH, with_ewm, with_row_frames
from candlelake.operators.clean import fill_gold
from candlelake.sources.schemas import GOLD_GROUPS

DAY = 86400
#: Frames in days reach that many seconds back, whatever the interval is.
DAYS = {"1d": DAY, "3d": 3 * DAY}


class _Frames:
    """The frames of a feature table: w(n) are the last n candles' time, days(k) the last k days."""

    def __init__(self, interval_s: int):
        self.interval_s, self.row = interval_s, ordered("symbol", "__t")

    def w(self, n: int):
        return self.row.rangeBetween(-(n - 1) * self.interval_s, 0)

    def days(self, name: str):
        return self.row.rangeBetween(-DAYS[name], 0)

    def lag(self, c: Column | str, n: int = 1) -> Column:
        return F.lag(c, n).over(self.row)


def _return(close: Column, before: Column) -> Column:
    return F.when((close > 0) & (before > 0), F.ln(close / before)).otherwise(0.0)


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("__t", epoch_seconds("open_time"))


def _with_return(df: DataFrame, f: _Frames) -> DataFrame:
    """__r, the log return from the candle before; 0.0 for the first."""
    return df if "__r" in df.columns else df.withColumn("__r", _return(F.col("close"), f.lag("close")))


def _finish(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _base(df: DataFrame, f: _Frames) -> DataFrame:
    df = _with_return(df, f)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return df.withColumns({"hl_range": F.try_divide(F.col("high") - F.col("low"), F.col("close")), "vwap_proxy": F.try_divide(F.col("close"), typical) - 1, "log_return_raw": F.col("__r")})


def _returns(df: DataFrame, f: _Frames) -> DataFrame:
    df, r, w20 = _with_return(df, f), F.col("__r"), f.w(20)
    return df.withColumns({
        "log_return_lag1": f.lag("__r"), "return_5": F.sum(r).over(f.w(5)), "return_acceleration": r - f.lag("__r"),
        "return_zscore": safe_divide(r - F.avg(r).over(w20), F.stddev(r).over(w20)), "smoothed_return_3": F.avg(r).over(f.w(3)),
        "return_1d": F.sum(r).over(f.days("1d")), "return_3d": F.sum(r).over(f.days("3d")),
    })


def _volatility(df: DataFrame, f: _Frames) -> DataFrame:
    df = _with_return(df, f).withColumn("volatility", safe_divide(F.col("high") - F.col("low"), "close"))
    r = F.col("__r")
    df = df.withColumns({"volatility_5": F.avg("volatility").over(f.w(5)), "volatility_std_10": F.stddev(r).over(f.w(10)), "volatility_1d": F.stddev(r).over(f.days("1d")), "volatility_3d": F.stddev(r).over(f.days("3d"))})
    return df.withColumns({"volatility_ratio": safe_divide("volatility", "volatility_5"), "volatility_regime": safe_divide("volatility_5", F.avg("volatility_5").over(f.w(20)))})


def _microstructure(df: DataFrame, f: _Frames) -> DataFrame:
    taken, volume = F.col("taker_buy_base"), F.col("volume")
    df = df.withColumns({"imbalance_ratio": safe_divide(taken - (volume - taken), volume), "buy_ratio": safe_divide(taken, volume)})
    x = F.col("imbalance_ratio")
    return df.withColumns({"imbalance_change": x - f.lag(x), "imbalance_momentum": x - f.lag(x, 3), "buy_pressure_change": F.col("buy_ratio") - F.avg("buy_ratio").over(f.w(5))})


def _price_position(df: DataFrame, f: _Frames) -> DataFrame:
    df = df.withColumns({"__ma5": F.avg("close").over(f.w(5)), "__ma20": F.avg("close").over(f.w(20))})
    return df.withColumns({"price_to_ma_5": safe_divide("close", "__ma5") - 1, "price_to_ma_20": safe_divide("close", "__ma20") - 1, "ma_cross_5_20": safe_divide("__ma5", "__ma20") - 1, "momentum_ratio": safe_divide("close", "__ma5")})


def _volume(df: DataFrame, f: _Frames) -> DataFrame:
    df = df.withColumns({"__v5": F.avg("volume").over(f.w(5)), "__v20": F.avg("volume").over(f.w(20)), "__t20": F.avg("trades").over(f.w(20))})
    spike = safe_divide("volume", "__v20")
    return df.withColumns({"volume_spike": spike, "volume_ratio": spike, "volume_trend": safe_divide("__v5", "__v20"), "trades_ratio": safe_divide("trades", "__t20")})


def _candle_shape(df: DataFrame, f: _Frames) -> DataFrame:
    df = df if "hl_range" in df.columns else df.withColumn("__hl", F.try_divide(F.col("high") - F.col("low"), F.col("close")))
    hl = "hl_range" if "hl_range" in df.columns else "__hl"
    return df.withColumns({"body_size": safe_divide(F.col("close") - F.col("open"), "close"), "close_position": safe_divide(F.col("close") - F.col("low"), F.col("high") - F.col("low")), "range_ratio": safe_divide(hl, F.avg(hl).over(f.w(20)))})


def _time(df: DataFrame, f: _Frames) -> DataFrame:
    angle = F.lit(2 * PI) * F.hour("open_time") / 24
    return df.withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle), "date": F.to_date("open_time"), "hour": F.hour("open_time"), "day_of_week": F.dayofweek("open_time")})


def _validity(df: DataFrame, f: _Frames) -> DataFrame:
    """False for the first row of a symbol, and where inputs are null."""
    need = ("log_return_lag1", "return_5", "range_ratio")
    if any(c not in df.columns for c in need):
        have = df.columns
        full = _candle_shape(_returns(df, f), f)
        return full.withColumn("is_valid_feature_row", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in need])).select(*have, "is_valid_feature_row")
    return df.withColumn("is_valid_feature_row", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in need]))


def _legacy(df: DataFrame, f: _Frames) -> DataFrame:
    """Columns of older tables; they follow the zero fill, so their lags stay null."""
    df = _with_return(df, f)
    df = df if "buy_ratio" in df.columns else df.withColumn("__b", safe_divide("taker_buy_base", "volume"))
    buy = "buy_ratio" if "buy_ratio" in df.columns else "__b"
    w5, r = f.w(5), F.col("__r")
    return df.withColumns({
        "log_return": r, "log_return_lag2": f.lag("__r", 2), "buy_ratio_lag1": f.lag(buy), "ma_5": F.avg("close").over(w5), "ma_20": F.avg("close").over(f.w(20)),
        "volume_5": F.avg("volume").over(w5), "buy_ratio_5": F.avg(buy).over(w5), "momentum": F.col("close") - f.lag("close", 5),
        "price_range_ratio": safe_divide(F.col("high") - F.col("low"), "open"), "trend_strength": safe_divide(F.sum(r).over(w5), F.sum(F.abs(r)).over(w5)),
    })


_GROUPS = {"base": _base, "returns": _returns, "volatility": _volatility, "microstructure": _microstructure, "price_position": _price_position, "volume": _volume, "candle_shape": _candle_shape, "time": _time, "validity": _validity, "legacy": _legacy}


def feature_group(name: str):
    """The operator (df, interval_s) -> df that adds one group of features."""
    def add(df: DataFrame, interval_s: int) -> DataFrame:
        return _finish(_GROUPS[name](_timed(df), _Frames(interval_s)))

    add.__name__ = f"feat_{name}"
    add.__doc__ = f"Adds {', '.join(GOLD_GROUPS[name])}."
    return add


feat_base, feat_returns, feat_volatility, feat_microstructure, feat_price_position, feat_volume, feat_candle_shape, feat_time, feat_validity, feat_legacy = map(feature_group, _GROUPS)


def gold_features(df: DataFrame, interval_s: int) -> DataFrame:
    """All groups; nulls and infinities become 0 between the validity flag and the legacy columns."""
    f, df = _Frames(interval_s), _timed(df)
    for name in _GROUPS:
        if name == "legacy":
            df = fill_gold(df, keep=("__t",))
        df = _GROUPS[name](df, f)
    return _finish(df)


def reach_seconds(interval_s: int) -> int:
    """How far back a row's features reach: three days, or a frame of 20 candles over one of 5."""
    return max(DAYS["3d"], 23 * interval_s)


def feat_row_windows(df: DataFrame, stretch_s: int = STRETCH) -> DataFrame:
    """Exploration features over frames of rows: 6 and 21 rows, unscaled volatility, the next return as target."""

    def framed(row: WindowSpec) -> dict[str, Column]:
        w5, r = row.rowsBetween(-5, 0), "log_return"
        means = {"ma_5": F.avg("close").over(w5), "ma_20": F.avg("close").over(row.rowsBetween(-20, 0)), "volume_5": F.avg("volume").over(w5), "volatility_5": F.avg("volatility").over(w5)}
        return means | {"log_return_lag1": F.lag(r, 1).over(row), "log_return_lag2": F.lag(r, 2).over(row), "target": F.lead(r, 1).over(row)}

    df = df.withColumns({"log_return": F.when((F.col("close") > 0) & (F.col("open") > 0), F.ln(F.col("close") / F.col("open"))), "volatility": F.col("high") - F.col("low")})
    df = with_row_frames(df, framed, before=20, after=1, stretch_s=stretch_s)
    return df.withColumns({"momentum": F.col("close") - F.col("ma_5"), "trend_strength": F.col("ma_5") - F.col("ma_20"), "volume_spike": safe_divide("volume", "volume_5")})


def trade_imbalance(trades: DataFrame, span: int = 10, roll: int = 20, stretch_s: int = STRETCH) -> DataFrame:
    """Per minute and symbol: bought and sold volume, imbalance, its exponential mean, rolling deviation and z-score."""
    side = lambda seller: F.coalesce(F.sum(F.when(F.col("is_buyer_maker") == seller, F.col("qty"))), F.lit(0.0))
    minutes = trades.groupBy("symbol", F.date_trunc("minute", "timestamp").alias("minute")).agg(side(False).alias("buy_volume"), side(True).alias("sell_volume"))
    bought, sold, x = F.col("buy_volume"), F.col("sell_volume"), "imbalance"
    out = with_ewm(minutes.withColumn(x, (bought - sold) / (bought + sold + 1e-9)), x, span, "imbalance_ewm", "symbol", "minute", stretch_s)

    def framed(row: WindowSpec) -> dict[str, Column]:
        frame = row.rowsBetween(-(roll - 1), 0)
        full = F.count(x).over(frame) >= roll
        return {"imbalance_std": F.when(full, F.stddev(x).over(frame)), "__mean": F.when(full, F.avg(x).over(frame))}

    out = with_row_frames(out, framed, before=roll - 1, by="symbol", time="minute", stretch_s=stretch_s)
    return out.withColumn("imbalance_z", F.try_divide(F.col(x) - F.col("__mean"), F.col("imbalance_std"))).drop("__mean")


def open_interest_features(df: DataFrame, roll: int = 50, stretch_s: int = STRETCH) -> DataFrame:
    """Change of open interest, its z-score over the last ``roll`` rows, change of the taker ratio."""
    x, ratio = F.col("sum_open_interest"), F.col("sum_taker_long_short_vol_ratio")

    def framed(row: WindowSpec) -> dict[str, Column]:
        frame = row.rowsBetween(-(roll - 1), 0)
        full = F.count(x).over(frame) >= roll
        return {"oi_delta": x - F.lag(x).over(row), "oi_zscore": F.when(full, F.try_divide(x - F.avg(x).over(frame), F.stddev(x).over(frame))), "ratio_delta": ratio - F.lag(ratio).over(row)}

    return with_row_frames(df, framed, before=max(roll - 1, 1), by="symbol", time="timestamp", stretch_s=stretch_s)
