"""Schemas of the layers. Column order and nullability don't matter to the check in ``io.align_to_schema``."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (x.split(":") for x in text.split())])


_TYPES = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType(), "D": T.DateType(), "t": T.TimestampType()}

RAW = _schema("symbol:s open_time:l close_time:l open:d high:d low:d close:d volume:d quote_volume:d trades:i taker_buy_base:d taker_buy_quote:d")
BRONZE = _schema("symbol:s open_time:t close_time:t open:d high:d low:d close:d volume:d quote_volume:d trades:i taker_buy_base:d taker_buy_quote:d date:D source:s ingestion_time:t")
SILVER = _schema("symbol:s open_time:t open:d high:d low:d close:d volume:d quote_volume:d trades:i taker_buy_base:d taker_buy_quote:d date:D ingestion_time:t")
PREDICTIONS = _schema("open_time:t symbol:s date:D return_short:d return_long:d sign_short:i sign_long:i prediction:d ingestion_time:t")
SILVER_COLUMNS = [f.name for f in SILVER if f.name != "ingestion_time"]

#: Columns that gold_features adds, by group.
GOLD_GROUPS = {
    "base": ["hl_range", "vwap_proxy", "log_return_raw"],
    "returns": ["log_return_lag1", "return_5", "return_acceleration", "return_zscore", "smoothed_return_3", "return_1d", "return_3d"],
    "volatility": ["volatility", "volatility_5", "volatility_std_10", "volatility_1d", "volatility_3d", "volatility_ratio", "volatility_regime"],
    "microstructure": ["imbalance_ratio", "buy_ratio", "imbalance_change", "imbalance_momentum", "buy_pressure_change"],
    "price_position": ["price_to_ma_5", "price_to_ma_20", "ma_cross_5_20", "momentum_ratio"],
    "volume": ["volume_spike", "volume_ratio", "volume_trend", "trades_ratio"],
    "candle_shape": ["body_size", "close_position", "range_ratio"],
    "time": ["hour_sin", "hour_cos", "hour", "day_of_week"],
    "validity": ["is_valid_feature_row"],
    "legacy": ["log_return", "log_return_lag2", "buy_ratio_lag1", "ma_5", "ma_20", "volume_5", "buy_ratio_5", "momentum", "price_range_ratio", "trend_strength"],
}
