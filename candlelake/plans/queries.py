"""Every operator as a registered query over the driver's tables, with DuckDB SQL where SQL can express it.

Queries take (spark, sf_dir). Doubles are rounded to six decimals and dates are
text on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlelake.functions.columns import normalize_epoch
from candlelake.operators import aggs, clean, drift, evaluate, features, joins, labels, ml, reads
from candlelake.plans import medallion
from candlelake.plans.halo import gold_features_by_stretch, with_halo
from candlelake.sources import fixtures, io, schemas
from candlelake.streaming import candles as streams

HOUR, DAY = fixtures.HOUR, fixtures.DAY
#: Stretches so short that the fixture has several of each symbol.
STRETCH = 4 * DAY
CUT = dt.datetime(2024, 1, 16)
SYMBOLS = ["click", "error", "purchase", "signup", "view"]
FEATURES = ["return_5", "volatility_5", "imbalance_ratio", "volume_ratio", "range_ratio"]
PLACEHOLDER = "2024-02-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Fixture tables and what most operators start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(fixtures, name)(self.spark, self.sf_dir)

    @cached_property
    def bronze(self) -> DataFrame:
        return clean.bronze_candles(self.raw_candles)

    @cached_property
    def silver(self) -> DataFrame:
        return clean.silver_candles(self.candles_h)

    @cached_property
    def gold(self) -> DataFrame:
        return features.gold_features(self.silver, HOUR)

    @cached_property
    def written_gold(self) -> DataFrame:
        """Gold as a table, as it is where drift is measured."""
        return self.kept(self.gold)

    def kept(self, df: DataFrame) -> DataFrame:
        """df as a table that has been written."""
        path = self.scratch()
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def aligned(self) -> DataFrame:
        return joins.align_predictions(self.predictions_in, self.candles_h, stretch_s=STRETCH)

    @cached_property
    def priced(self) -> DataFrame:
        return joins.predicted_close(self.predictions_in, self.candles_h)

    @cached_property
    def filled(self) -> DataFrame:
        return joins.fill_actuals(self.priced, self.candles_h, STRETCH)

    @cached_property
    def pairs(self) -> DataFrame:
        return joins.sentiment_returns(self.sentiment_gold, self.gold)

    @cached_property
    def report(self) -> DataFrame:
        gold = self.written_gold
        data = drift.data_drift(gold.where(F.col("open_time") < F.lit(CUT)), gold.where(F.col("open_time") >= F.lit(CUT)), FEATURES, drift.DriftConfig(0.2, 50))
        p = self.predictions_in
        model = drift.model_drift(p.where(F.col("open_time") >= F.lit(CUT)), p.where(F.col("open_time") < F.lit(CUT)), ["return_short", "return_long"], drift.DriftConfig(0.2, 50))
        return drift.drift_report(data, model, drift.DriftConfig(0.2))

    @cached_property
    def history(self) -> DataFrame:
        return drift.drift_history(self.report, drift.retrain_decision(self.report, None, 60, dt.datetime(2024, 2, 1)))

    def scratch(self) -> str:
        """A new folder that all executors share; a session in one process may go without spark.checkpoint.dir."""
        base = self.spark.conf.get("spark.checkpoint.dir", None)
        if not base and not self.spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return f"{(base or '/tmp/candlelake-scratch').rstrip('/')}/candlelake-{uuid.uuid4().hex}"


def rounded(df: DataFrame) -> DataFrame:
    plain = lambda n, t: (F.round(F.col(f"`{n}`"), 6) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`").cast("string").alias(n) if t == "date" else F.col(f"`{n}`")
    return df.select(*[plain(n, t) for n, t in df.dtypes])


def query(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None, doubles: str = "", exact: bool = False) -> None:
    """``exact`` leaves doubles as they are, for values that are taken over rather than computed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        out = build(Tables(spark, sf_dir))
        return out if exact else rounded(out)

    run.__name__ = name
    QUERIES[name] = run
    if sql:
        ORACLES[name] = oracle(sql, doubles)


# --- SQL of the fixture views and of what is built on them ---------------------------------------------------------


def sd(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) IS NULL OR abs({den}) < 1e-6 THEN 0.0 ELSE ({num}) / ({den}) END)"


def frame(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL {(n - 1) * HOUR} SECONDS PRECEDING AND CURRENT ROW)"


def days(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL {n * DAY} SECONDS PRECEDING AND CURRENT ROW)"


ROW = "(PARTITION BY symbol ORDER BY open_time)"
RUN = "(PARTITION BY symbol ORDER BY open_time ROWS UNBOUNDED PRECEDING)"

CTES = dict(fixtures.SQL)
CTES["bronze"] = """SELECT symbol, to_timestamp(floor(open_time / f)::BIGINT)::TIMESTAMP AT TIME ZONE 'UTC' AS open_time, close_time, open, high, low, close, volume, quote_volume, trades, taker_buy_base, taker_buy_quote
    FROM (SELECT *, CASE WHEN open_time > 1000000000000000 THEN 1000000 ELSE 1000 END AS f FROM raw_candles)"""
CTES["silver"] = """SELECT * FROM candles_h WHERE open BETWEEN low AND high AND close BETWEEN low AND high AND volume >= 0 AND quote_volume >= 0 AND trades >= 0 AND taker_buy_base >= 0 AND taker_buy_quote >= 0"""
CTES["g1"] = f"""SELECT *, CASE WHEN close > 0 AND lag(close) OVER {ROW} > 0 THEN ln(close / lag(close) OVER {ROW}) ELSE 0.0 END AS r,
    (high - low) / close AS hl_range, close / ((high + low + close) / 3) - 1 AS vwap_proxy, {sd("high - low", "close")} AS volatility,
    {sd("taker_buy_base - (volume - taker_buy_base)", "volume")} AS imbalance_ratio, {sd("taker_buy_base", "volume")} AS buy_ratio FROM silver"""
CTES["g2"] = f"""SELECT *, r AS log_return_raw, lag(r) OVER {ROW} AS log_return_lag1, sum(r) OVER {frame(5)} AS return_5, r - lag(r) OVER {ROW} AS return_acceleration,
    {sd(f"r - avg(r) OVER {frame(20)}", f"stddev_samp(r) OVER {frame(20)}")} AS return_zscore, avg(r) OVER {frame(3)} AS smoothed_return_3, sum(r) OVER {days(1)} AS return_1d, sum(r) OVER {days(3)} AS return_3d,
    avg(volatility) OVER {frame(5)} AS volatility_5, stddev_samp(r) OVER {frame(10)} AS volatility_std_10, stddev_samp(r) OVER {days(1)} AS volatility_1d, stddev_samp(r) OVER {days(3)} AS volatility_3d,
    imbalance_ratio - lag(imbalance_ratio) OVER {ROW} AS imbalance_change, imbalance_ratio - lag(imbalance_ratio, 3) OVER {ROW} AS imbalance_momentum, buy_ratio - avg(buy_ratio) OVER {frame(5)} AS buy_pressure_change,
    avg(close) OVER {frame(5)} AS ma_5, avg(close) OVER {frame(20)} AS ma_20, avg(volume) OVER {frame(5)} AS volume_5, avg(volume) OVER {frame(20)} AS v20, avg(trades) OVER {frame(20)} AS t20,
    avg(hl_range) OVER {frame(20)} AS hl20, avg(buy_ratio) OVER {frame(5)} AS buy_ratio_5 FROM g1"""
CTES["g3"] = f"""SELECT *, {sd("volatility", "volatility_5")} AS volatility_ratio, {sd("volatility_5", f"avg(volatility_5) OVER {frame(20)}")} AS volatility_regime,
    {sd("close", "ma_5")} - 1 AS price_to_ma_5, {sd("close", "ma_20")} - 1 AS price_to_ma_20, {sd("ma_5", "ma_20")} - 1 AS ma_cross_5_20, {sd("close", "ma_5")} AS momentum_ratio,
    {sd("volume", "v20")} AS volume_spike, {sd("volume", "v20")} AS volume_ratio, {sd("volume_5", "v20")} AS volume_trend, {sd("trades", "t20")} AS trades_ratio,
    {sd("close - open", "close")} AS body_size, {sd("close - low", "high - low")} AS close_position, {sd("hl_range", "hl20")} AS range_ratio,
    sin(2 * 3.1415926535 * hour(open_time) / 24) AS hour_sin, cos(2 * 3.1415926535 * hour(open_time) / 24) AS hour_cos, CAST(hour(open_time) AS INT) AS hour, CAST(dayofweek(open_time) + 1 AS INT) AS day_of_week,
    log_return_lag1 IS NOT NULL AND return_5 IS NOT NULL AND hl20 IS NOT NULL AS is_valid_feature_row,
    r AS log_return, lag(r, 2) OVER {ROW} AS log_return_lag2, lag(buy_ratio) OVER {ROW} AS buy_ratio_lag1, close - lag(close, 5) OVER {ROW} AS momentum,
    {sd("high - low", "open")} AS price_range_ratio, {sd(f"sum(r) OVER {frame(5)}", f"sum(abs(r)) OVER {frame(5)}")} AS trend_strength FROM g2"""
_ZERO = "log_return_lag1 return_acceleration volatility_std_10 volatility_1d volatility_3d imbalance_change imbalance_momentum".split()
CTES["gold"] = f"SELECT * EXCLUDE (r, v20, t20, hl20) REPLACE ({', '.join(f'coalesce({c}, 0.0) AS {c}' for c in _ZERO)}) FROM g3"
CTES["outcomes"] = f"""SELECT symbol, open_time, close, lead(close) OVER {ROW} AS actual_close, CASE WHEN close > 0 AND lead(close) OVER {ROW} > 0 THEN ln(lead(close) OVER {ROW} / close) END AS actual_log_return_lead1 FROM candles_h"""
CTES["aligned"] = """SELECT p.*, o.close, o.actual_close, o.actual_log_return_lead1, o.close * exp(coalesce(prediction, 0)) AS predicted_close, o.actual_log_return_lead1 - prediction AS residual,
    abs(o.actual_log_return_lead1 - prediction) AS abs_error, CASE WHEN sign(o.actual_log_return_lead1) <> 0 THEN sign(prediction) = sign(o.actual_log_return_lead1) END AS direction_correct
    FROM predictions_in p LEFT JOIN outcomes o USING (symbol, open_time)"""
CTES["priced"] = "SELECT p.*, CASE WHEN c.close <> 0 THEN c.close * exp(prediction) END AS predicted_close FROM predictions_in p LEFT JOIN candles_h c USING (symbol, open_time)"
CTES["filled"] = f"""SELECT p.*, CASE WHEN b IS NOT NULL THEN c END AS actual_close, CASE WHEN b IS NOT NULL THEN c - predicted_close END AS error, CASE WHEN b IS NOT NULL THEN (predicted_close > b) = (c > b) END AS direction_correct
    FROM priced p LEFT JOIN (SELECT symbol, open_time, close AS c, lag(close) OVER {ROW} AS b FROM candles_h) k USING (symbol, open_time)"""
CTES["pairs"] = "SELECT s.symbol, s.window_start AS open_time, sentiment_index, log_return FROM sentiment_gold s JOIN gold g ON s.symbol = g.symbol AND s.window_start = g.open_time WHERE sentiment_index IS NOT NULL AND is_valid_feature_row AND log_return IS NOT NULL"


def oracle(sql: str, doubles: str = "") -> str:
    """The query with the views that it needs in front, and its doubles rounded."""
    import re

    need: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", text) and name not in need:
                add(CTES[name])
                need.append(name)

    add(sql)
    plain = lambda c: "CAST(date AS VARCHAR) AS date" if c == "date" else f"round({c}, 6) + 0.0 AS {c}"
    body = f"SELECT * REPLACE ({', '.join(map(plain, doubles.split()))}) FROM ({sql})" if doubles else sql
    return f"WITH {', '.join(f'{n} AS ({CTES[n]})' for n in need)} {body}" if need else body


# --- Sources, sinks, state ------------------------------------------------------------------------------------------

RAW_COLUMNS = "symbol, open_time, close_time, open, high, low, close, volume, quote_volume, trades, taker_buy_base, taker_buy_quote"
RAW_DOUBLES = "open high low close volume quote_volume taker_buy_base taker_buy_quote"


def _csv(t: Tables) -> DataFrame:
    path = t.scratch()
    t.raw_candles.write.option("header", True).csv(path)
    return io.scan_candle_csv(t.spark, path)


def _written(t: Tables) -> DataFrame:
    path = t.scratch()
    io.write_partitioned(io.add_ingestion_time(t.candles_h), path, schemas.SILVER, "overwrite")
    return io.read_table(t.spark, path, schemas.SILVER_COLUMNS).withColumn("date", F.col("date").cast("date"))


def _changed(t: Tables) -> DataFrame:
    """Some rows of another version, and some of new keys."""
    c = t.candles_h.where("trades % 3 = 0")
    return c.withColumns({"close": F.col("close") + 1, "open_time": F.when(F.col("trades") % 2 == 0, F.col("open_time")).otherwise(F.col("open_time") + F.expr("INTERVAL 60 DAYS"))})


_CHANGED = "SELECT * REPLACE (close + 1 AS close, CASE WHEN trades % 2 = 0 THEN open_time ELSE open_time + INTERVAL 60 DAYS END AS open_time) FROM candles_h WHERE trades % 3 = 0"
CANDLE_DOUBLES = RAW_DOUBLES + " date"

query("scan_candle_csv", _csv, f"SELECT {RAW_COLUMNS} FROM raw_candles", RAW_DOUBLES)
_PARSED = "SELECT symbol, epoch_ms(open_time) AS open_time, epoch_ms(open_time) + 3599999 AS close_time, open, high, low, close, volume, quote_volume, trades, taker_buy_base, taker_buy_quote FROM candles_h"
query("parse_kline_arrays", lambda t: io.parse_kline_arrays(t.kline_arrays), _PARSED, RAW_DOUBLES)
query("parse_kline_events", lambda t: io.parse_kline_events(t.kline_events), _PARSED + " WHERE hour(open_time) % 5 <> 0 AND hour(open_time) % 11 <> 0 AND hour(open_time) <> 13", RAW_DOUBLES)
query("parse_topic_values", lambda t: io.parse_topic_values(t.topic_messages, schemas.RAW), f"SELECT {RAW_COLUMNS} FROM raw_candles", RAW_DOUBLES)
query("encode_topic_values", lambda t: io.parse_topic_values(io.encode_topic_values(t.raw_candles.withColumn("ignore", F.lit(0)), ["symbol"]), schemas.RAW), f"SELECT {RAW_COLUMNS} FROM raw_candles", RAW_DOUBLES)
query("read_table", lambda t: io.read_table(t.spark, f"{t.sf_dir}/events.parquet", ["event_id", "value"], "value > 50"), "SELECT event_id, value FROM events WHERE value > 50", "value")
query("read_range", lambda t: io.read_range(t.candles_h, ["open_time", "close", "missing"], "click", dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 9, 18)), "SELECT open_time, close FROM candles_h WHERE symbol = 'click' AND open_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-09 18:00:00'", "close")
query("read_incremental", lambda t: io.read_incremental(t.candles_h, dt.datetime(2024, 1, 20, 12), ["click", "view"]).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM candles_h WHERE open_time > TIMESTAMP '2024-01-20 12:00:00' AND symbol IN ('click', 'view')", "close")
query("read_incremental_by_key", lambda t: io.read_incremental_by_key(t.candles_h, t.marks, "30 MINUTES").select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM candles_h JOIN marks USING (symbol) WHERE open_time > last_processed_time - INTERVAL 30 MINUTES", "close")


def _by_day(t: Tables) -> str:
    path = t.scratch()
    io.write_partitioned(t.candles_h, path)
    return path


query("read_latest_partition", lambda t: io.read_latest_partition(_by_day(t), spark=t.spark).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM candles_h WHERE date = (SELECT max(date) FROM candles_h)", "close")
query("last_value", lambda t: io.last_value(t.candles_h), "SELECT max(open_time) AS last_value FROM candles_h")
query("last_processed_by_symbol", lambda t: io.last_processed_by_symbol(t.marks, SYMBOLS, dt.datetime(2023, 12, 31)), "SELECT s.symbol, coalesce(last_processed_time, TIMESTAMP '2023-12-31') AS last_processed_time FROM (SELECT DISTINCT symbol FROM candles_h) s LEFT JOIN marks m ON s.symbol = m.symbol")
query("advance_state", lambda t: io.advance_state(t.marks, t.candles_h.where("date < date'2024-01-22'")), "SELECT symbol, max(x) AS last_processed_time FROM (SELECT symbol, last_processed_time AS x FROM marks UNION ALL SELECT symbol, open_time FROM candles_h WHERE date < DATE '2024-01-22') GROUP BY symbol")
query("max_offsets", lambda t: io.max_offsets(t.topic_messages), "SELECT 'prices' AS topic, CAST(trades % 3 AS INT) AS partition, count(*) - 1 AS offset FROM raw_candles GROUP BY trades % 3")
query("resume_offsets", lambda t: io.resume_offsets(t.topic_messages, io.max_offsets(t.topic_messages).where("partition < 2")), "SELECT 'prices' AS topic, CAST(trades % 3 AS INT) AS partition, CASE WHEN trades % 3 < 2 THEN count(*) ELSE -2 END AS offset FROM raw_candles GROUP BY trades % 3")
query("align_to_schema", lambda t: io.align_to_schema(io.add_ingestion_time(t.candles_h), schemas.SILVER, io.PARTITIONS).drop("ingestion_time"), f"SELECT {', '.join(schemas.SILVER_COLUMNS)} FROM candles_h", CANDLE_DOUBLES)
query("add_ingestion_time", lambda t: io.add_ingestion_time(t.candles_h).select("symbol", "open_time", F.col("ingestion_time").isNotNull().alias("stamped")), "SELECT symbol, open_time, true AS stamped FROM candles_h")
query("write_partitioned", _written, f"SELECT {', '.join(schemas.SILVER_COLUMNS)} FROM candles_h", CANDLE_DOUBLES)
query("upsert", lambda t: io.upsert(t.candles_h, _changed(t)).select("symbol", "open_time", "close"), f"SELECT symbol, open_time, close FROM candles_h c WHERE NOT EXISTS (SELECT 1 FROM ({_CHANGED}) x WHERE x.symbol = c.symbol AND x.open_time = c.open_time) UNION ALL SELECT symbol, open_time, close FROM ({_CHANGED})", "close")
query("insert_ignore", lambda t: io.insert_ignore(t.candles_h, _changed(t)).select("symbol", "open_time", "close"), f"SELECT symbol, open_time, close FROM candles_h UNION ALL SELECT symbol, open_time, close FROM ({_CHANGED}) x WHERE NOT EXISTS (SELECT 1 FROM candles_h c WHERE x.symbol = c.symbol AND x.open_time = c.open_time)", "close")
_VERSIONS = "SELECT symbol, date, open_time, close FROM candles_h"
query("snapshot_as_of", lambda t: io.snapshot_as_of(t.candles_h.select("symbol", "date", "open_time", "close"), dt.datetime(2024, 1, 15, 12), ("symbol", "date"), "open_time"), f"SELECT symbol, date, max(open_time) AS open_time, arg_max(close, open_time) AS close FROM ({_VERSIONS}) WHERE open_time <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY symbol, date", "close date")
query("training_snapshot", lambda t: io.training_snapshot(t.gold.withColumn("constant", F.lit(1.0)), ["symbol", "open_time", "return_5", "momentum", "constant", "absent"], t.scratch()), "SELECT symbol, open_time, return_5, coalesce(momentum, 0) AS momentum FROM gold", "return_5 momentum")

# --- Cleaning and quality ------------------------------------------------------------------------------------------

query("normalize_epoch", lambda t: t.raw_candles.select("symbol", F.col("open_time").alias("epoch"), normalize_epoch("open_time").alias("open_time")), "SELECT symbol, open_time AS epoch, make_timestamp((open_time // (CASE WHEN open_time > 1000000000000000 THEN 1000000 ELSE 1000 END))::BIGINT * 1000000) AS open_time FROM raw_candles")
query("to_utc_auto", lambda t: clean.to_utc_auto(t.candles_h.select("symbol", F.unix_millis("open_time").alias("open_time")), "open_time"), "SELECT symbol, open_time FROM candles_h")
query("bronze_candles", lambda t: t.bronze.select("symbol", "open_time", "close_time", "close", "date", "source"), "SELECT symbol, open_time, open_time + INTERVAL 3599 SECONDS AS close_time, close, date, 'batch' AS source FROM candles_h", "close date")
query("dedupe_latest", lambda t: clean.dedupe_latest(t.candles_h.select("symbol", "date", "open_time", "close"), ("symbol", "date"), [F.desc("open_time")]), f"SELECT symbol, date, max(open_time) AS open_time, arg_max(close, open_time) AS close FROM ({_VERSIONS}) GROUP BY symbol, date", "close date")
query("silver_candles", lambda t: clean.silver_candles(t.bronze), f"SELECT {', '.join(schemas.SILVER_COLUMNS)} FROM silver", CANDLE_DOUBLES)
_HOLES = lambda t: t.candles_h.withColumns({"close": F.when(F.col("trades") % 4 != 0, F.col("close")), "volume": F.when(F.col("trades") % 5 == 0, -F.col("volume")).otherwise(F.col("volume")), "symbol": F.when(F.hour("open_time") != 3, F.col("symbol"))})
CTES["holes"] = "SELECT * REPLACE (CASE WHEN trades % 4 <> 0 THEN close END AS close, CASE WHEN trades % 5 = 0 THEN -volume ELSE volume END AS volume, CASE WHEN hour(open_time) <> 3 THEN symbol END AS symbol) FROM candles_h"
query("drop_null_critical", lambda t: clean.drop_null_critical(_HOLES(t)).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM holes WHERE symbol IS NOT NULL AND close IS NOT NULL", "close")
query("valid_candle_rules", lambda t: clean.valid_candle_rules(_HOLES(t)).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM holes WHERE close BETWEEN low AND high AND volume >= 0", "close")
query("quality_report", lambda t: clean.quality_report(_HOLES(t)), "SELECT count(*) AS rows, count(*) - count(symbol) AS null_symbol, 0::BIGINT AS null_open_time, count(*) FILTER (WHERE volume < 0) AS negative_volume, concat_ws('; ', CASE WHEN count(*) > count(symbol) THEN 'null symbol' END, CASE WHEN count(*) FILTER (WHERE volume < 0) > 0 THEN 'negative volume' END) AS errors, count(*) = count(symbol) AND count(*) FILTER (WHERE volume < 0) = 0 AS is_valid FROM holes")
query("sanitize_features", lambda t: clean.sanitize_features(t.gold.select("symbol", "open_time", "momentum", F.lit(2.0).alias("constant"), F.when(F.col("trades") % 7 == 0, float("inf")).otherwise(F.col("close")).alias("close"))), "SELECT symbol, open_time, coalesce(momentum, 0) AS momentum, CASE WHEN trades % 7 = 0 THEN 0 ELSE close END AS close FROM gold", "momentum close")
query("fill_gold", lambda t: clean.fill_gold(t.gold.select("symbol", "open_time", "momentum", "log_return_lag2")), "SELECT symbol, open_time, coalesce(momentum, 0) AS momentum, coalesce(log_return_lag2, 0) AS log_return_lag2 FROM gold", "momentum log_return_lag2")
query("encode_symbol", lambda t: clean.encode_symbol(t.candles_h, ["view", "click"]).select("symbol", "open_time", "symbol_id"), "SELECT symbol, open_time, CASE symbol WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE -1 END AS symbol_id FROM candles_h")
query("align_features", lambda t: clean.align_features(t.candles_h, ["close", "absent", "open"]), "SELECT close, 0.0::DOUBLE AS absent, open FROM candles_h", "close absent open")
query("valid_feature_rows", lambda t: clean.valid_feature_rows(t.gold, ["momentum"]).select("symbol", "open_time", "momentum"), "SELECT symbol, open_time, momentum FROM gold WHERE is_valid_feature_row AND momentum IS NOT NULL", "momentum")
query("trailing_window", lambda t: clean.trailing_window(t.candles_h, 7).select("symbol", "open_time"), "SELECT symbol, open_time FROM candles_h WHERE open_time >= (SELECT max(open_time) FROM candles_h) - INTERVAL 7 DAYS")
query("relative_range", lambda t: clean.relative_range(t.candles_h, "2 weeks", dt.datetime(2024, 1, 25)).select("symbol", "open_time"), "SELECT symbol, open_time FROM candles_h WHERE open_time BETWEEN TIMESTAMP '2024-01-11' AND TIMESTAMP '2024-01-25'")
query("filter_model_version", lambda t: clean.filter_model_version(t.predictions_in, "v2").select("symbol", "open_time", "prediction"), "SELECT symbol, open_time, prediction FROM predictions_in WHERE model_version = 'v2'", "prediction")
query("model_versions", lambda t: clean.model_versions(t.predictions_in), "SELECT DISTINCT model_version FROM predictions_in")
query("input_checks", lambda t: clean.input_checks(t.gold.withColumn("sign", F.col("trades") % 5), ["momentum", "return_5"], "sign", "classification"), "SELECT count(*) AS rows, count(*) - count(momentum) AS null_features, 0::BIGINT AS nan_features, 0::BIGINT AS inf_features, 0::BIGINT AS null_target, count(*) FILTER (WHERE trades % 5 > 2) AS bad_labels FROM gold")

# --- Joins ----------------------------------------------------------------------------------------------------------

ALIGNED = "symbol open_time model_version actual_close actual_log_return_lead1 predicted_close residual abs_error direction_correct".split()
query("restrict_to_symbols", lambda t: joins.restrict_to_symbols(t.candles_h, t.marks).select("symbol", "open_time"), "SELECT symbol, open_time FROM candles_h WHERE symbol IN (SELECT symbol FROM marks)")
query("restrict_to_keys", lambda t: joins.restrict_to_keys(t.gold, t.predictions_in.where("model_version = 'v1'")).select("symbol", "open_time", "return_5"), "SELECT symbol, open_time, return_5 FROM gold JOIN predictions_in p USING (symbol, open_time) WHERE model_version = 'v1'", "return_5")
query("align_predictions", lambda t: t.aligned.select(*ALIGNED[:-1], F.col("direction_correct").cast("double").alias("direction_correct")), f"SELECT {', '.join(ALIGNED[:-1])}, CAST(CAST(direction_correct AS INT) AS DOUBLE) AS direction_correct FROM aligned", "actual_close actual_log_return_lead1 predicted_close residual abs_error")
query("predicted_close", lambda t: t.priced.select("symbol", "open_time", "predicted_close"), "SELECT symbol, open_time, predicted_close FROM priced", "predicted_close")
query("fill_actuals", lambda t: t.filled.select("symbol", "open_time", "actual_close", "error", F.col("direction_correct").cast("double").alias("direction_correct")), "SELECT symbol, open_time, actual_close, error, CAST(CAST(direction_correct AS INT) AS DOUBLE) AS direction_correct FROM filled", "actual_close error")
query("sentiment_returns", lambda t: t.pairs, "SELECT symbol, open_time, sentiment_index, log_return FROM pairs", "sentiment_index log_return")
query("sentiment_price_overlay", lambda t: joins.sentiment_price_overlay(t.sentiment_gold, t.candles_h), "SELECT symbol, window_start AS open_time, sentiment_index, close AS price FROM sentiment_gold JOIN candles_h c USING (symbol) WHERE window_start = c.open_time", "sentiment_index price")
query("rolling_stats_table", lambda t: joins.rolling_stats_table(t.candles_h.select("symbol", "open_time", "close"), t.gold), "SELECT c.symbol, c.open_time, c.close, g.log_return AS \"return\" FROM (SELECT * FROM candles_h ORDER BY open_time DESC, symbol LIMIT 20) c LEFT JOIN gold g ON c.symbol = g.symbol AND c.open_time = g.open_time", 'close "return"')
query("regime_join", lambda t: joins.regime_join(t.aligned, t.gold, "hour").select("symbol", "open_time", "regime", "abs_error"), "SELECT a.symbol, a.open_time, g.hour AS regime, a.abs_error FROM aligned a JOIN gold g ON a.symbol = g.symbol AND a.open_time = g.open_time", "abs_error")

# --- Features -------------------------------------------------------------------------------------------------------

for _group, _columns in schemas.GOLD_GROUPS.items():
    if _group == "legacy":
        _from, _doubles = "gold", _columns
    else:
        _from, _doubles = "g3", [c for c in _columns if c not in ("hour", "day_of_week", "is_valid_feature_row")]
    query(f"feat_{_group}", lambda t, g=_group, c=_columns: getattr(features, f"feat_{g}")(t.silver, HOUR).select("symbol", "open_time", *c), f"SELECT symbol, open_time, {', '.join(_columns)} FROM {_from}", " ".join(_doubles))
GOLD = [c for g in schemas.GOLD_GROUPS.values() for c in g]
GOLD_DOUBLES = " ".join(c for c in GOLD if c not in ("hour", "day_of_week", "is_valid_feature_row"))
query("gold_features", lambda t: t.gold.select("symbol", "open_time", *GOLD), f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold", GOLD_DOUBLES)
query("gold_features_by_stretch", lambda t: gold_features_by_stretch(t.silver, HOUR, 4 * DAY).select("symbol", "open_time", *GOLD), f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold", GOLD_DOUBLES)


def _gold_incremental(t: Tables) -> DataFrame:
    """A batch with a symbol that has no history, and the tail of the rows before."""
    new, silver = F.col("symbol") == "view", t.kept(t.silver)
    batch, history = silver.where((F.col("open_time") >= F.lit(CUT)) | new), silver.where((F.col("open_time") < F.lit(CUT)) & ~new)
    return medallion.gold_incremental(batch, t.kept(medallion.tail_of(history, HOUR)), HOUR)


def _gold_steps(t: Tables) -> DataFrame:
    """Two batches after a first one, each from the tail that the one before it left."""
    silver, bounds = t.kept(t.silver), [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)]
    first, second, third = (silver.where(x) for x in (F.col("open_time") < F.lit(bounds[0]), (F.col("open_time") >= F.lit(bounds[0])) & (F.col("open_time") < F.lit(bounds[1])), F.col("open_time") >= F.lit(bounds[1])))
    tail = t.kept(medallion.tail_of(first, HOUR))
    later = t.kept(medallion.advance_tail(tail, second, HOUR))
    return medallion.gold_incremental(second, tail, HOUR).unionByName(medallion.gold_incremental(third, later, HOUR))


query("gold_incremental", lambda t: _gold_incremental(t).select("symbol", "open_time", *GOLD), f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold WHERE open_time >= TIMESTAMP '{CUT}' OR symbol = 'view'", GOLD_DOUBLES)
query("gold_incremental_steps", lambda t: _gold_steps(t).select("symbol", "open_time", *GOLD), f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold WHERE open_time >= TIMESTAMP '2024-01-11'", GOLD_DOUBLES)
query("gold_with_history", lambda t: medallion.gold_with_history(t.silver.where(F.col("open_time") >= F.lit(CUT)), t.silver.where(F.col("open_time") < F.lit(CUT)), HOUR).select("symbol", "open_time", *GOLD), f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold WHERE open_time >= TIMESTAMP '{CUT}'", GOLD_DOUBLES)
_ROWS = "(PARTITION BY symbol ORDER BY open_time ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
query("feat_row_windows", lambda t: features.feat_row_windows(t.silver).select("symbol", "open_time", "log_return", "target", "ma_5", "ma_20", "momentum", "trend_strength", "volatility_5"),
      f"SELECT symbol, open_time, ln(close / open) AS log_return, lead(ln(close / open)) OVER {ROW} AS target, avg(close) OVER {_ROWS.format(5)} AS ma_5, avg(close) OVER {_ROWS.format(20)} AS ma_20, close - avg(close) OVER {_ROWS.format(5)} AS momentum, avg(close) OVER {_ROWS.format(5)} - avg(close) OVER {_ROWS.format(20)} AS trend_strength, avg(high - low) OVER {_ROWS.format(5)} AS volatility_5 FROM silver", "log_return target ma_5 ma_20 momentum trend_strength volatility_5")
_MINUTES = """SELECT symbol, date_trunc('minute', "timestamp") AS minute, coalesce(sum(qty) FILTER (WHERE NOT is_buyer_maker), 0) AS b, coalesce(sum(qty) FILTER (WHERE is_buyer_maker), 0) AS s FROM trades_in GROUP BY ALL"""
_LAST20 = "(PARTITION BY symbol ORDER BY minute ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
query("trade_imbalance", lambda t: features.trade_imbalance(t.trades_in).select("symbol", "minute", "buy_volume", "sell_volume", "imbalance", "imbalance_std", "imbalance_ewm"),
      f"""SELECT symbol, minute, b AS buy_volume, s AS sell_volume, x AS imbalance, CASE WHEN count(*) OVER {_LAST20} >= 20 THEN stddev_samp(x) OVER {_LAST20} END AS imbalance_std,
      list_sum(list_transform(l, lambda v, i: v * pow(9 / 11::DOUBLE, len(l) - i))) / list_sum(list_transform(l, lambda v, i: pow(9 / 11::DOUBLE, len(l) - i))) AS imbalance_ewm
      FROM (SELECT *, list(x) OVER (PARTITION BY symbol ORDER BY minute ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS l FROM (SELECT *, (b - s) / (b + s + 1e-9) AS x FROM ({_MINUTES})))""", "buy_volume sell_volume imbalance imbalance_std imbalance_ewm")  # fmt: skip
_LAST50 = """(PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"""
query("open_interest_features", lambda t: features.open_interest_features(t.oi_in).select("symbol", "timestamp", "oi_delta", "oi_zscore", "ratio_delta"),
      f"""SELECT symbol, "timestamp", sum_open_interest - lag(sum_open_interest) OVER w AS oi_delta, CASE WHEN count(*) OVER {_LAST50} >= 50 THEN (sum_open_interest - avg(sum_open_interest) OVER {_LAST50}) / stddev_samp(sum_open_interest) OVER {_LAST50} END AS oi_zscore,
      sum_taker_long_short_vol_ratio - lag(sum_taker_long_short_vol_ratio) OVER w AS ratio_delta FROM oi_in WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")""", "oi_delta oi_zscore ratio_delta")  # fmt: skip


def _halo(t: Tables) -> DataFrame:
    def sums(w):
        last = w.rangeBetween(-3 * DAY, 0)
        return {"volume_3d": F.sum("volume").over(last), "close_3d": F.max("close").over(last), "close_sum_3d": F.sum("close").over(last), "rows_3d": F.count("close").over(last)}

    # A mean is the last two, which don't tie when they are rounded.
    return with_halo(t.candles_h, 3 * DAY, 7 * DAY, sums).select("symbol", "open_time", "volume_3d", "close_3d", "close_sum_3d", "rows_3d")


query("halo_windows", _halo, f"SELECT symbol, open_time, sum(volume) OVER {days(3)} AS volume_3d, max(close) OVER {days(3)} AS close_3d, sum(close) OVER {days(3)} AS close_sum_3d, count(close) OVER {days(3)} AS rows_3d FROM candles_h", "volume_3d close_3d close_sum_3d")

# --- Time-ordered reads ---------------------------------------------------------------------------------------------


def _series(name: str, columns: str, limit: int) -> None:
    query(name, lambda t: getattr(reads, name)(t.gold, "click", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 28), limit), f"SELECT symbol, open_time, {', '.join(columns.split())} FROM gold WHERE symbol = 'click' AND is_valid_feature_row AND open_time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28' ORDER BY open_time DESC LIMIT {limit}", " ".join(c for c in columns.split() if c != "trades"))


_series("candles", "open high low close volume trades ma_5 ma_20", 100)
_series("returns_series", "log_return log_return_lag1 log_return_lag2", 200)
_series("volatility_series", "volatility volatility_5 volatility_ratio", 200)
_series("orderflow_series", "imbalance_ratio buy_ratio buy_ratio_5 taker_buy_base", 150)
_series("momentum_series", "momentum trend_strength volume_spike", 150)
_series("microstructure_series", "body_size price_range_ratio", 150)
query("forecast", lambda t: reads.forecast(t.priced, "view", 15), "SELECT symbol, open_time, prediction, predicted_close FROM priced WHERE symbol = 'view' AND predicted_close IS NOT NULL ORDER BY open_time DESC LIMIT 15", "prediction predicted_close")
query("sentiment_timeline", lambda t: reads.sentiment_timeline(t.sentiment_gold, "view", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20), 100), "SELECT symbol, window_start, sentiment_index, avg_confidence, message_count FROM sentiment_gold WHERE symbol = 'view' AND window_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' ORDER BY window_start DESC LIMIT 100", "sentiment_index avg_confidence")
query("sentiment_summary", lambda t: reads.sentiment_summary(t.sentiment_gold), "SELECT symbol, max(window_start) AS window_start, arg_max(sentiment_index, window_start) AS sentiment_index, arg_max(avg_confidence, window_start) AS avg_confidence, arg_max(message_count, window_start) AS message_count FROM sentiment_gold GROUP BY symbol", "sentiment_index avg_confidence")
query("expected_move", lambda t: reads.expected_move(t.candles_h, t.priced),
      """SELECT *, CASE WHEN change_pct > 0 THEN 'up' WHEN change_pct < 0 THEN 'down' ELSE 'flat' END AS direction FROM (SELECT symbol, last_close, p AS predicted_close, (p - last_close) / last_close * 100 AS change_pct FROM
      (SELECT symbol, arg_max(close, open_time) AS last_close FROM candles_h GROUP BY symbol) JOIN (SELECT symbol, arg_max(predicted_close, open_time) AS p FROM priced GROUP BY symbol) USING (symbol))""", "last_close predicted_close change_pct")  # fmt: skip

# --- Aggregations ---------------------------------------------------------------------------------------------------

query("symbols", lambda t: aggs.symbols(t.candles_h), "SELECT DISTINCT symbol FROM candles_h")
query("symbol_info", lambda t: aggs.symbol_info(t.candles_h), "SELECT symbol, min(open_time) AS first_time, max(open_time) AS last_time, count(*) AS n_rows FROM candles_h GROUP BY symbol")
query("return_heatmap", lambda t: aggs.return_heatmap(t.gold), "SELECT day_of_week, hour, avg(log_return) AS avg_return, avg(volume) AS avg_volume, count(*) AS n_rows FROM gold WHERE is_valid_feature_row GROUP BY day_of_week, hour", "avg_return avg_volume")
query("prediction_accuracy", lambda t: aggs.prediction_accuracy(t.filled, 100),
      """SELECT symbol, count(*) AS total, count(actual_close) AS matched, avg(abs(error)) AS avg_abs_error, 100 * avg(CASE WHEN direction_correct THEN 1.0 ELSE 0.0 END) AS accuracy_pct
      FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS n FROM filled WHERE actual_close IS NOT NULL) WHERE n <= 100 GROUP BY symbol""", "avg_abs_error accuracy_pct")  # fmt: skip
query("sentiment_by_source", lambda t: aggs.sentiment_by_source(t.sentiment_silver), "SELECT source, count(*) AS messages, CAST(sum(engagement) AS BIGINT) AS engagement FROM sentiment_silver GROUP BY source")
_LAGS = """SELECT a.symbol, l.lag, round(covar_pop(b.x, a.y) / (stddev_pop(b.x) * stddev_pop(a.y)), 4) AS correlation, count(*) AS n
    FROM (SELECT symbol, log_return AS y, row_number() OVER {r} AS n FROM pairs) a CROSS JOIN (SELECT CAST(unnest(range(-10, 11)) AS INT) AS lag) l
    JOIN (SELECT symbol, sentiment_index AS x, row_number() OVER {r} AS n FROM pairs) b ON a.symbol = b.symbol AND b.n = a.n + {shift} GROUP BY a.symbol, l.lag"""
query("lag_correlation", lambda t: aggs.lag_correlation(t.pairs, stretch_s=STRETCH), _LAGS.format(r=ROW, shift="l.lag"), "correlation")
query("lag_correlation_compat", lambda t: aggs.lag_correlation(t.pairs, compat=True, stretch_s=STRETCH), _LAGS.format(r=ROW, shift="-abs(l.lag)"), "correlation")
query("regime_performance", lambda t: aggs.regime_performance(joins.regime_join(t.aligned, t.gold, "hour")), "SELECT g.hour AS regime, count(*) AS n, avg(CAST(direction_correct AS INT)) AS accuracy, avg(abs_error) AS mae FROM aligned a JOIN gold g ON a.symbol = g.symbol AND a.open_time = g.open_time GROUP BY g.hour", "accuracy mae")
query("confidence_bins", lambda t: aggs.confidence_bins(t.aligned),
      """SELECT bin, max(low + w * (bin - 0.5)) AS midpoint, count(*) AS n, avg(CAST(direction_correct AS INT)) AS accuracy FROM (SELECT *, CAST(least(greatest(ceil((c - low) / w), 1), 10) AS INT) AS bin
      FROM (SELECT direction_correct, abs(prediction) AS c, min(abs(prediction)) OVER () AS low, (max(abs(prediction)) OVER () - min(abs(prediction)) OVER ()) / 10 AS w FROM aligned)) GROUP BY bin""", "midpoint accuracy")  # fmt: skip
query("direction_by_horizon", lambda t: aggs.direction_by_horizon(t.aligned),
      "SELECT horizon, avg(CAST(sign(p) = sign(a) AS INT)) AS accuracy, count(*) AS n FROM (SELECT 'return_short' AS horizon, return_short AS p, actual_log_return_lead1 AS a FROM aligned UNION ALL SELECT 'return_long', return_long, actual_log_return_lead1 FROM aligned) WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY horizon", "accuracy")
_SIGNED = lambda t: evaluate.binned_actual_sign(t.aligned, "actual_log_return_lead1", 0.2)
CTES["signed"] = "SELECT *, CASE WHEN actual_log_return_lead1 <= -0.2 THEN 0 WHEN actual_log_return_lead1 <= 0.2 THEN 1 WHEN actual_log_return_lead1 > 0.2 THEN 2 END AS actual_sign FROM aligned"
query("confusion_matrix", lambda t: aggs.confusion_matrix(_SIGNED(t), "actual_sign", "sign_short"), "SELECT actual_sign AS actual, sign_short AS predicted, count(*) AS n FROM signed WHERE actual_sign IS NOT NULL GROUP BY 1, 2")
query("symbol_distribution", lambda t: aggs.symbol_distribution(t.candles_h), "SELECT symbol, count(*) AS n FROM candles_h GROUP BY symbol")
_GRID = """SELECT i.interval, count(e.ts) AS n FROM (SELECT unnest(generate_series((SELECT min(time_bucket(INTERVAL '{m} minutes', ts)) FROM events), (SELECT max(ts) FROM events), INTERVAL '{m} minutes')) AS interval) i
    LEFT JOIN events e ON time_bucket(INTERVAL '{m} minutes', e.ts) = i.interval GROUP BY i.interval"""
_EVENTS = lambda t: fixtures.table(t.spark, t.sf_dir, "events")
query("rows_per_interval", lambda t: aggs.rows_per_interval(_EVENTS(t), "1 minute", "ts"), _GRID.format(m=1))
query("cumulative_rows", lambda t: aggs.cumulative_rows(_EVENTS(t), "5 minutes", "ts"), f"SELECT interval, n, CAST(sum(n) OVER (ORDER BY interval) AS BIGINT) AS total FROM ({_GRID.format(m=5)})")
query("ingestion_latency", lambda t: aggs.ingestion_latency(t.candles_h.withColumn("ingestion_time", F.col("open_time") + F.make_dt_interval(secs=F.col("trades").cast("decimal(18,6)")))), "SELECT symbol, open_time, trades::DOUBLE AS latency_s FROM candles_h", "latency_s")
query("null_rates", lambda t: aggs.null_rates(_HOLES(t), ["symbol", "close", "open"]), "SELECT * FROM (SELECT 'symbol' AS \"column\", 100 * avg(CAST(symbol IS NULL AS INT)) AS null_pct FROM holes UNION ALL SELECT 'close', 100 * avg(CAST(close IS NULL AS INT)) FROM holes) WHERE null_pct > 0", "null_pct")
query("null_counts", lambda t: aggs.null_rates(_HOLES(t), ["symbol", "close", "open"], counts=True), "SELECT 'symbol' AS \"column\", count(*) - count(symbol) AS null_count FROM holes UNION ALL SELECT 'close', count(*) - count(close) FROM holes UNION ALL SELECT 'open', count(*) - count(open) FROM holes")
_STATS = " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM gold" for c in FEATURES)
query("baseline_stats", lambda t: aggs.baseline_stats(t.gold, FEATURES), _STATS, "mean std min p25 p75 max")
_CORR = " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, {'1.0::DOUBLE' if a == b else f'covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))'} AS correlation FROM gold" for a in FEATURES for b in FEATURES)
query("correlation_matrix", lambda t: aggs.correlation_matrix(t.gold, FEATURES), f"SELECT x, y, max(correlation) AS correlation FROM ({_CORR}) GROUP BY x, y", "correlation")
query("histogram", lambda t: aggs.histogram(t.gold, "volatility", 40),
      "SELECT bin, min(a + bin * w) AS low, min(a + (bin + 1) * w) AS high, count(*) AS n FROM (SELECT a, w, CAST(least(floor((v - a) / w), 39) AS INT) AS bin FROM (SELECT volatility AS v, min(volatility) OVER () AS a, (max(volatility) OVER () - min(volatility) OVER ()) / 40 AS w FROM gold)) GROUP BY bin", "low high")
query("compared_histograms", lambda t: aggs.compared_histograms({"before": t.predictions_in.where(F.col("open_time") < F.lit(CUT)), "after": t.predictions_in.where(F.col("open_time") >= F.lit(CUT))}, "prediction", 50),
      f"SELECT side, bin, min(a + bin * w) AS low, min(a + (bin + 1) * w) AS high, count(*) AS n FROM (SELECT side, a, w, CAST(least(floor((v - a) / w), 49) AS INT) AS bin FROM (SELECT CASE WHEN open_time < TIMESTAMP '{CUT}' THEN 'before' ELSE 'after' END AS side, prediction AS v, min(prediction) OVER () AS a, (max(prediction) OVER () - min(prediction) OVER ()) / 50 AS w FROM predictions_in)) GROUP BY side, bin", "low high")
query("time_split_of_a_model", lambda t: labels.time_split(t.candles_h, **labels.split_days({"test": 3}, {"train": 10, "val": 4, "test": 9})).select("symbol", "open_time", "split"),
      "SELECT symbol, open_time, split FROM (SELECT symbol, open_time, CASE WHEN open_time >= m - INTERVAL 3 DAYS THEN 'test' WHEN open_time >= m - INTERVAL 8 DAYS AND open_time < m - INTERVAL 4 DAYS THEN 'val' WHEN open_time >= m - INTERVAL 19 DAYS AND open_time < m - INTERVAL 9 DAYS THEN 'train' END AS split FROM (SELECT *, max(open_time) OVER () AS m FROM candles_h)) WHERE split IS NOT NULL")
query("residual_summary", lambda t: aggs.residual_summary(t.aligned), "SELECT avg(residual) AS mean, stddev_samp(residual) AS std, count(residual) AS n FROM aligned", "mean std")
query("health_kpis", lambda t: aggs.health_kpis(t.gold, t.predictions_in, t.history))
query("layer_freshness", lambda t: aggs.layer_freshness(t.gold), "SELECT max(open_time) AS last_open_time, arg_max(close, (open_time, symbol)) AS last_close, arg_max(log_return, (open_time, symbol)) AS last_return, count(*) AS n_rows FROM gold", "last_close last_return")
_SPLIT = lambda t: labels.time_split(labels.sign_labels(labels.forward_returns(t.gold, {"return_short": 1}), "return_short", 0.2, "sign_short"), 14, 5, 5)
CTES["split_rows"] = """SELECT *, CASE WHEN open_time >= m - INTERVAL 5 DAYS THEN 'test' WHEN open_time >= m - INTERVAL 11 DAYS AND open_time < m - INTERVAL 6 DAYS THEN 'val' WHEN open_time >= m - INTERVAL 26 DAYS AND open_time < m - INTERVAL 12 DAYS THEN 'train' END AS split,
    CASE WHEN return_short > 0.2 THEN 2 WHEN return_short < -0.2 THEN 0 WHEN return_short IS NOT NULL THEN 1 END AS sign_short FROM (SELECT g.*, max(open_time) OVER () AS m, ln(lead(close) OVER (PARTITION BY symbol ORDER BY open_time) / close) AS return_short FROM gold g)"""
query("target_stats", lambda t: aggs.target_stats(_SPLIT(t), "return_short", ["return_5"], "sign_short"),
      "SELECT split, count(*) AS n_rows, avg(return_short) AS target_mean, stddev_samp(return_short) AS target_std, count(*) FILTER (WHERE sign_short = 0) AS class_0, count(*) FILTER (WHERE sign_short = 1) AS class_1, count(*) FILTER (WHERE sign_short = 2) AS class_2, 0::BIGINT AS feature_nans, avg(return_5) AS return_5_mean, stddev_samp(return_5) AS return_5_std FROM split_rows WHERE split IS NOT NULL GROUP BY split", "target_mean target_std return_5_mean return_5_std")
query("resample_candles", lambda t: aggs.resample_candles(t.candles_h, "1 day").select("symbol", "open_time", "open", "high", "low", "close", "volume", "trades"),
      "SELECT symbol, date_trunc('day', open_time) AS open_time, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close, sum(volume) AS volume, CAST(sum(trades) AS BIGINT) AS trades FROM candles_h GROUP BY 1, date_trunc('day', candles_h.open_time)".replace("GROUP BY 1, ", "GROUP BY symbol, "), "open high low close volume")

# --- Labels ---------------------------------------------------------------------------------------------------------

query("forward_returns", lambda t: labels.forward_returns(t.silver, {"return_short": 1, "return_long": 24}, stretch_s=STRETCH).select("symbol", "open_time", "return_short", "return_long", "log_return_lead1"), f"SELECT symbol, open_time, ln(lead(close) OVER {ROW} / close) AS return_short, ln(lead(close, 24) OVER {ROW} / close) AS return_long, ln(lead(close) OVER {ROW} / close) AS log_return_lead1 FROM silver", "return_short return_long log_return_lead1")
query("sign_labels", lambda t: labels.sign_labels(t.predictions_in, "return_short", 0.0015, "label").select("symbol", "open_time", "label"), "SELECT symbol, open_time, CASE WHEN return_short > 0.0015 THEN 2 WHEN return_short < -0.0015 THEN 0 WHEN return_short IS NOT NULL THEN 1 END AS label FROM predictions_in")
query("sign_labels_of_nan", lambda t: labels.sign_labels(t.predictions_in.withColumn("r", F.when(F.hour("open_time") % 5 == 0, float("nan")).otherwise(F.col("return_short"))), "r", 0.0015, "label").select("symbol", "open_time", "label"),
      "SELECT symbol, open_time, CASE WHEN hour(open_time) % 5 = 0 THEN 1 WHEN return_short > 0.0015 THEN 2 WHEN return_short < -0.0015 THEN 0 WHEN return_short IS NOT NULL THEN 1 END AS label FROM predictions_in")
query("training_frame", lambda t: labels.training_frame(t.gold, labels.TrainingConfig(FEATURES, SYMBOLS, {"return_short": 1, "return_long": 24}, 0.2, True, 20)).select("symbol", "open_time", "return_short", "return_long", "sign_short", "symbol_id"),
      f"""SELECT symbol, open_time, a AS return_short, b AS return_long, CASE WHEN a > 0.2 THEN 2 ELSE 0 END AS sign_short, CASE symbol WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS symbol_id
      FROM (SELECT *, max(open_time) OVER () AS m FROM (SELECT symbol, open_time, ln(lead(close) OVER {ROW} / close) AS a, ln(lead(close, 24) OVER {ROW} / close) AS b FROM gold WHERE is_valid_feature_row) WHERE a IS NOT NULL AND b IS NOT NULL AND abs(a) > 0.2) WHERE open_time >= m - INTERVAL 20 DAYS""", "return_short return_long")  # fmt: skip
query("time_split", lambda t: _SPLIT(t).select("symbol", "open_time", "split"), "SELECT symbol, open_time, split FROM split_rows WHERE split IS NOT NULL")
query("split_metadata", lambda t: labels.split_metadata(_SPLIT(t)), "SELECT split, min(open_time) AS first_time, max(open_time) AS last_time, count(*) AS n_rows FROM split_rows WHERE split IS NOT NULL GROUP BY split")
query("decay_weights", lambda t: labels.decay_weights(t.candles_h, 10).select("symbol", "open_time", "weight"), "SELECT symbol, open_time, exp(-epoch(m - open_time) / 864000.0) AS weight FROM (SELECT symbol, open_time, max(open_time) OVER () AS m FROM candles_h)", "weight")
query("balanced_class_weights", lambda t: labels.balanced_class_weights(labels.decay_weights(t.predictions_in, 10), "sign_short").select("symbol", "open_time", "class_weight"),
      "SELECT symbol, open_time, exp(-epoch(m - open_time) / 864000.0) * n / (k * c) AS class_weight FROM (SELECT *, max(open_time) OVER () AS m, count(*) OVER () AS n, (SELECT count(DISTINCT sign_short) FROM predictions_in) AS k, count(*) OVER (PARTITION BY sign_short) AS c FROM predictions_in)", "class_weight")
query("ordered_split", lambda t: labels.ordered_split(t.candles_h).select("symbol", "open_time", "split"), "SELECT symbol, open_time, CASE WHEN row_number() OVER (ORDER BY open_time, symbol) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split FROM candles_h")

# --- Models ---------------------------------------------------------------------------------------------------------

_TRAIN = lambda t: _SPLIT(t).where("return_short IS NOT NULL").select("symbol", "open_time", "split", "return_short", "sign_short", *FEATURES)


#: Candidates of a search: half of them go on with twice the trees.
_GRID = [{"maxDepth": 1, "maxIter": 4}, {"maxDepth": 2, "maxIter": 4}, {"maxDepth": 3, "maxIter": 4}]


def _searched(t: Tables) -> tuple:
    return ml.select_model(t.kept(_TRAIN(t)), FEATURES, "return_short", _GRID, halving=2)


def _scorer(batch):
    import pandas as pd

    return pd.DataFrame({"symbol": batch["symbol"], "open_time": batch["open_time"], "return_short": batch["return_5"] / 10, "sign_short": batch["imbalance_ratio"] + 1})


SCORED = "symbol string, open_time timestamp, return_short double, sign_short double"
query("fit_regressor", lambda t: ml.fit_regressor(_TRAIN(t).where("split = 'train'"), FEATURES, "return_short", None, {"maxDepth": 3, "maxIter": 3}).transform(_TRAIN(t).where("split = 'test'")).select("symbol", "open_time", "prediction"))
query("fit_classifier", lambda t: ml.fit_classifier(_TRAIN(t).where("split = 'train'"), FEATURES, "sign_short", None, {"maxIter": 3, "maxDepth": 3}).transform(_TRAIN(t).where("split = 'test'")).select("symbol", "open_time", "prediction"))
query("select_model", lambda t: _searched(t)[1])


def _regressor_fit(t: Tables) -> DataFrame:
    """On the val split, boosting leaves less than nine tenths of the error that the mean of the train split leaves."""
    rows = t.kept(_TRAIN(t))
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    out = ml.fit_regressor(train, FEATURES, "return_short", None, {"maxDepth": 3, "maxIter": 8}).transform(val).crossJoin(F.broadcast(train.agg(F.avg("return_short").alias("mean"))))
    error = lambda c: F.sqrt(F.avg((F.col("return_short") - F.col(c)) ** 2))
    return out.agg(F.count(F.lit(1)).alias("n"), (error("prediction") < 0.9 * error("mean")).alias("beats_the_mean"), F.count("prediction").alias("predicted"))


def _classifier_fit(t: Tables) -> DataFrame:
    """On the val split, the log loss is below that of a forest of as many trees of the same depth (by more than minus one
    standard error of the rows' differences, as the smallest tables don't tell the two apart) and of the train split's shares."""
    rows = t.kept(_TRAIN(t))
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    for name, params in {"boosted": {"maxIter": 10, "maxDepth": 2, "stepSize": 0.2}, "forest": {"numTrees": 30, "maxDepth": 2}}.items():
        val = ml.fit_classifier(train, FEATURES, "sign_short", None, params).transform(val)
        val = val.withColumn(name, -F.log(F.get(ml.vector_to_array("probability"), F.col("sign_short")))).select(*rows.columns, *[c for c in ("boosted", "forest") if c in val.columns or c == name])
    share = [F.avg((F.col("sign_short") == k).cast("double")).alias(f"s{k}") for k in range(3)]
    plain = -F.log(F.element_at(F.array("s0", "s1", "s2"), F.col("sign_short") + 1))
    d, n = F.col("boosted") - F.col("forest"), F.count(F.lit(1))
    return val.crossJoin(F.broadcast(train.agg(*share))).agg(n.alias("n"), (F.avg(d) < F.stddev(d) / F.sqrt(n)).alias("below_the_forest"), (F.avg("boosted") < 0.95 * F.avg(plain)).alias("below_the_shares"))


def _selection(t: Tables) -> DataFrame:
    """What the table of scores says of the search, and the score of the model that was chosen."""
    model, scores = _searched(t)
    own = evaluate.regression_metrics(model.transform(_TRAIN(t).where("split = 'val'")), "return_short", "prediction").select("rmse", "n")
    scores = scores.withColumn("last", F.max("rung").over(Window.partitionBy(F.lit(0))))  # a few rows
    best = scores.agg(F.count(F.lit(1)).alias("fitted"), F.max("trees").alias("trees"), F.min(F.when(F.col("rung") == F.col("last"), F.col("rmse"))).alias("best"), F.max(F.when(F.col("chosen"), F.col("rmse"))).alias("chosen"))
    return own.crossJoin(F.broadcast(best)).select("fitted", "trees", "n", ((F.abs(F.col("rmse") - F.col("best")) < 1e-9) & (F.col("best") == F.col("chosen"))).alias("lowest_is_chosen"))


query("fit_regressor_quality", _regressor_fit, "SELECT count(*) AS n, true AS beats_the_mean, count(*) AS predicted FROM split_rows WHERE split = 'val' AND return_short IS NOT NULL")
query("fit_classifier_quality", _classifier_fit, "SELECT count(*) AS n, true AS below_the_forest, true AS below_the_shares FROM split_rows WHERE split = 'val' AND return_short IS NOT NULL")
query("select_model_quality", _selection, "SELECT CAST(5 AS BIGINT) AS fitted, CAST(4 AS INT) AS trees, count(*) AS n, true AS lowest_is_chosen FROM split_rows WHERE split = 'val' AND return_short IS NOT NULL")
query("score_batches", lambda t: ml.score_batches(clean.valid_feature_rows(t.gold, FEATURES).select("symbol", "open_time", *FEATURES), _scorer, SCORED), "SELECT symbol, open_time, return_5 / 10 AS return_short, imbalance_ratio + 1 AS sign_short FROM gold WHERE is_valid_feature_row", "return_short sign_short")
_RAW_OUT = lambda t: t.gold.select("symbol", "open_time", (F.col("return_5") / 10).alias("return_short"), (F.col("imbalance_ratio") * 3).alias("sign_short"))
for _name, _compat, _guard in (("postprocess_outputs", False, ""), ("postprocess_outputs_compat", True, "WHEN abs(x) < 0.25 THEN 1 ")):
    query(_name, lambda t, c=_compat: ml.postprocess_outputs(_RAW_OUT(t), {"return_short": "regression", "sign_short": "classification"}, 0.25, c),
          f"SELECT symbol, open_time, return_5 / 10 AS return_short, CAST(CASE {_guard}ELSE least(greatest(round_even(x, 0), 0), 2) END AS INT) AS sign_short, return_5 / 10 AS prediction FROM (SELECT *, imbalance_ratio * 3 AS x FROM gold)".replace("CASE ELSE", "CASE WHEN false THEN 1 ELSE"), "return_short prediction")
query("argmax_class", lambda t: ml.argmax_class(t.gold.select("symbol", "open_time", F.array("buy_ratio", "hour_sin", "volatility").alias("probability"))).drop("probability"), "SELECT symbol, open_time, CASE WHEN buy_ratio >= hour_sin AND buy_ratio >= volatility THEN 0 WHEN hour_sin >= volatility THEN 1 ELSE 2 END AS predicted_class FROM gold")
query("incremental_score", lambda t: medallion.incremental_score(t.gold, t.marks, SYMBOLS, dt.datetime(2024, 1, 10), FEATURES, _scorer, SCORED)[0], "SELECT symbol, open_time, return_5 / 10 AS return_short, imbalance_ratio + 1 AS sign_short FROM gold LEFT JOIN marks USING (symbol) WHERE is_valid_feature_row AND open_time > coalesce(last_processed_time, TIMESTAMP '2024-01-10')", "return_short sign_short")

# --- Evaluation -----------------------------------------------------------------------------------------------------

_Y = "actual_log_return_lead1"
query("regression_metrics", lambda t: evaluate.regression_metrics(t.aligned, _Y, "prediction"), f"SELECT sqrt(avg(residual * residual)) AS rmse, avg(abs(residual)) AS mae, covar_pop({_Y}, prediction) / (stddev_pop({_Y}) * stddev_pop(prediction)) AS correlation, 1 - sum(residual * residual) / (var_pop({_Y}) * count(*)) AS r2, count(*) AS n FROM aligned WHERE {_Y} IS NOT NULL", "rmse mae correlation r2")
query("classification_metrics", lambda t: evaluate.classification_metrics(_SIGNED(t), "actual_sign", "sign_short"),
      """SELECT sum(hit) / sum("real") AS accuracy, avg(p) AS precision, avg(r) AS recall, avg(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) AS f1, CAST(sum("real") AS BIGINT) AS n
      FROM (SELECT *, CASE WHEN said = 0 THEN 0 ELSE hit / said END AS p, CASE WHEN "real" = 0 THEN 0 ELSE hit / "real" END AS r FROM (SELECT k, count(*) FILTER (WHERE actual_sign = k) AS "real", count(*) FILTER (WHERE sign_short = k) AS said, count(*) FILTER (WHERE sign_short = k AND actual_sign = k) AS hit
      FROM signed, (SELECT DISTINCT unnest([actual_sign, sign_short]) AS k FROM signed WHERE actual_sign IS NOT NULL) WHERE actual_sign IS NOT NULL GROUP BY k))""", "accuracy precision recall f1")  # fmt: skip
query("binned_actual_sign", lambda t: _SIGNED(t).select("symbol", "open_time", F.col("actual_sign").cast("double").alias("actual_sign")), "SELECT symbol, open_time, CAST(actual_sign AS DOUBLE) AS actual_sign FROM signed")
_ROLL = """SELECT symbol, open_time, {out} FROM (SELECT symbol, open_time, list_slice(l, greatest(len(l) - w + 1, 1), len(l)) AS own, w, overall FROM (SELECT symbol, open_time, list(v) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 119 PRECEDING AND CURRENT ROW) AS l,
    CAST(greatest(20, least(120, floor(count(*) OVER (PARTITION BY symbol) / 6))) AS INT) AS w, avg(v) OVER (PARTITION BY symbol) AS overall FROM (SELECT symbol, open_time, {v} AS v FROM aligned) WHERE v IS NOT NULL))"""
query("rolling_rmse", lambda t: evaluate.rolling_rmse(t.aligned, STRETCH), _ROLL.format(v="residual * residual", out="CASE WHEN len(own) >= greatest(5, floor(w / 4)) THEN sqrt(list_sum(own) / len(own)) END AS rolling_rmse, sqrt(overall) AS overall_rmse"), "rolling_rmse overall_rmse")
query("rolling_score", lambda t: evaluate.rolling_score(t.aligned, "direction_correct", STRETCH), _ROLL.format(v="CAST(direction_correct AS INT)", out="CASE WHEN len(own) >= greatest(5, floor(w / 4)) THEN list_sum(own) / len(own) END AS rolling_score"), "rolling_score")
_TAMED = lambda t: t.aligned.withColumn(_Y, F.col(_Y) / 100)
_BACK = f"""SELECT *, s * b - turnover * 0.0005 AS x FROM (SELECT *, coalesce(abs(s - lag(s) OVER {ROW}), 0) AS turnover FROM (SELECT symbol, open_time, CASE WHEN prediction > 0.001 THEN 1.0 WHEN prediction < -0.001 THEN -1.0 ELSE 0.0 END AS s, coalesce({_Y} / 100, 0) AS b FROM aligned))"""
query("backtest", lambda t: evaluate.backtest(_TAMED(t), 0.001, 0.0005, stretch_s=STRETCH),
      f"""SELECT symbol, open_time, s::DOUBLE AS signal, b AS benchmark_return, turnover::DOUBLE AS turnover, x AS strategy_return, c AS cumulative, d AS benchmark_cumulative, c / max(c) OVER {RUN} - 1 AS drawdown, d / max(d) OVER {RUN} - 1 AS benchmark_drawdown
      FROM (SELECT *, product(1 + x) OVER {RUN} AS c, product(1 + b) OVER {RUN} AS d FROM ({_BACK}))""", "signal benchmark_return turnover strategy_return cumulative benchmark_cumulative drawdown benchmark_drawdown")  # fmt: skip
#: Predictions from -3 to 3, a third of them about halves, which are rounded to even.
_WIDE = lambda t: _TAMED(t).withColumn("prediction", F.when(F.hour("open_time") % 3 == 0, F.hour("open_time") - 11.5).otherwise(F.col("prediction") * 300))
_DIRECT = f"""SELECT *, s * b - turnover * 0.0005 AS x FROM (SELECT *, coalesce(abs(s - lag(s) OVER {ROW}), 0) AS turnover FROM (SELECT symbol, open_time, least(greatest(round_even(CASE WHEN hour(open_time) % 3 = 0 THEN hour(open_time) - 11.5 ELSE prediction * 300 END, 0), -1), 1) AS s, coalesce({_Y} / 100, 0) AS b FROM aligned))"""
query("backtest_direct", lambda t: evaluate.backtest(_WIDE(t), 0.001, 0.0005, direct=True, stretch_s=STRETCH).select("symbol", "open_time", "signal", "turnover", "strategy_return", "cumulative", "drawdown"),
      f"""SELECT symbol, open_time, s::DOUBLE AS signal, turnover::DOUBLE AS turnover, x AS strategy_return, c AS cumulative, c / max(c) OVER {RUN} - 1 AS drawdown FROM (SELECT *, product(1 + x) OVER {RUN} AS c FROM ({_DIRECT}))""", "signal turnover strategy_return cumulative drawdown")
_PNL = f"SELECT symbol, open_time, sign(prediction)::DOUBLE AS signal, sign(prediction) * {_Y} AS trade_return FROM aligned WHERE {_Y} IS NOT NULL AND abs(prediction) > 0.002"
query("simulate_pnl", lambda t: evaluate.simulate_pnl(t.aligned, 0.002, STRETCH), f"SELECT *, cumulative_pnl - max(cumulative_pnl) OVER {RUN} AS drawdown FROM (SELECT *, sum(trade_return) OVER {RUN} AS cumulative_pnl FROM ({_PNL}))", "signal trade_return cumulative_pnl drawdown")
query("pnl_summary", lambda t: evaluate.pnl_summary(t.aligned, 0.002), f"SELECT count(*) AS n_trades, avg(CAST(trade_return > 0 AS INT)) AS hit_ratio, sum(trade_return) AS total_return, avg(trade_return) / stddev_samp(trade_return) * sqrt(252 * 24) AS sharpe FROM ({_PNL})", "hit_ratio total_return sharpe")
query("sign_strategy", lambda t: evaluate.sign_strategy(t.aligned, stretch_s=STRETCH), f"SELECT symbol, open_time, h AS hold_return, s AS strategy_return, sum(s) OVER {RUN} AS strategy_total, sum(h) OVER {RUN} AS hold_total, avg(s) OVER (PARTITION BY symbol) / stddev_pop(s) OVER (PARTITION BY symbol) AS sharpe FROM (SELECT symbol, open_time, {_Y} AS h, CASE WHEN prediction > 0 THEN {_Y} ELSE -{_Y} END AS s FROM aligned WHERE {_Y} IS NOT NULL)", "hold_return strategy_return strategy_total hold_total sharpe")
query("direction_metrics", lambda t: evaluate.direction_metrics(t.aligned, _Y, "prediction"), f"SELECT avg(CAST((y > 0) = (p > 0) AS INT)) AS direction_accuracy, count(*) FILTER (WHERE y > 0 AND p > 0) / count(*) FILTER (WHERE p > 0) AS precision_up, count(*) FILTER (WHERE y > 0 AND p > 0) / count(*) FILTER (WHERE y > 0) AS recall_up, count(*) AS n FROM (SELECT {_Y} AS y, prediction AS p FROM aligned WHERE {_Y} IS NOT NULL)", "direction_accuracy precision_up recall_up")

# --- Drift ----------------------------------------------------------------------------------------------------------

_SIDES = lambda t: (t.written_gold.where(F.col("open_time") < F.lit(CUT)), t.written_gold.where(F.col("open_time") >= F.lit(CUT)))


def _long_sql(table: str, names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, CAST(open_time >= TIMESTAMP '{CUT}' AS INT) AS side FROM {table}" for c in names)


def _ks_sql(table: str, names: list[str]) -> str:
    return f"""SELECT feature, max(abs(cb / nb - cr / nr)) AS ks_statistic FROM (SELECT feature, sum(b) OVER (PARTITION BY feature ORDER BY x) AS cb, sum(r) OVER (PARTITION BY feature ORDER BY x) AS cr, sum(b) OVER (PARTITION BY feature) AS nb, sum(r) OVER (PARTITION BY feature) AS nr
        FROM (SELECT feature, x, count(*) FILTER (WHERE side = 0) AS b, count(*) FILTER (WHERE side = 1) AS r FROM ({_long_sql(table, names)}) WHERE x IS NOT NULL GROUP BY feature, x)) GROUP BY feature"""


def _shift_sql(table: str, names: list[str]) -> str:
    m = lambda f, s: f"{f}(x) FILTER (WHERE side = {s})"
    return f"""SELECT *, (mean_shift + std_shift) / 2 AS shift_score FROM (SELECT feature, abs({m("avg", 1)} - {m("avg", 0)}) / (abs({m("avg", 0)}) + 1e-6) AS mean_shift, abs({m("stddev_pop", 1)} - {m("stddev_pop", 0)}) / (abs({m("stddev_pop", 0)}) + 1e-6) AS std_shift FROM ({_long_sql(table, names)}) GROUP BY feature)"""


def _drift_sql(table: str, names: list[str], kind: str, prefix: str = "") -> str:
    return f"""SELECT '{prefix}' || feature AS feature_name, '{kind}' AS drift_type, greatest(ks_statistic, shift_score) AS drift_score, greatest(ks_statistic, shift_score) >= 0.2 AS drift_detected, ks_statistic, mean_shift, std_shift FROM ({_ks_sql(table, names)}) JOIN ({_shift_sql(table, names)}) USING (feature)"""


TARGETS = ["return_short", "return_long"]
DRIFT_DOUBLES = "drift_score ks_statistic mean_shift std_shift"
query("ks_statistic", lambda t: drift.ks_statistic(*_SIDES(t), FEATURES), _ks_sql("gold", FEATURES), "ks_statistic")
query("ks_approximate", lambda t: drift.ks_approximate(*_SIDES(t), FEATURES))


def _ks_error(t: Tables) -> DataFrame:
    exact = drift.ks_statistic(*_SIDES(t), FEATURES).select("feature", F.col("ks_statistic").alias("exact"))
    return drift.ks_approximate(*_SIDES(t), FEATURES).join(exact, "feature").select("feature", (F.abs(F.col("ks_statistic") - F.col("exact")) <= 0.01).alias("close"))


query("ks_approximate_error", _ks_error, " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS close" for c in FEATURES))
query("mean_std_shift", lambda t: drift.mean_std_shift(*_SIDES(t), FEATURES), _shift_sql("gold", FEATURES), "mean_shift std_shift shift_score")
#: One recent value of a feature, and none of another: no shift can be told.
_FEW = lambda t: (_SIDES(t)[0], _SIDES(t)[1].select(F.when(F.row_number().over(Window.orderBy("open_time", "symbol")) == 1, F.col("return_5")).alias("return_5"), F.lit(None).cast("double").alias("volume_ratio"), "range_ratio"))
query("mean_std_shift_of_few", lambda t: drift.mean_std_shift(*_FEW(t), ["return_5", "volume_ratio", "range_ratio"]),
      f"SELECT feature, CASE WHEN feature = 'range_ratio' THEN mean_shift ELSE 0.0 END AS mean_shift, CASE WHEN feature = 'range_ratio' THEN std_shift ELSE 0.0 END AS std_shift, CASE WHEN feature = 'range_ratio' THEN shift_score ELSE 0.0 END AS shift_score FROM ({_shift_sql('gold', ['return_5', 'volume_ratio', 'range_ratio'])})", "mean_shift std_shift shift_score")
#: The newest rows of either side that drift is measured on; all sides of the fixture have more.
_NEWEST = drift.DriftConfig(0.2, 50, recent_rows=300, baseline_rows=500)
CTES["gold_newest"] = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY open_time >= TIMESTAMP '{CUT}' ORDER BY open_time DESC, symbol) AS newest FROM gold) WHERE newest <= CASE WHEN open_time >= TIMESTAMP '{CUT}' THEN 300 ELSE 500 END"
CTES["predictions_newest"] = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY open_time >= TIMESTAMP '{CUT}' ORDER BY open_time DESC, symbol) AS newest FROM predictions_in) WHERE newest <= CASE WHEN open_time >= TIMESTAMP '{CUT}' THEN 300 ELSE 500 END"
query("data_drift", lambda t: drift.data_drift(*_SIDES(t), FEATURES, _NEWEST), _drift_sql("gold_newest", FEATURES, "data"), DRIFT_DOUBLES)
query("model_drift", lambda t: drift.model_drift(t.predictions_in.where(F.col("open_time") >= F.lit(CUT)), t.predictions_in.where(F.col("open_time") < F.lit(CUT)), TARGETS, _NEWEST), _drift_sql("predictions_newest", TARGETS, "model", "__model__."), DRIFT_DOUBLES)


def _kept_sketches(t: Tables, gold: DataFrame) -> DataFrame:
    """Sketches of a table in two appends, kept by date."""
    path = t.scratch()
    for part in (F.hour("open_time") < 12, F.hour("open_time") >= 12):
        io.write_partitioned(drift.drift_sketches(gold.where(part), FEATURES), path, partition_by=("date",))
    return t.spark.read.parquet(path)


def _sketch_drift(t: Tables) -> DataFrame:
    """Shifts from sketches, and whether KS is as near to the exact one as sketches are."""
    found = drift.drift_from_sketches(*[_kept_sketches(t, side) for side in _SIDES(t)], FEATURES, drift.DriftConfig(0.2, 50))
    exact = drift.ks_statistic(*_SIDES(t), FEATURES).select(F.col("feature").alias("feature_name"), F.col("ks_statistic").alias("exact"))
    return found.join(exact, "feature_name").select("feature_name", "drift_type", "mean_shift", "std_shift", (F.abs(F.col("ks_statistic") - F.col("exact")) <= 0.01).alias("close"), (F.col("drift_score") >= F.greatest("ks_statistic", (F.col("mean_shift") + F.col("std_shift")) / 2) - 1e-12).alias("highest"))


query("drift_from_sketches", _sketch_drift, f"SELECT feature AS feature_name, 'data' AS drift_type, mean_shift, std_shift, true AS close, true AS highest FROM ({_shift_sql('gold', FEATURES)})", "mean_shift std_shift")
query("newest_rows", lambda t: drift.newest_rows(t.predictions_in, 333).select("symbol", "open_time", "prediction"), "SELECT symbol, open_time, prediction FROM predictions_in ORDER BY open_time DESC, symbol LIMIT 333", "prediction")
CTES["drift_rows"] = f"{_drift_sql('gold', FEATURES, 'data')} UNION ALL {_drift_sql('predictions_in', TARGETS, 'model', '__model__.')}"
CTES["drift_top"] = "SELECT max(drift_score) FILTER (WHERE drift_type = 'data') AS data_drift_score, max(drift_score) FILTER (WHERE drift_type = 'model') AS model_drift_score, max(drift_score) AS overall_drift_score FROM drift_rows"
CTES["report"] = """SELECT r.*, t.*, 0.2::DOUBLE AS threshold FROM (SELECT * FROM drift_rows UNION ALL SELECT '__model__', 'model', model_drift_score, model_drift_score >= 0.2, 0, 0, 0 FROM drift_top UNION ALL SELECT '__overall__', 'overall', overall_drift_score, overall_drift_score >= 0.2, 0, 0, 0 FROM drift_top) r, drift_top t"""
REPORT_DOUBLES = DRIFT_DOUBLES + " data_drift_score model_drift_score overall_drift_score threshold"
query("drift_report", lambda t: t.report, "SELECT * FROM report", REPORT_DOUBLES)
CTES["history"] = f"SELECT *, TIMESTAMP '{PLACEHOLDER}' AS \"timestamp\", CASE WHEN overall_drift_score >= 0.2 THEN 'drift_detected' ELSE 'no_drift' END AS trigger_reason, overall_drift_score >= 0.2 AS triggered, CASE WHEN drift_type = 'model' THEN drift_score END AS model_metric FROM report"
query("retrain_decision", lambda t: drift.retrain_decision(t.report, dt.datetime(2024, 1, 31, 23, 30), 60, dt.datetime(2024, 2, 1)), f"SELECT TIMESTAMP '{PLACEHOLDER}' AS \"timestamp\", CASE WHEN overall_drift_score >= 0.2 THEN 'cooldown_active' ELSE 'no_drift' END AS trigger_reason, false AS triggered FROM drift_top")
query("drift_history", lambda t: t.history, "SELECT * FROM history", REPORT_DOUBLES + " model_metric")
query("drift_top_features", lambda t: reads.drift_top_features(t.history, 3), 'SELECT "timestamp", feature_name, drift_score, drift_detected FROM history WHERE drift_type = \'data\' ORDER BY drift_score DESC LIMIT 3', "drift_score")
query("drift_summary", lambda t: aggs.drift_summary(t.history), """SELECT max("timestamp") AS "timestamp", max(overall_drift_score) AS overall_drift_score, max(data_drift_score) AS data_drift_score, max(model_drift_score) AS model_drift_score, bool_or(drift_detected) AS drift_detected, bool_or(triggered) AS triggered, count(*) FILTER (WHERE drift_type = 'data' AND drift_detected) AS drifted_features FROM history""", "overall_drift_score data_drift_score model_drift_score")
query("retraining_events", lambda t: reads.retraining_events(t.history), 'SELECT "timestamp", max(overall_drift_score) AS overall_drift_score, max(trigger_reason) AS trigger_reason FROM history WHERE triggered GROUP BY "timestamp"', "overall_drift_score")
ORACLES["health_kpis"] = oracle("""SELECT (SELECT max(open_time) FROM predictions_in) AS last_prediction_time, (SELECT count(*) FROM predictions_in) AS predictions, (SELECT 100 * avg(CAST(is_valid_feature_row AS INT)) FROM gold) AS valid_pct, (SELECT count(*) FILTER (WHERE NOT is_valid_feature_row) FROM gold) AS invalid_rows, overall_drift_score AS last_drift_score FROM drift_top""", "valid_pct last_drift_score")

# --- Streaming ------------------------------------------------------------------------------------------------------


def _stream_of(t: Tables, df: DataFrame, files: int = 3) -> DataFrame:
    """df as a file stream: written once, then read file by file, a micro-batch each. Rows are in no order."""
    path = t.scratch()
    df.repartition(files).write.parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _stream_in_order(t: Tables, df: DataFrame, time: Column, late: Column | None = None) -> DataFrame:
    """df as a stream of three micro-batches, one after the other in time, and one of the rows that are late: the source takes
    files in the order they came."""
    path, bounds = t.scratch(), [None, dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), None]
    on_time = df if late is None else df.where(~late)
    for low, high in zip(bounds, bounds[1:]):
        part = on_time if low is None else on_time.where(time >= F.lit(low))
        (part if high is None else part.where(time < F.lit(high))).coalesce(1).write.mode("append").parquet(path)
    if late is not None:
        df.where(late).coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _appended(t: Tables, sdf: DataFrame) -> DataFrame:
    out = t.scratch()
    streams.stream_append(sdf, f"{out}/data", f"{out}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return t.spark.read.schema(sdf.schema).parquet(f"{out}/data")


def _ordered_raw(t: Tables) -> DataFrame:
    return t.raw_candles.where("open_time IS NOT NULL")


def _medallion(t: Tables) -> DataFrame:
    out = t.scratch()
    paths = streams.LayerPaths(f"{out}/silver", f"{out}/gold", f"{out}/offsets")
    streams.stream_medallion(_stream_of(t, t.topic_messages, 3), paths, f"{out}/checkpoint", HOUR).awaitTermination()
    return streams.read_layer(t.spark, paths.gold).select("symbol", "open_time", *GOLD)


def _bronze_stream(t: Tables) -> DataFrame:
    """Rows of two days come last of all, weeks late: the watermark drops them."""
    time, raw = normalize_epoch("open_time"), _ordered_raw(t)
    late = (F.col("symbol") == "click") & time.between(F.lit(dt.datetime(2024, 1, 2)), F.lit(dt.datetime(2024, 1, 4)))
    return _appended(t, streams.stream_bronze(_stream_in_order(t, raw, time, late)))


query("stream_bronze", lambda t: _bronze_stream(t).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM candles_h WHERE NOT (symbol = 'click' AND open_time BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-04')", "close")
query("stream_silver", lambda t: _appended(t, streams.stream_silver(streams.stream_bronze(_stream_in_order(t, _ordered_raw(t), normalize_epoch("open_time"))))).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM silver", "close")
query("stream_append", lambda t: _appended(t, _stream_of(t, t.candles_h)).select("symbol", "open_time", "close"), "SELECT symbol, open_time, close FROM candles_h", "close")


def _aggregated(t: Tables, mode: str) -> DataFrame:
    """Counts of a stream in three micro-batches."""
    out, keys = t.scratch(), ("symbol",)
    counts = _stream_of(t, t.candles_h).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("trades").alias("trades"), F.max("open_time").alias("last_time"))
    streams.stream_append(counts, f"{out}/data", f"{out}/checkpoint", mode, {"availableNow": True}, keys=keys).awaitTermination()
    return streams.read_versions(t.spark, f"{out}/data", keys if mode == "update" else ())


for _mode in ("update", "complete"):
    query(f"stream_{_mode}", lambda t, m=_mode: _aggregated(t, m), "SELECT symbol, count(*) AS n, CAST(sum(trades) AS BIGINT) AS trades, max(open_time) AS last_time FROM candles_h GROUP BY symbol")
query("batch_medallion", lambda t: medallion.batch_medallion(t.raw_candles, HOUR, stretch_s=STRETCH).select("symbol", "open_time", *GOLD), f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold", GOLD_DOUBLES)
query("stream_medallion", _medallion, f"SELECT symbol, open_time, {', '.join(GOLD)} FROM gold", GOLD_DOUBLES)


# --- Larger tables ------------------------------------------------------------------------------------------------


def _daily(sql: str) -> str:
    """The SQL of hourly candles for daily ones: frames of so many candles are that many days, frames of days stay."""
    import re

    seconds = lambda m: m[0] if int(m[1]) in (DAY, 3 * DAY) else f"INTERVAL {int(m[1]) * DAY // HOUR} SECONDS"
    return re.sub(r"\b(silver|g1|g2|g3|gold|candles_h)\b", lambda m: "candles_d" if m[1] == "candles_h" else f"{m[1]}_of_days", re.sub(r"INTERVAL (\d+) SECONDS", seconds, sql))


CTES |= {f"{name}_of_days": _daily(CTES[name]) for name in ("silver", "g1", "g2", "g3", "gold")}


#: Prices here are quotients by up to 50, so their sums often end in a five at the seventh decimal, which either side may
#: round up or down; columns in units of the price are compared relative to it.
_PRICED = ["ma_5", "ma_20", "momentum"]
_DAILY = [c for c in GOLD if c not in _PRICED]


def gold_daily(t: Tables) -> DataFrame:
    """Features of daily candles of 25 symbols over seven years."""
    gold = features.gold_features(clean.silver_candles(t.candles_d), DAY)
    return gold.select("symbol", "open_time", *_DAILY, *[(F.col(c) / F.col("close")).alias(c) for c in _PRICED])


query("gold_daily", gold_daily, f"SELECT symbol, open_time, {', '.join([*_DAILY, *[f'{c} / close AS {c}' for c in _PRICED]])} FROM gold_of_days", GOLD_DOUBLES)
query("resample_daily_by_4_days", lambda t: aggs.resample_candles(t.candles_d, "4 days").select("symbol", "open_time", "open", "high", "low", "close"),
      "SELECT symbol, b AS open_time, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close FROM (SELECT *, make_timestamp((epoch(open_time)::BIGINT // 345600) * 345600 * 1000000) AS b FROM candles_d) GROUP BY symbol, b", exact=True)
