"""Candle tables derived from the driver's tables, and the same views as DuckDB SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR, DAY = 3600, 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its zoneless timestamps as timestamps of the session zone, which has to be UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({n: F.col(n).cast("timestamp") for n, t in df.dtypes if t == "timestamp_ntz"})


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def candles_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles with gaps; the symbol is the event type."""
    e, order = table(spark, sf_dir, "events"), F.struct("ts", "event_id")
    even = _k() % 2 == 0
    return (e.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("open_time"))
            .agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"),
                 F.sum("value").alias("volume"), F.sum(F.col("value") * F.col("value")).alias("quote_volume"), F.count(F.lit(1)).cast("int").alias("trades"),
                 F.coalesce(F.sum(F.when(even, F.col("value"))), F.lit(0.0)).alias("taker_buy_base"),
                 F.coalesce(F.sum(F.when(even, F.col("value") * F.col("value"))), F.lit(0.0)).alias("taker_buy_quote"))
            .withColumn("date", F.to_date("open_time")))


def candles_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles of 25 symbols over seven years; the symbol is the part's brand."""
    px = F.col("l_extendedprice") / F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").withColumn("px", px).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    order, taken = F.struct("l_orderkey", "l_linenumber"), F.col("l_discount") >= 0.05
    return (rows.groupBy(F.col("p_brand").alias("symbol"), F.date_trunc("day", "l_shipdate").alias("open_time"))
            .agg(F.min_by("px", order).alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", order).alias("close"),
                 F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("quote_volume"), F.count(F.lit(1)).cast("int").alias("trades"),
                 F.coalesce(F.sum(F.when(taken, F.col("l_quantity"))), F.lit(0.0)).alias("taker_buy_base"),
                 F.coalesce(F.sum(F.when(taken, F.col("l_extendedprice"))), F.lit(0.0)).alias("taker_buy_quote"))
            .withColumn("date", F.to_date("open_time")))


def raw_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze input: epochs in micro- or milliseconds, and the rows of every seventh hour twice."""
    c = candles_h(spark, sf_dir)
    micro, even = F.unix_micros("open_time"), F.col("trades") % 2 == 0
    milli = F.unix_millis("open_time")
    c = c.unionByName(c.where(F.hour("open_time") % 7 == 0))
    return c.select("symbol", F.when(even, micro).otherwise(milli).alias("open_time"), F.when(even, micro + 3599999999).otherwise(milli + 3599999).alias("close_time"),
                    "open", "high", "low", "close", "volume", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote")


def kline_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional JSON arrays, most numbers as strings."""
    milli = F.unix_millis("open_time")
    parts = ["[", milli, ',"', "open", '","', "high", '","', "low", '","', "close", '","', "volume", '",', milli + 3599999, ',"', "quote_volume", '",', "trades", ',"', "taker_buy_base", '","', "taker_buy_quote", '","0"]']
    names = {"open", "high", "low", "close", "volume", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote"}
    return candles_h(spark, sf_dir).select("symbol", F.concat(*[F.col(p) if isinstance(p, str) and p in names else F.lit(p) if isinstance(p, str) else p for p in parts]).alias("payload"))


def kline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON messages: every fifth candle still open, every eleventh message of another kind, some broken."""
    milli = F.unix_millis("open_time")
    k = F.struct(milli.alias("t"), (milli + 3599999).alias("T"), F.col("symbol").alias("s"), *[F.col(c).cast("string").alias(a) for c, a in (("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"), ("volume", "v"), ("quote_volume", "q"))],
                 F.col("trades").alias("n"), F.col("taker_buy_base").cast("string").alias("V"), F.col("taker_buy_quote").cast("string").alias("Q"), (F.hour("open_time") % 5 != 0).alias("x"))
    body = F.struct(F.struct(F.when(F.hour("open_time") % 11 == 0, "trade").otherwise("kline").alias("e"), F.col("symbol").alias("s"), k.alias("k")).alias("data"))
    return candles_h(spark, sf_dir).select(F.when(F.hour("open_time") == 13, F.lit('{"data":')).otherwise(F.to_json(body)).alias("payload"))


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per raw candle in three partitions with dense offsets."""
    from pyspark.sql import Window

    raw = raw_candles(spark, sf_dir)
    w = Window.partitionBy(F.col("trades") % 3).orderBy("open_time", "symbol", "close_time")
    return raw.select(F.lit("prices").alias("topic"), (F.col("trades") % 3).cast("int").alias("partition"), (F.row_number().over(w) - 1).cast("long").alias("offset"), F.to_json(F.struct(*raw.columns)).alias("value"))


def predictions_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic stand-in for a model's output."""
    short = (2 * F.col("taker_buy_base") / F.col("volume") - 1) / 100
    long = (F.col("close") - F.col("open")) / F.col("open") / 10
    sign = lambda c: F.when(c > 0.0015, 2).when(c < -0.0015, 0).otherwise(1)
    return candles_h(spark, sf_dir).select("open_time", "symbol", "date", F.round(short, 8).alias("return_short"), F.round(long, 8).alias("return_long"),
                                           sign(short).alias("sign_short"), sign(long).alias("sign_long"), F.round(short, 8).alias("prediction"), F.when(F.col("trades") % 2 == 0, "v2").otherwise("v1").alias("model_version"))


def sentiment_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("ts").alias("event_time"), F.col("event_type").alias("symbol"), F.concat(F.lit("src"), F.col("user_id") % 4).alias("source"), _k().alias("engagement"))


def sentiment_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = (F.col("engagement") - 49.5) / 50
    return (sentiment_silver(spark, sf_dir).groupBy(F.date_trunc("hour", "event_time").alias("window_start"), "symbol")
            .agg(F.avg(s).alias("sentiment_index"), F.avg(F.abs(s)).alias("avg_confidence"), F.count(F.lit(1)).cast("int").alias("message_count"))
            .withColumn("window_date", F.to_date("window_start")))


def trades_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("agg_id"), F.col("event_type").alias("symbol"), F.col("ts").alias("timestamp"), F.col("value").alias("price"), _k().cast("double").alias("qty"), (F.col("user_id") % 2 == 0).alias("is_buyer_maker"))


def oi_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_h(spark, sf_dir).select("symbol", F.col("open_time").alias("timestamp"), F.col("volume").alias("sum_open_interest"), (F.col("taker_buy_base") / F.col("volume")).alias("sum_taker_long_short_vol_ratio"))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last processed times before 20 January, of all symbols but one."""
    return candles_h(spark, sf_dir).where("open_time < timestamp'2024-01-20' AND symbol <> 'view'").groupBy("symbol").agg(F.max("open_time").alias("last_processed_time"))


# The same views in DuckDB's dialect.
SQL = {
    "candles_h": """SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
        arg_max(value, (ts, event_id)) AS close, sum(value) AS volume, sum(value * value) AS quote_volume, CAST(count(*) AS INT) AS trades,
        coalesce(sum(value) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INT) % 2 = 0), 0) AS taker_buy_base,
        coalesce(sum(value * value) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INT) % 2 = 0), 0) AS taker_buy_quote,
        CAST(date_trunc('hour', ts) AS DATE) AS date FROM events GROUP BY event_type, date_trunc('hour', ts)""",
    "candles_d": """SELECT p_brand AS symbol, date_trunc('day', l_shipdate) AS open_time, arg_min(px, (l_orderkey, l_linenumber)) AS open, max(px) AS high, min(px) AS low,
        arg_max(px, (l_orderkey, l_linenumber)) AS close, sum(l_quantity) AS volume, sum(l_extendedprice) AS quote_volume, CAST(count(*) AS INT) AS trades,
        coalesce(sum(l_quantity) FILTER (WHERE l_discount >= 0.05), 0) AS taker_buy_base, coalesce(sum(l_extendedprice) FILTER (WHERE l_discount >= 0.05), 0) AS taker_buy_quote,
        CAST(date_trunc('day', l_shipdate) AS DATE) AS date
        FROM (SELECT *, l_extendedprice / l_quantity AS px FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY p_brand, date_trunc('day', l_shipdate)""",
    "raw_candles": """SELECT symbol, CASE WHEN trades % 2 = 0 THEN epoch_us(open_time) ELSE epoch_ms(open_time) END AS open_time,
        CASE WHEN trades % 2 = 0 THEN epoch_us(open_time) + 3599999999 ELSE epoch_ms(open_time) + 3599999 END AS close_time,
        open, high, low, close, volume, quote_volume, trades, taker_buy_base, taker_buy_quote
        FROM (SELECT * FROM candles_h UNION ALL SELECT * FROM candles_h WHERE hour(open_time) % 7 = 0)""",
    "predictions_in": """SELECT open_time, symbol, date, round((2 * taker_buy_base / volume - 1) / 100, 8) AS return_short, round((close - open) / open / 10, 8) AS return_long,
        CASE WHEN (2 * taker_buy_base / volume - 1) / 100 > 0.0015 THEN 2 WHEN (2 * taker_buy_base / volume - 1) / 100 < -0.0015 THEN 0 ELSE 1 END AS sign_short,
        CASE WHEN (close - open) / open / 10 > 0.0015 THEN 2 WHEN (close - open) / open / 10 < -0.0015 THEN 0 ELSE 1 END AS sign_long,
        round((2 * taker_buy_base / volume - 1) / 100, 8) AS prediction, CASE WHEN trades % 2 = 0 THEN 'v2' ELSE 'v1' END AS model_version FROM candles_h""",
    "sentiment_silver": """SELECT ts AS event_time, event_type AS symbol, concat('src', user_id % 4) AS source, CAST(json_extract_string(props, '$.k') AS INT) AS engagement FROM events""",
    "sentiment_gold": """SELECT date_trunc('hour', event_time) AS window_start, symbol, avg((engagement - 49.5::DOUBLE) / 50) AS sentiment_index, avg(abs(engagement - 49.5::DOUBLE) / 50) AS avg_confidence,
        CAST(count(*) AS INT) AS message_count, CAST(date_trunc('hour', event_time) AS DATE) AS window_date FROM sentiment_silver GROUP BY symbol, date_trunc('hour', event_time)""",
    "trades_in": """SELECT event_id AS agg_id, event_type AS symbol, ts AS "timestamp", value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS qty, user_id % 2 = 0 AS is_buyer_maker FROM events""",
    "oi_in": """SELECT symbol, open_time AS "timestamp", volume AS sum_open_interest, taker_buy_base / volume AS sum_taker_long_short_vol_ratio FROM candles_h""",
    "marks": """SELECT symbol, max(open_time) AS last_processed_time FROM candles_h WHERE open_time < TIMESTAMP '2024-01-20' AND symbol <> 'view' GROUP BY symbol""",
}
