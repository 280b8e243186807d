"""Sources, sinks, state tables and table maintenance. Tables are Parquet folders partitioned by (symbol, date)."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.functions.columns import col
from candlelake.sources.schemas import RAW

PARTITIONS = ("symbol", "date")
TIME_COLUMNS = ("open_time", "event_time", "ingestion_time")

# The places of a positional candle array, and the short field names of a candle message.
ARRAY_PLACES = {"open_time": 0, "open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "close_time": 6, "quote_volume": 7, "trades": 8, "taker_buy_base": 9, "taker_buy_quote": 10}
MESSAGE_FIELDS = {"symbol": "s", "open_time": "t", "close_time": "T", "open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "quote_volume": "q", "trades": "n", "taker_buy_base": "V", "taker_buy_quote": "Q"}


class SchemaMismatch(ValueError):
    """Columns are missing or have another type than the schema declares."""


def scan_candle_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV files under the declared schema; path may be a glob."""
    return spark.read.schema(RAW).option("header", True).csv(path)


def _typed(values: dict[str, Column]) -> list[Column]:
    """Raw candle columns from text; what can't be read is null."""
    return [(values[f.name] if f.name == "symbol" else values[f.name].try_cast(f.dataType)).alias(f.name) for f in RAW]


def parse_kline_arrays(df: DataFrame, json_col: str = "payload", symbol_col: str = "symbol") -> DataFrame:
    a = F.from_json(json_col, "array<string>")
    return df.select(*_typed({"symbol": F.col(symbol_col)} | {n: F.get(a, F.lit(i)) for n, i in ARRAY_PLACES.items()}))


def parse_kline_events(df: DataFrame, json_col: str = "payload") -> DataFrame:
    """Closed candles among nested messages; other messages, open candles and broken ones go."""
    # Field names differ only in case, which column resolution ignores; the message is read as a map of text instead.
    event = F.from_json(json_col, "struct<data:struct<e:string,k:map<string,string>>>")
    rows = df.select(event["data"].alias("m")).where((F.col("m.e") == "kline") & (F.col("m.k")["x"] == "true"))
    return rows.select(*_typed({n: F.col("m.k")[s] for n, s in MESSAGE_FIELDS.items()}))


def parse_topic_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The JSON value of each message as columns; batch or stream."""
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def encode_topic_values(df: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Rows as JSON payloads, without the column ``ignore``; with key columns, those as JSON in ``key``."""
    df = df.drop("ignore")
    key = [F.to_json(F.struct(*key_cols)).alias("key")] if key_cols else []
    return df.select(*key, F.to_json(F.struct(*df.columns)).alias("value"))


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, filters: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.where(filters) if filters else df
    return df.select(*columns) if columns else df


def read_range(df: DataFrame, columns: list[str], symbol: str | None = None, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """The columns that exist, of a symbol and time range; date prunes partitions, the exact time does the rest."""
    time = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if symbol is not None and "symbol" in df.columns:
        df = df.where(F.col("symbol") == symbol)
    for bound, above in ((start, True), (end, False)):
        if bound is None:
            continue
        if "date" in df.columns:
            df = df.where(F.col("date") >= F.lit(bound.date()) if above else F.col("date") <= F.lit(bound.date()))
        if time:
            df = df.where(F.col(time) >= F.lit(bound) if above else F.col(time) <= F.lit(bound))
    present = [c for c in columns if c in df.columns]
    return df.orderBy(*[c for c in TIME_COLUMNS if c in df.columns]).select(*present)


def read_incremental(df: DataFrame, last_value: dt.datetime | None, symbols: list[str] | None = None, time: str = "open_time") -> DataFrame:
    """Rows after last_value; all of them without one."""
    if symbols:
        df = df.where(F.col("symbol").isin(symbols))
    if last_value is None:
        return df
    return df.where((F.col("date") >= F.lit(last_value.date())) & (F.col(time) > F.lit(last_value)))


def read_incremental_by_key(df: DataFrame, state: DataFrame, lookback: str | None = None, by: str = "symbol", time: str = "open_time", mark: str = "last_processed_time") -> DataFrame:
    """Rows after their symbol's mark, less a lookback (an interval such as "30 minutes"); symbols without a mark go.

    The state has one row per symbol; Spark broadcasts it when it is small. The date bound prunes partitions.
    """
    back = F.expr(f"INTERVAL {lookback}") if lookback else F.expr("INTERVAL 0 SECONDS")
    state = state.select(F.col(by).alias("__by"), (F.col(mark) - back).alias("__mark"))
    low = state.agg(F.to_date(F.min("__mark")).alias("__low"))
    rows = df.join(F.broadcast(low), F.col("date") >= F.col("__low"), "left_semi") if "date" in df.columns else df
    return rows.join(state, (F.col(by) == F.col("__by")) & (F.col(time) > F.col("__mark"))).select(*df.columns)


def latest_partition(table: DataFrame, partition: str = "date") -> str | int | None:
    """The largest value of a partition column among a table's files, as the file index of its folder has them: no data is
    read. None for a table without partitions; null partitions don't count. Values are compared as numbers if the column is
    one, else as text, which is the order of dates."""
    whole = isinstance(table.schema[partition].dataType, T.IntegralType)
    found = {unquote(m[1]) for m in (re.search(rf"/{re.escape(partition)}=([^/]+)/", f) for f in table.inputFiles()) if m}
    return max((int(v) if whole else v for v in found - {"__HIVE_DEFAULT_PARTITION__"}), default=None)


def read_latest_partition(table: DataFrame | str, partition: str = "date", spark: SparkSession | None = None) -> DataFrame:
    """The rows of the latest partition. Of a path (with spark) it is taken from the names of the folders, and only its files
    are read; of other tables from the rows."""
    if isinstance(table, str):
        rows = spark.read.parquet(table)
        last = latest_partition(rows, partition)
        return rows.limit(0) if last is None else rows.where(F.col(partition) == F.lit(last).cast(rows.schema[partition].dataType))
    last = table.agg(F.max(partition).alias("__last"))
    return table.join(F.broadcast(last), F.col(partition) == F.col("__last"), "left_semi")


def last_value(df: DataFrame, column: str = "open_time") -> DataFrame:
    """One row, with the maximum or null."""
    return df.agg(F.max(column).alias("last_value"))


def last_processed_by_symbol(state: DataFrame, symbols: list[str], fallback: dt.datetime, by: str = "symbol", mark: str = "last_processed_time") -> DataFrame:
    wanted = state.sparkSession.createDataFrame([(s,) for s in symbols], f"{by} string")
    marks = state.groupBy(by).agg(F.max(mark).alias(mark))
    return wanted.join(marks, by, "left").select(by, F.coalesce(mark, F.lit(fallback)).alias(mark))


def advance_state(state: DataFrame, processed: DataFrame, by: str = "symbol", time: str = "open_time", mark: str = "last_processed_time") -> DataFrame:
    new = processed.groupBy(by).agg(F.max(time).alias(mark))
    return state.select(by, mark).unionByName(new).groupBy(by).agg(F.max(mark).alias(mark))


def max_offsets(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def resume_offsets(partitions: DataFrame, state: DataFrame) -> DataFrame:
    """Where to go on in each partition; -2, the earliest offset, where nothing was read yet."""
    known = state.select("topic", "partition", F.col("offset").alias("__read"))
    return partitions.select("topic", "partition").distinct().join(known, ["topic", "partition"], "left").select("topic", "partition", F.coalesce(F.col("__read") + 1, F.lit(-2)).cast("long").alias("offset"))


def align_to_schema(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns in order; raises when one is missing or has another type. Nullability doesn't matter."""
    have = {f.name: f.dataType for f in df.schema}
    if missing := [f.name for f in schema if f.name not in have] + [c for c in required if c not in have]:
        raise SchemaMismatch(f"missing columns: {', '.join(dict.fromkeys(missing))}")
    if wrong := [f"{f.name}: {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in schema if have[f.name] != f.dataType]:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(*schema.names)


def add_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_time", F.current_timestamp())


def write_partitioned(df: DataFrame, path: str, schema: T.StructType | None = None, mode: str = "append", partition_by: tuple[str, ...] = PARTITIONS) -> None:
    """Append, or overwrite the partitions that df has rows of; the rows are dealt by partition, so files stay few."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r} is neither append nor overwrite")
    if missing := [c for c in partition_by if c not in df.columns]:
        raise SchemaMismatch(f"missing partition columns: {', '.join(missing)}")
    df = align_to_schema(df, schema, partition_by) if schema else df
    # A rebalance splits a partition that holds much of the data, where dealing by its key alone would not.
    df.hint("rebalance", *partition_by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def upsert(target: DataFrame, source: DataFrame, keys: list[str] | tuple[str, ...] = ("symbol", "open_time")) -> DataFrame:
    """Target rows with those of the source in place of equal keys, and the source's new ones."""
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str] | tuple[str, ...] = ("symbol", "open_time")) -> DataFrame:
    """Target rows and the source's rows of new keys, one for each."""
    new = source.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def snapshot_as_of(df: DataFrame, ts: dt.datetime | Column, keys: list[str] | tuple[str, ...] = ("symbol", "open_time"), version: str = "ingestion_time") -> DataFrame:
    """The latest row of each key that was there at ts."""
    ts = ts if isinstance(ts, Column) else F.lit(ts)
    rest = [c for c in df.columns if c not in keys]
    newest = df.where(col(version) <= ts).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest if c != version])).alias("__row"))
    return newest.select(*keys, "__row.*").select(*df.columns)


def training_snapshot(gold: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Expected columns, cleaned for training, written as Parquet and read back."""
    from candlelake.operators.clean import sanitize_features

    sanitize_features(gold.select(*[c for c in columns if c in gold.columns])).write.mode("overwrite").parquet(path)
    return gold.sparkSession.read.parquet(path)
