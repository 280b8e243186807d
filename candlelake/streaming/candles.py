"""Candle streams: bronze and silver as stateless or watermarked transformations, and the layers by micro-batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.functions.columns import normalize_epoch
from candlelake.operators.clean import KEY, bronze_candles, silver_candles
from candlelake.plans.medallion import LATE, gold_incremental, gold_with_history, tail_of, too_late
from candlelake.sources.io import max_offsets, parse_topic_values
from candlelake.sources.schemas import RAW

MODES = ("append", "update", "complete")


def stream_bronze(sdf: DataFrame, watermark: str = "1 day", source: str = "stream") -> DataFrame:
    """Bronze rows of a raw stream: one per key; rows later than the watermark go, and so does their state."""
    out = sdf.where(F.col("open_time") > 10**12).withColumns({"open_time": normalize_epoch("open_time"), "close_time": normalize_epoch("close_time")})
    out = out.withColumns({"date": F.to_date("open_time"), "source": F.lit(source)})
    return out.withWatermark("open_time", watermark).dropDuplicates(list(KEY))


def stream_silver(sdf: DataFrame) -> DataFrame:
    """The silver rules are filters and casts, so they hold on a stream as they are."""
    return silver_candles(sdf)


def stream_append(sdf: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None, partition_by: tuple[str, ...] = ("symbol", "date"), name: str | None = None, keys: tuple[str, ...] = ()) -> StreamingQuery:
    """Writes a stream to Parquet; trigger is {"availableNow": True} or {"processingTime": "5 minutes"}.

    Spark's file sink appends only. With mode "update" each batch writes the rows that it changed as a version of its own, and
    with "complete" a version of the whole result, which takes the place of the one before; a batch that is repeated replaces
    its version. ``read_versions`` reads either; updates are merged by ``keys``.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {', '.join(MODES)}")
    if mode == "update" and not keys:
        raise ValueError("mode 'update' needs the keys that rows are merged by")
    writer = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 minutes"}))
    if mode == "append":
        writer = writer.format("parquet").option("path", path).partitionBy(*partition_by)
    else:
        writer = writer.foreachBatch(lambda batch, number: _write_version(batch, path, number, mode == "complete"))
    return (writer.queryName(name) if name else writer).start()


def _write_version(batch: DataFrame, path: str, number: int, alone: bool) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/v={number}")
    folder = _Folder(batch.sparkSession, path)
    for n in folder.names("v=") if alone else ():
        if int(n[2:]) < number:
            folder.delete(n)


def read_versions(spark: SparkSession, path: str, keys: tuple[str, ...] = ()) -> DataFrame | None:
    """What a stream has brought a table to: the newest row of each key, or the newest version without keys. None before the
    first batch. Versions that aren't finished don't count."""
    folder = _Folder(spark, path)
    done = sorted(int(n[2:]) for n in folder.names("v=") if folder.fs.exists(folder.hadoop.Path(folder.child(n), "_SUCCESS")))
    if not done:
        return None
    if not keys:
        return spark.read.parquet(f"{path}/v={done[-1]}")
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/v={n}" for n in done])
    return _newest(rows, keys).select(*[c for c in rows.columns if c != "v"])


@dataclass
class LayerPaths:
    silver: str
    gold: str
    offsets: str
    tail: str = ""

    def __post_init__(self):
        self.tail = self.tail or f"{self.silver}_tail"


class _Folder:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.path = self.hadoop.Path(path)
        self.fs = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def child(self, name: str):
        return self.hadoop.Path(self.path, name)

    def names(self, prefix: str = "") -> list[str]:
        found = self.fs.listStatus(self.path) if self.fs.exists(self.path) else []
        return sorted(n for n in (s.getPath().getName() for s in found) if n.startswith(prefix))

    def delete(self, name: str) -> None:
        self.fs.delete(self.child(name), True)


def _finished(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch whose rows are all written to a layer."""
    marks = [int(n[6:]) for n in _Folder(spark, f"{path}/_finished").names("batch=")]
    return max(marks, default=None)


def _write(df: DataFrame, path: str, number: int) -> None:
    """The rows of a batch by date, and no others: earlier batches stay as they are. The mark of the batch comes last; one
    that is repeated after a failure replaces what it wrote."""
    rows = df.withColumn("v", F.lit(number).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "v").parquet(path)
    marks = _Folder(df.sparkSession, f"{path}/_finished")
    marks.fs.mkdirs(marks.child(f"batch={number:012d}"))
    for name in marks.names("batch="):
        if int(name[6:]) < number:
            marks.delete(name)


def _newest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Of each key the row of the latest batch."""
    rest = [c for c in rows.columns if c not in (*keys, "v")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("v", *rest)).alias("__row")).select(*keys, "__row.*")


def read_layer(spark: SparkSession, path: str, keys: tuple[str, ...] = KEY, before: int | None = None) -> DataFrame | None:
    """What the stream has brought a layer to: of each key the row of the latest batch. None before the first batch.

    A row's date follows from its key, so rows of a date are merged by key within it: a filter on the date reaches the
    files, and only those days are read and merged.
    """
    last = _finished(spark, path)
    if last is None or not _Folder(spark, path).names("date="):
        return None
    rows = spark.read.parquet(path).where(F.col("v") <= (last if before is None else min(last, before - 1)))
    return _newest(rows, ("date", *keys)).select(*keys, *[c for c in rows.columns if c not in (*keys, "v")])


def compact_layer(spark: SparkSession, path: str, date: dt.date, keys: tuple[str, ...] = KEY) -> None:
    """Merges what the finished batches wrote for a day into one version; to be run when no batch writes that day."""
    last, name = _finished(spark, path), f"date={date.isoformat()}"
    folder = _Folder(spark, path)
    if last is None or name not in folder.names("date="):
        return
    rows = spark.read.parquet(path).where((F.col("date") == F.lit(date)) & (F.col("v") <= last))
    _newest(rows, ("date", *keys)).withColumn("v", F.lit(last).cast("long")).write.mode("overwrite").partitionBy("date", "v").parquet(f"{path}/_compacted")
    # The old day steps aside before the new one comes, and goes last.
    folder.fs.rename(folder.child(name), folder.child(f"_old-{name}"))
    folder.fs.rename(folder.child(f"_compacted/{name}"), folder.child(name))
    folder.delete(f"_old-{name}")
    folder.delete("_compacted")


def read_offsets(spark: SparkSession, path: str) -> DataFrame | None:
    """The highest offset of each topic and partition; None before the first batch."""
    last = _finished(spark, path)
    return None if last is None else spark.read.parquet(f"{path}/v={last}").drop("v")


def _write_offsets(batch: DataFrame, path: str, number: int) -> None:
    """All offsets so far: those of the version before, and the batch's. Older versions go."""
    spark, new = batch.sparkSession, max_offsets(batch)
    folder = _Folder(spark, path)
    earlier = [int(n[2:]) for n in folder.names("v=") if int(n[2:]) < number]
    if earlier:
        new = new.unionByName(spark.read.parquet(f"{path}/v={max(earlier)}")).groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    new.coalesce(1).write.mode("overwrite").parquet(f"{path}/v={number}")
    marks = _Folder(spark, f"{path}/_finished")
    marks.fs.mkdirs(marks.child(f"batch={number:012d}"))
    for v in sorted(earlier)[:-1]:
        folder.delete(f"v={v}")
        marks.delete(f"batch={v:012d}")


class Tail:
    """The tail of the silver layer (see ``plans.medallion.tail_of``) as a table that each batch adds to.

    A version is the tail after its batch; the rows of the batches since then lie beside it. Every few batches a new version is
    written, so a batch writes its own rows nearly always, and reads one version and the few batches after it. A batch that is
    repeated reads what was there before it: one version more than the last is kept for that.
    """

    def __init__(self, spark: SparkSession, path: str, interval_s: int, late_s: int, every: int = 16):
        self.spark, self.path, self.interval_s, self.late_s, self.every = spark, path, interval_s, late_s, every

    def _written(self, kind: str) -> list[int]:
        folder = _Folder(self.spark, f"{self.path}/{kind}")
        return sorted(int(n[2:]) for n in folder.names("v=") if folder.fs.exists(folder.hadoop.Path(folder.child(n), "_SUCCESS")))

    def read(self, before: int) -> DataFrame | None:
        """The tail as it was before a batch; None if nothing has been written."""
        versions, batches = ([v for v in self._written(kind) if v < before] for kind in ("version", "batch"))
        last = max(versions, default=-1)
        parts = [f"{self.path}/version/v={last}"] if versions else []
        parts += [f"{self.path}/batch/v={v}" for v in batches if v > last]
        if not parts:
            return None
        rows = reduce(DataFrame.unionByName, [self.spark.read.parquet(p).withColumn("v", F.lit(k)) for k, p in enumerate(parts)])
        return _newest(rows, KEY).select(*[c for c in rows.columns if c != "v"])

    def begin(self, rows: DataFrame, number: int) -> None:
        """The first version, of a layer that was there before its tail."""
        tail_of(rows, self.interval_s, self.late_s).write.mode("overwrite").parquet(f"{self.path}/version/v={number}")

    def add(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch/v={number}")
        versions = [v for v in self._written("version") if v < number]
        if number - max(versions, default=-1) >= self.every:
            self.begin(self.read(number + 1), number)
            for kind in ("version", "batch"):
                for v in self._written(kind):
                    if v < max(versions, default=-1) + (kind == "batch"):
                        _Folder(self.spark, f"{self.path}/{kind}").delete(f"v={v}")


def stream_medallion(source_sdf: DataFrame, paths: LayerPaths, checkpoint: str, interval_s: int, trigger: dict | None = None, on_batch: Callable[[DataFrame, int], None] | None = None, reemit: bool = True, late_s: int = LATE) -> StreamingQuery:
    """Topic messages to silver and gold. For each micro-batch: parse, bronze, silver, features of the new rows from the
    tail of what came before, then offsets last; a batch that is repeated after a failure replaces what it wrote.

    A batch reads the tail, whose size doesn't grow with the layers, and no file of silver or gold; only if a row comes more
    than ``late_s`` seconds late, the days that its features reach back to. It writes its own rows by date; with ``reemit``,
    also the features of rows after a late one, which it changes. Readers merge by key, the latest batch first. ``on_batch``
    gets the gold rows of the batch.
    """

    def layer(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        silver = silver_candles(bronze_candles(parse_topic_values(batch, RAW), "stream")).persist()
        tail = Tail(spark, paths.tail, interval_s, late_s)
        try:
            held = tail.read(number)
            if held is None and (before := read_layer(spark, paths.silver, before=number)) is not None:
                tail.begin(before, number - 1)
                held = tail.read(number)
            held = silver.limit(0) if held is None else held
            if too_late(silver, held, late_s).isEmpty():
                gold = gold_incremental(silver, held, interval_s, reemit)
            else:
                gold = gold_with_history(silver, read_layer(spark, paths.silver, before=number), interval_s, reemit)
            _write(gold, paths.gold, number)
            if on_batch:
                on_batch(spark.read.parquet(paths.gold).where(F.col("v") == number).drop("v"), number)
            _write(silver, paths.silver, number)
            tail.add(silver, number)
            _write_offsets(batch, paths.offsets, number)
        finally:
            silver.unpersist()

    return source_sdf.writeStream.foreachBatch(layer).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
