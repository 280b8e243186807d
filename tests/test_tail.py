"""Features of new rows from the tail of what came before: equal to a full run, without the history."""

import datetime as dt
import shutil

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.operators import clean, features
from candlelake.plans import medallion
from candlelake.sources import schemas
from candlelake.streaming import candles as streams

from .test_operators import T0, candles

HOUR = 3600


@pytest.fixture(scope="module")
def silver(spark):
    """A dense symbol, a sparse one, and one that begins late; 30 days of hours."""
    rng = np.random.default_rng(11)
    series = lambda s, start: (start + rng.normal(0, 1, 24 * 30).cumsum() / 10).tolist()
    hour, day = F.hour("open_time"), F.dayofmonth("open_time")
    dense = candles(spark, series("d", 100), "dense").where(hour % 7 != 3)
    sparse = candles(spark, series("s", 50), "sparse").where((hour == 5) & (day % 4 == 1))
    late = candles(spark, series("l", 70), "late").where(day > 20)
    return clean.silver_candles(dense.unionByName(sparse).unionByName(late)).cache()


def same(ours, want):
    key = lambda d: d.toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    a, b = key(ours.select(*want.columns)), key(want)
    pd.testing.assert_frame_equal(a, b)
    assert len(a)


def at(hours):
    return F.lit(T0 + dt.timedelta(hours=hours))


def test_batches_from_tails_equal_a_full_run(spark, silver, tmp_path):
    """Each batch is computed from the written tail alone; symbols come anew and pause for many batches."""
    time, want = F.col("open_time"), features.gold_features(silver, HOUR)
    bounds, tail = [0, 100, 300, 310, 311, 600, 720], silver.limit(0)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        batch = silver.where((time >= at(a)) & (time < at(b)))
        same(medallion.gold_incremental(batch, tail, HOUR), want.where((time >= at(a)) & (time < at(b))))
        medallion.advance_tail(tail, batch, HOUR).write.parquet(str(tmp_path / f"{i}"))
        tail = spark.read.parquet(str(tmp_path / f"{i}"))
    # 3 days and one of lateness, and six rows before them.
    assert {r["symbol"]: r["count"] for r in tail.groupBy("symbol").count().collect()}["dense"] <= 4 * 24 + 1 + 6


def test_late_rows_and_what_they_change(silver):
    time, late = F.col("open_time"), (F.col("symbol") == "dense") & (F.hour("open_time") % 5 == 1)
    history = silver.where((time < at(600)) & ~(late & (time >= at(580))))
    batch = silver.where((time >= at(580)) & (time < at(610)) & (late | (time >= at(600))))
    tail = medallion.tail_of(history, HOUR)
    assert medallion.too_late(batch, tail).isEmpty()
    want = features.gold_features(silver.where(time < at(610)), HOUR)
    same(medallion.gold_incremental(batch, tail, HOUR), want.join(batch.select("symbol", "open_time"), ["symbol", "open_time"], "left_semi"))
    first = batch.groupBy("symbol").agg(F.min("open_time").alias("f"))
    same(medallion.gold_incremental(batch, tail, HOUR, reemit=True), want.join(first, "symbol").where("open_time >= f").drop("f"))
    assert medallion.too_late(silver.where(time < at(500)), tail).count() > 0


def test_no_job_runs_and_no_history_is_read_for_a_batch(spark, silver, tmp_path):
    """The plan reads the tail and the batch, and building it starts no job."""
    silver.where("open_time < timestamp'2024-01-25'").write.partitionBy("date").parquet(str(tmp_path / "history"))
    medallion.tail_of(spark.read.parquet(str(tmp_path / "history")).select(*silver.columns), HOUR).write.parquet(str(tmp_path / "tail"))
    silver.where("open_time >= timestamp'2024-01-25'").write.parquet(str(tmp_path / "batch"))
    batch, tail = spark.read.parquet(str(tmp_path / "batch")), spark.read.parquet(str(tmp_path / "tail"))
    spark.sparkContext.setJobGroup("definition", "no job")
    out = medallion.gold_incremental(batch, tail, HOUR)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("definition")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {f.split("/")[-2] for f in out.inputFiles()} == {"batch", "tail"}


def messages(df):
    ms = F.unix_millis("open_time")
    raw = df.select("symbol", ms.alias("open_time"), (ms + 3599999).alias("close_time"), *[c for c in schemas.RAW.names if c not in ("symbol", "open_time", "close_time")])
    return raw.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.to_json(F.struct(*raw.columns)).alias("value")).coalesce(1)


def test_a_stream_reads_no_file_of_its_layers(spark, silver, tmp_path):
    """All days of silver and gold are taken away before the last batches, which give the same rows."""
    raw, time = silver.drop("date"), F.col("open_time")
    paths = streams.LayerPaths(*[str(tmp_path / n) for n in ("silver", "gold", "offsets")])
    bounds = [0, 300, 340, 380, 420, 480, 720]
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if i == 4:
            for name in ("silver", "gold"):
                for day in (tmp_path / name).glob("date=*"):
                    shutil.rmtree(day)
        # Some rows are late, by less than a day.
        late = (F.col("symbol") == "dense") & (time >= at(b - 10)) & (F.hour("open_time") % 3 == 0)
        was = (F.col("symbol") == "dense") & (time >= at(a - 10)) & (time < at(a)) & (F.hour("open_time") % 3 == 0)
        messages(raw.where((time >= at(a)) & (time < at(b)) & ~late | was)).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("topic string, partition int, offset long, value string").parquet(str(tmp_path / "in"))
        streams.stream_medallion(source, paths, str(tmp_path / "cp"), HOUR).awaitTermination()
    seen = silver.where((time < at(720 - 10)) | (F.col("symbol") != "dense") | (F.hour("open_time") % 3 != 0))
    same(streams.read_layer(spark, paths.gold).where(time >= at(420)), features.gold_features(seen, HOUR).where(time >= at(420)))


def test_versions_of_a_tail(spark, silver, tmp_path):
    tail, time = streams.Tail(spark, str(tmp_path / "tail"), HOUR, medallion.LATE, every=3), F.col("open_time")
    assert tail.read(0) is None
    for n in range(9):
        tail.add(silver.where((time >= at(60 * n)) & (time < at(60 * n + 60))), n)
    assert len(tail._written("version")) == 2 and max(tail._written("version")) == 8 and min(tail._written("batch")) > min(tail._written("version"))
    for before in (9, 8, 7):
        so_far = silver.where(time < at(60 * before))
        batch = silver.where((time >= at(60 * before)) & (time < at(60 * before + 30)))
        same(medallion.gold_incremental(batch, tail.read(before), HOUR), features.gold_features(so_far.unionByName(batch), HOUR).where(time >= at(60 * before)))
