"""Sinks of streams in all modes, and the latest partition from the names of folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlelake.sources import io
from candlelake.streaming import candles as streams

from .test_operators import T0, candles


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_an_aggregate_in_batches(spark, tmp_path, mode):
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(candles(spark, [1.0]).schema).parquet(str(tmp_path / "in"))
    sums = source.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("close").alias("total"))
    path, keys, seen = str(tmp_path / "out"), ("symbol",) if mode == "update" else (), {}
    assert streams.read_versions(spark, path, keys) is None
    for values in ({"a": [1.0, 2.0], "b": [5.0]}, {"b": [7.0], "c": [1.0]}, {"a": [10.0]}):
        for symbol, closes in values.items():
            candles(spark, closes, symbol).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            seen[symbol] = seen.get(symbol, []) + closes
        streams.stream_append(sums, path, str(tmp_path / "cp"), mode, {"availableNow": True}, keys=("symbol",)).awaitTermination()
        assert {r.symbol: (r.n, r.total) for r in streams.read_versions(spark, path, keys).collect()} == {s: (len(x), sum(x)) for s, x in seen.items()}
    written = [spark.read.parquet(str(p)).count() for p in sorted((tmp_path / "out").glob("v=*"))]
    assert written == ([2, 2, 1] if mode == "update" else [3])  # changed rows only, or the whole result


def test_modes_are_checked_at_once(spark, tmp_path):
    with pytest.raises(ValueError, match="keys"):
        streams.stream_append(candles(spark, [1.0]), "x", "y", "update")
    with pytest.raises(ValueError, match="none of"):
        streams.stream_append(candles(spark, [1.0]), "x", "y", "replace")


def test_the_latest_partition_is_read_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    days = candles(spark, [float(i) for i in range(24 * 12)]).unionByName(candles(spark, [1.0], "y", start=T0 + dt.timedelta(days=3)))
    io.write_partitioned(days, path)
    out = io.read_latest_partition(path, spark=spark)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and "Exchange" not in plan
    assert "2024-01-12" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert out.count() == 24 and {r.date for r in out.collect()} == {dt.date(2024, 1, 12)}
    assert sorted(map(tuple, out.select("symbol", "close").collect())) == sorted(map(tuple, io.read_latest_partition(spark.read.parquet(path)).select("symbol", "close").collect()))


def test_partitions_of_numbers_nulls_and_none(spark, tmp_path):
    spark.createDataFrame([(9, 1.0), (10, 2.0), (None, 3.0)], "k int, x double").write.partitionBy("k").parquet(str(tmp_path / "n"))
    assert [r.x for r in io.read_latest_partition(str(tmp_path / "n"), "k", spark).collect()] == [2.0]
    spark.createDataFrame([(None, 3.0)], "k int, x double").write.parquet(str(tmp_path / "flat"))
    assert io.read_latest_partition(str(tmp_path / "flat"), "k", spark).count() == 0
