"""Hand-computed cases: nulls, zero denominators, single rows, ties, gaps, empty tables; parity properties."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.functions.columns import normalize_epoch, safe_divide, trailing
from candlelake.functions.stretches import with_ewm
from candlelake.operators import aggs, clean, drift, evaluate, features, joins, labels, ml
from candlelake.plans.halo import gold_features_by_stretch, with_halo
from candlelake.plans import medallion
from candlelake.plans.medallion import gold_incremental
from candlelake.sources import io, schemas
from candlelake.streaming import candles as streams

T0 = dt.datetime(2024, 1, 1)
CANDLE = "symbol string, open_time timestamp, open double, high double, low double, close double, volume double, quote_volume double, trades int, taker_buy_base double, taker_buy_quote double, date date"


def candles(spark, closes, symbol="x", step=3600, start=T0):
    rows = [(symbol, start + dt.timedelta(seconds=step * i), c, c + 1.0, c - 1.0, c, 10.0, 100.0, 3, 4.0, 40.0, (start + dt.timedelta(seconds=step * i)).date()) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, CANDLE)


def test_safe_divide(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, 1e-7), (1.0, None)], "a double, b double")
    assert [r[0] for r in rows.select(safe_divide("a", "b")).collect()] == [0.5, 0.0, 0.0, 0.0]


def test_normalize_epoch_tells_units_apart(spark):
    rows = spark.createDataFrame([(1704067200,), (1704067200999,), (1704067200999999,), (None,)], "t long")
    assert [r[0] for r in rows.select(normalize_epoch("t")).collect()] == [T0, T0, T0, None]


def test_first_row_isnt_valid_and_has_no_return(spark):
    out = features.gold_features(candles(spark, [1.0, 2.0, 4.0]), 3600).orderBy("open_time").collect()
    assert [r.is_valid_feature_row for r in out] == [False, True, True]
    assert [round(r.log_return, 6) for r in out] == [0.0, 0.693147, 0.693147]
    assert out[2].log_return_lag2 == 0.0 and out[1].log_return_lag2 is None


def test_features_of_zero_range_and_empty(spark):
    flat = candles(spark, [5.0, 5.0]).withColumns({"high": F.lit(5.0), "low": F.lit(5.0), "volume": F.lit(0.0)})
    out = features.gold_features(flat, 3600).orderBy("open_time").collect()
    assert out[1].close_position == 0.0 and out[1].buy_ratio == 0.0 and out[1].volume_spike == 0.0
    assert features.gold_features(candles(spark, [1.0]).limit(0), 3600).count() == 0


def test_frames_are_time_not_rows(spark):
    df = candles(spark, [1.0, 2.0]).unionByName(candles(spark, [4.0], start=T0 + dt.timedelta(days=10)))
    last = features.gold_features(df, 3600).orderBy(F.desc("open_time")).first()
    assert last.ma_5 == 4.0 and round(last.log_return, 6) == 0.693147


@pytest.mark.parametrize("cut", [1, 40, 99])
def test_incremental_features_equal_a_full_run(spark, cut):
    rng = np.random.default_rng(cut)
    df = candles(spark, (100 * np.exp(rng.normal(0, 0.01, 120).cumsum())).tolist()).where("hour(open_time) % 5 <> 2")
    at = F.lit(T0 + dt.timedelta(hours=cut))
    ours = gold_incremental(df.where(F.col("open_time") >= at), df.where(F.col("open_time") < at), 3600).toPandas().sort_values("open_time", ignore_index=True)
    full = features.gold_features(df, 3600).where(F.col("open_time") >= at).toPandas().sort_values("open_time", ignore_index=True)
    pd.testing.assert_frame_equal(ours[sorted(ours)], full[sorted(full)])


def test_halo_windows_equal_plain_ones(spark):
    df = candles(spark, [float(i) for i in range(100)])
    plain = df.withColumn("s", F.sum("close").over(trailing(24, 3600)))
    halo = with_halo(df, 23 * 3600, 10 * 3600, lambda w: {"s": F.sum("close").over(w.rangeBetween(-23 * 3600, 0))})
    assert sorted(r.s for r in plain.collect()) == sorted(r.s for r in halo.collect())


def test_candle_rules_fail_on_null_and_violation(spark):
    df = candles(spark, [1.0, 2.0, 3.0, 4.0])
    bad = df.withColumns({"low": F.when(F.col("close") == 2, 9.0).otherwise(F.col("low")), "trades": F.when(F.col("close") != 3, F.col("trades"))})
    assert sorted(r.close for r in clean.valid_candle_rules(bad).collect()) == [1.0, 4.0]


def test_dedupe_is_deterministic(spark):
    df = candles(spark, [1.0]).unionByName(candles(spark, [2.0]))
    assert clean.dedupe_latest(df.repartition(4), order_by=[F.desc("close")]).first().close == 2.0


def test_quality_report_of_nothing(spark):
    r = clean.quality_report(candles(spark, [1.0]).limit(0)).first()
    assert not r.is_valid and r.errors == "empty"


def test_sanitize_drops_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, float("inf")), (2.0, 5.0, float("nan")), (None, 5.0, 3.0)], "a double, b double, c double")
    out = clean.sanitize_features(df)
    assert out.columns == ["a", "c"] and sorted(r.c for r in out.collect()) == [0.0, 0.0, 3.0]


def test_range_labels():
    assert clean.range_days("6 hours") == 0.25 and clean.range_days("1 year") == 365 and clean.range_days("Max") == 3650


def test_align_to_schema_raises(spark):
    df = candles(spark, [1.0])
    with pytest.raises(io.SchemaMismatch, match="missing"):
        io.align_to_schema(df.drop("close"), schemas.SILVER)
    with pytest.raises(io.SchemaMismatch, match="trades"):
        io.align_to_schema(io.add_ingestion_time(df.withColumn("trades", F.lit("3"))), schemas.SILVER)


def test_upsert_is_idempotent_and_insert_ignores(spark):
    old, new = candles(spark, [1.0, 2.0]), candles(spark, [9.0, 9.0, 9.0])
    once = io.upsert(old, new)
    assert sorted(r.close for r in io.upsert(once, new).collect()) == [9.0, 9.0, 9.0]
    assert sorted(r.close for r in io.insert_ignore(old, new).collect()) == [1.0, 2.0, 9.0]


def test_write_overwrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_partitioned(candles(spark, [1.0], "a").unionByName(candles(spark, [2.0], "b")), path, mode="overwrite")
    io.write_partitioned(candles(spark, [7.0], "b"), path, mode="overwrite")
    assert {(r.symbol, r.close) for r in spark.read.parquet(path).collect()} == {("a", 1.0), ("b", 7.0)}


def test_kline_messages(spark):
    k = '{"t":1704067200000,"T":1704070799999,"s":"x","o":"1","h":"2","l":"0.5","c":"1.5","v":"3","q":"4","n":5,"V":"1","Q":"2","x":%s}'
    rows = [('{"data":{"e":"kline","s":"x","k":%s}}' % (k % "true"),), ('{"data":{"e":"kline","s":"x","k":%s}}' % (k % "false"),), ('{"data":{"e":"trade"}}',), ("{}",), ("{broken",), (None,)]
    out = io.parse_kline_events(spark.createDataFrame(rows, "payload string")).collect()
    assert len(out) == 1 and out[0].close == 1.5 and out[0].trades == 5 and out[0].taker_buy_base == 1.0 and out[0].volume == 3.0


def test_horizons_and_labels(spark):
    assert [labels.interval_minutes(x) for x in ("1m", "5m", "1h")] == [1, 5, 60]
    assert labels.horizon_steps("1d", "5m") == 288 and labels.horizon_steps("1d", "15m") == 96 and labels.horizon_steps("short", "5m") == 1
    df = spark.createDataFrame([(0.0003,), (-0.0003,), (0.0001,), (None,)], "r double")
    assert [r.sign_r for r in labels.sign_labels(df, "r", 0.0002).collect()] == [2, 0, 1, None]


def test_outputs_follow_tasks(spark):
    df = spark.createDataFrame([(0.1, 0.1, 0.05), (0.2, -0.9, 0.8)], "return_short double, sign_short double, sign_long double")
    tasks = {"return_short": "regression", "sign_short": "classification", "sign_long": "classification"}
    out = ml.postprocess_outputs(df, tasks, 0.2, compat=True).collect()
    assert [r.sign_short for r in out] == [1, 0] and [r.sign_long for r in out] == [1, 1]
    assert clean.align_features(spark.createDataFrame([(1.0, 2.0)], "f1 double, f3 double"), ["f1", "f2"]).first() == (1.0, 0.0)


def test_scorer_is_skipped_for_empty_batches(spark):
    out = ml.score_batches(spark.range(0).selectExpr("CAST(id AS DOUBLE) AS x"), lambda b: b, "x double")
    assert out.count() == 0


def test_backtest_survives_a_total_loss(spark):
    df = spark.createDataFrame([("x", T0 + dt.timedelta(hours=i), 1.0, r) for i, r in enumerate([0.5, -1.5, 0.5])], "symbol string, open_time timestamp, prediction double, actual_log_return_lead1 double")
    out = evaluate.backtest(df).orderBy("open_time").collect()
    assert [round(r.cumulative, 6) for r in out] == [1.5, -0.75, -1.125] and out[0].turnover == 0.0


def test_one_class_confusion(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.2)], "y int, p double")
    r = evaluate.classification_metrics(df, "y", "p").first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (1.0, 1.0, 1.0, 1.0)


def test_ks_against_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 300).round(1), rng.normal(0.4, 1, 200).round(1)
    grid = np.unique(np.concatenate([a, b]))
    want = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    frame = lambda x: spark.createDataFrame(pd.DataFrame({"f": x}))
    assert math.isclose(drift.ks_statistic(frame(a), frame(b), ["f"]).first().ks_statistic, want, abs_tol=1e-12)
    assert abs(drift.ks_approximate(frame(a), frame(b), ["f"]).first().ks_statistic - want) < 0.05
    assert drift.ks_statistic(frame(a), frame(b[:1]), ["f"]).first().ks_statistic == 0.0


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert {(r.x, r.y): r.correlation for r in aggs.correlation_matrix(df, ["a", "b"]).collect()}[("a", "b")] is None


def test_gap_filled_counts(spark):
    df = candles(spark, [1.0, 2.0], step=180)
    assert [r.n for r in aggs.rows_per_interval(df).orderBy("interval").collect()] == [1, 0, 0, 1]


def test_retraining_waits_for_the_cooldown(spark):
    report = spark.createDataFrame([("__overall__", True)], "feature_name string, drift_detected boolean")
    now = T0 + dt.timedelta(hours=2)
    assert drift.retrain_decision(report, T0, 60, now).first().trigger_reason == "drift_detected"
    assert drift.retrain_decision(report, now - dt.timedelta(minutes=5), 60, now).first().trigger_reason == "cooldown_active"
    assert drift.retrain_decision(report.withColumn("drift_detected", F.lit(False)), None, 60, now).first().trigger_reason == "no_drift"


def test_late_rows_are_dropped_from_a_stream(spark, tmp_path):
    ms = lambda t: int(t.timestamp() * 1000)
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    row = lambda t: ("x", ms(t), ms(t) + 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1.0, 1.0)
    for i, t in enumerate([t0, t0 + dt.timedelta(days=5), t0 + dt.timedelta(days=6), t0 + dt.timedelta(hours=1)]):  # the watermark lags a batch
        spark.createDataFrame([row(t)], schemas.RAW).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i}"))
    sdf = spark.readStream.schema(schemas.RAW).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    streams.stream_append(streams.stream_bronze(sdf), str(tmp_path / "out"), str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_prediction_alignment(spark):
    gold = candles(spark, [1.0, 2.0, 2.0])
    preds = gold.select("open_time", "symbol", F.lit(0.1).alias("prediction"))
    out = joins.align_predictions(preds, gold).orderBy("open_time").collect()
    assert [r.direction_correct for r in out] == [True, None, None] and out[2].actual_close is None


def test_features_share_one_sort(spark):
    plan = features.gold_features(candles(spark, [1.0]), 3600)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort ") == 1


def test_stream_layers_equal_a_batch(spark, tmp_path):
    """Three micro-batches in order of time, one of them with rows that are already there."""
    df = candles(spark, [100.0 + i % 7 for i in range(60)])
    ms = F.unix_millis("open_time")
    raw = df.select("symbol", ms.alias("open_time"), (ms + 3599999).alias("close_time"), *[c for c in schemas.RAW.names if c not in ("symbol", "open_time", "close_time")])
    for i, (a, b) in enumerate([(0, 20), (20, 41), (40, 60)]):
        part = raw.where((F.col("open_time") >= int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000) + a * 3600000) & (F.col("open_time") < int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000) + b * 3600000))
        part.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.to_json(F.struct(*raw.columns)).alias("value")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("topic string, partition int, offset long, value string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    paths = streams.LayerPaths(*[str(tmp_path / n) for n in ("silver", "gold", "offsets")])
    streams.stream_medallion(source, paths, str(tmp_path / "cp"), 3600).awaitTermination()
    ours = streams.read_layer(spark, paths.gold).toPandas().sort_values("open_time", ignore_index=True)
    want = features.gold_features(clean.silver_candles(df), 3600).toPandas().sort_values("open_time", ignore_index=True)
    pd.testing.assert_frame_equal(ours[sorted(want)], want[sorted(want)])
    assert streams.read_offsets(spark, paths.offsets).count() == 1


def _layers_of(spark, tmp_path, raw, slices):
    """What a stream makes of the slices of raw candles, one micro-batch each."""
    for i, part in enumerate(slices):
        part.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.monotonically_increasing_id() + 1000 * i).alias("offset"), F.to_json(F.struct(*raw.columns)).alias("value")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("topic string, partition int, offset long, value string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    paths = streams.LayerPaths(*[str(tmp_path / n) for n in ("silver", "gold", "offsets")])
    streams.stream_medallion(source, paths, str(tmp_path / "cp"), 3600).awaitTermination()
    return paths


def test_stream_layers_with_late_rows_equal_a_batch(spark, tmp_path):
    df = candles(spark, [100.0 + i % 7 for i in range(120)])
    ms = F.unix_millis("open_time")
    raw = df.select("symbol", ms.alias("open_time"), (ms + 3599999).alias("close_time"), *[c for c in schemas.RAW.names if c not in ("symbol", "open_time", "close_time")])
    n = (F.col("open_time") - raw.agg(F.min("open_time")).first()[0]) / 3600000
    late = (n % 11 == 3) | n.between(60, 62)
    paths = _layers_of(spark, tmp_path, raw, [raw.where((n < 50) & ~late), raw.where((n >= 50) & ~late), raw.where(late), raw.where(n == 119)])
    want = features.gold_features(clean.silver_candles(df), 3600).toPandas().sort_values("open_time", ignore_index=True)
    for _ in range(2):
        ours = streams.read_layer(spark, paths.gold).toPandas().sort_values("open_time", ignore_index=True)
        pd.testing.assert_frame_equal(ours[sorted(want)], want[sorted(want)])
        for day in {d.date() for d in want.open_time}:
            streams.compact_layer(spark, paths.gold, day)
    assert all(len(list(d.glob("v=*"))) == 1 for d in (tmp_path / "gold").glob("date=*"))
    assert streams.read_offsets(spark, paths.offsets).first().offset >= 3000
    assert len(list((tmp_path / "offsets").glob("v=*"))) <= 2


def test_history_is_read_from_the_days_that_are_needed(spark, tmp_path):
    silver = clean.silver_candles(candles(spark, [100.0 + i % 5 for i in range(24 * 40)]))
    silver.where("open_time < timestamp'2024-02-05'").write.partitionBy("date").parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history")).select(*silver.columns)
    batch = silver.where("open_time >= timestamp'2024-02-05' AND open_time < timestamp'2024-02-06'")
    out = medallion.gold_with_history(batch, history, 3600)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "PartitionFilters" in line and "history" in line]
    assert scans and all("date" in x.split("PartitionFilters: [")[1].split("]")[0] and ">=" in x for x in scans)
    want = features.gold_features(silver, 3600).where("open_time >= timestamp'2024-02-05' AND open_time < timestamp'2024-02-06'")
    key = lambda d: d.toPandas().sort_values("open_time", ignore_index=True)
    pd.testing.assert_frame_equal(key(out.select(*want.columns)), key(want))


def test_sparse_history_is_looked_for_further_back(spark, tmp_path):
    every = candles(spark, [100.0 + i % 5 for i in range(24 * 40)])
    silver = clean.silver_candles(every.where("hour(open_time) = 0 AND day(open_time) % 3 = 1"))
    silver.where("open_time < timestamp'2024-02-05'").write.partitionBy("date").parquet(str(tmp_path / "history"))
    batch = silver.where("open_time >= timestamp'2024-02-05'")
    out = medallion.gold_with_history(batch, spark.read.parquet(str(tmp_path / "history")).select(*silver.columns), 3600)
    want = features.gold_features(silver, 3600).where("open_time >= timestamp'2024-02-05'")
    key = lambda d: d.toPandas().sort_values("open_time", ignore_index=True)
    assert batch.count() > 0
    pd.testing.assert_frame_equal(key(out.select(*want.columns)), key(want))


def test_nan_returns_are_neutral(spark):
    df = spark.createDataFrame([(float("nan"),), (0.1,), (-0.1,), (None,), (float("inf"),)], "r double")
    assert [r.sign_r for r in labels.sign_labels(df, "r", 0.0002).collect()] == [1, 2, 0, None, 2]


def test_models_are_selected_by_log_loss(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": np.digitize(x, [-0.5, 0.5]), "split": ["train"] * 300 + ["val"] * 100}))
    model, scores = ml.select_model(df, ["x"], "y", [{"numTrees": 1, "maxDepth": 1}, {"numTrees": 20, "maxDepth": 5}], "logloss", task="classification")
    by = {r.params: r.logloss for r in scores.collect()}
    val = model.transform(df.where("split = 'val'")).toPandas()
    own = -np.mean([np.log(max(p[int(y)], 1e-15)) for p, y in zip(val.probability, val.y)])
    assert abs(min(by.values()) - own) < 1e-9 and own < 0.5
    with pytest.raises(ValueError):
        ml.select_model(df, ["x"], "y", [{}], "logloss")


def test_exponential_means_have_no_cut(spark):
    rng = np.random.default_rng(5)
    for span in (1, 3, 10, 200):
        x = pd.Series(rng.normal(size=900)).where(rng.random(900) > 0.1)
        df = spark.createDataFrame([("s", i, None if v != v else float(v)) for i, v in enumerate(x)], "symbol string, open_time long, x double")
        ours = with_ewm(df, "x", span, "e").toPandas().sort_values("open_time").e.to_numpy()
        want = x.ewm(span=span, ignore_na=True).mean().to_numpy()
        assert np.allclose(ours, want, rtol=1e-9, atol=1e-12, equal_nan=True), span


def test_ks_over_many_ranges(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 5000), np.concatenate([rng.normal(0.1, 1.2, 3000), np.repeat(0.5, 500)])
    grid = np.unique(np.concatenate([a, b]))
    want = np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)).max()
    frame = lambda x: spark.createDataFrame(pd.DataFrame({"f": x}))
    assert math.isclose(drift.ks_statistic(frame(a), frame(b), ["f"]).first().ks_statistic, want, abs_tol=1e-12)


def test_features_by_stretch_equal_those_by_symbol(spark):
    rng = np.random.default_rng(7)
    every = candles(spark, [100.0 + float(x) for x in rng.normal(size=24 * 40)]).unionByName(candles(spark, [50.0 + float(x) for x in rng.normal(size=24 * 40)], "y"))
    day = F.datediff("open_time", F.lit(T0.date()))
    gaps = every.where(~day.between(9, 24) | (day % 5 == 0) & (F.hour("open_time") == 3)).where((F.col("symbol") == "x") | (day > 30) | (day == 2))
    silver = clean.silver_candles(gaps)
    key = lambda d: d.toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    want = features.gold_features(silver, 3600)
    pd.testing.assert_frame_equal(key(gold_features_by_stretch(silver, 3600).select(*want.columns)), key(want))
