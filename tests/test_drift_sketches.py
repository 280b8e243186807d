"""Drift from kept sketches against the exact statistic on shifted data; newest rows against a sort."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.operators import drift

T0 = dt.datetime(2024, 1, 1)


def days(spark, x, y, per_day=1500, start=0):
    rows = pd.DataFrame({"symbol": "s", "open_time": [T0 + dt.timedelta(days=start + i // per_day, seconds=i % per_day) for i in range(len(x))], "x": x, "y": y})
    return spark.createDataFrame(rows)


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (0.15, 1.0), (0.5, 1.0), (0.0, 1.6), (3.0, 1.0)])
def test_sketches_are_near_the_exact_statistic(spark, shift, scale):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=20_000), rng.normal(shift, scale, size=9_000)
    base, recent = days(spark, a, a.round(1)), days(spark, b, b.round(1), start=30)
    exact = {r.feature: r.ks_statistic for r in drift.ks_statistic(base, recent, ["x", "y"]).collect()}
    moments = {r.feature: (r.mean_shift, r.std_shift) for r in drift.mean_std_shift(base, recent, ["x", "y"]).collect()}
    found = drift.drift_from_sketches(drift.drift_sketches(base, ["x", "y"]), drift.drift_sketches(recent, ["x", "y"]), ["x", "y"], drift.DriftConfig(0.2, 50, 10**6, 10**6)).collect()
    for r in found:
        assert abs(r.ks_statistic - exact[r.feature_name]) <= 0.01
        assert np.allclose((r.mean_shift, r.std_shift), moments[r.feature_name], rtol=1e-6, atol=1e-9)
        assert r.drift_detected == (r.drift_score >= 0.2)


def test_the_newest_days_make_the_baseline(spark):
    old, new = np.full(3000, 50.0), np.random.default_rng(1).normal(size=3000)
    kept = drift.drift_sketches(days(spark, np.concatenate([old, new]), np.concatenate([old, new])), ["x"])
    merged = drift.merged_sketches(drift.newest_days(kept, 2000)).first()
    assert merged.n == 3000 and abs(merged.mean - new.mean()) < 1e-9 and abs(merged.std - new.std()) < 1e-9
    assert drift.merged_sketches(drift.newest_days(kept, 10**9)).first().n == 6000


def test_few_values_and_missing_features(spark):
    few, many = drift.drift_sketches(days(spark, [1.0], [2.0]), ["x", "y"]), drift.drift_sketches(days(spark, np.arange(500.0), np.arange(500.0)), ["x"])
    found = {r.feature_name: r for r in drift.drift_from_sketches(many, few, ["x", "y"], drift.DriftConfig(0.2, 1), prefix="p.").collect()}
    assert set(found) == {"p.x", "p.y"} and all(r.drift_score == 0.0 and not r.drift_detected for r in found.values())


@pytest.mark.parametrize("n", [0, 1, 5, 17, 40, 1000])
def test_newest_rows(spark, n):
    rng = np.random.default_rng(n)
    rows = [(f"s{i % 7}", None if i % 19 == 0 else T0 + dt.timedelta(hours=int(rng.integers(0, 60)))) for i in range(60)]
    rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp").repartition(3)
    want = df.orderBy(F.desc("open_time"), "symbol").limit(n)
    assert sorted(map(str, drift.newest_rows(df, n).collect())) == sorted(map(str, want.collect()))
