"""Exact quantiles by ranges against numpy: ties, constants, few values, nulls, heavy tails."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.operators import aggs


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(2)
    return {
        "normal": rng.normal(size=5000), "ties": np.repeat([1.0, 2.0, 3.0], [10, 4000, 5]), "mostly_zero": np.where(rng.random(3000) < 0.9, 0.0, rng.normal(size=3000)), "rounded": rng.normal(size=4001).round(1),
        "tails": rng.standard_cauchy(2500), "constant": np.full(700, 7.0), "one": np.array([3.5]), "two": np.array([-1.0, 4.0]), "huge": np.array([1e300, -1e300, 0.0, 5.0]),
    }


@pytest.mark.parametrize("ranges", [2, 16, 256])
def test_quantiles(spark, series, ranges, monkeypatch):
    monkeypatch.setattr(aggs, "RANGES", ranges)
    rows = [(n, float(x)) for n, v in series.items() for x in v] + [("normal", None)] * 9 + [("nothing", None)]
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = {r.feature: [r[f"q{i}"] for i in range(len(shares))] for r in aggs.exact_quantiles(spark.createDataFrame(rows, "feature string, x double").repartition(5), shares).collect()}
    assert set(found) == set(series)
    for n, v in series.items():
        assert np.allclose(found[n], np.quantile(v, shares), rtol=1e-12, atol=1e-12), n


def test_baseline_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    got = {r.feature: (r.p25, r.p75, r.max) for r in aggs.baseline_stats(df).collect()}
    assert got == {"a": (1.5, 3.0, 4.0), "b": (None, None, None)}
    assert {r.feature for r in aggs.baseline_stats(df.limit(0), ["a"]).collect()} == {"a"}


def test_no_aggregate_keeps_all_values(spark):
    """Spark's exact percentile has every distinct value in one buffer; a common value is one row before its range is sorted."""
    df = spark.range(100).select((F.col("id") % 7).cast("double").alias("a"))
    plan = aggs.baseline_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan
