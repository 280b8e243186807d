"""Boosted classes and the search over candidates."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from candlelake.operators import ml


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes in rings, which no forest of few shallow trees tells apart well; a fifth of the labels is noise."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1600, 2))
    y = np.digitize((x**2).sum(1), [0.8, 2.2])
    y = np.where(rng.random(1600) < 0.1, rng.integers(0, 3, 1600), y)
    df = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y, "w": np.where(y == 0, 2.0, 1.0), "split": ["train"] * 1000 + ["val"] * 600, "id": range(1600)})
    return spark.createDataFrame(df).repartition(4).cache()


def loss(model, rows):
    return ml.log_loss(model.transform(rows), "y").first().logloss


def test_boosting_beats_a_forest(rows, tmp_path):
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    model = ml.fit_classifier(train, ["a", "b"], "y", "w", {"maxIter": 6, "maxDepth": 3})
    forest = ml.fit_classifier(train, ["a", "b"], "y", "w", {"numTrees": 6, "maxDepth": 3})
    assert loss(model, val) < loss(forest, val) < 1.1
    out = model.transform(val)
    assert out.columns == [*val.columns, "probability", "prediction"]
    got = out.toPandas()
    p = np.stack([v.toArray() for v in got.probability])
    assert np.allclose(p.sum(1), 1) and (p.argmax(1) == got.prediction).all()
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(val).toPandas().sort_values("id")
    assert np.allclose(np.stack([v.toArray() for v in again.probability]), p[np.argsort(got.id)])


def test_more_rounds_fit_better_and_absent_classes_stay_unlikely(rows):
    train = rows.where("split = 'train' AND y < 2")
    models = [ml.fit_classifier(train, ["a", "b"], "y", None, {"maxIter": n, "maxDepth": 2}) for n in (1, 4)]
    assert loss(models[1], train) < loss(models[0], train)
    assert models[1].transform(rows).where("prediction = 2").count() == 0
    nulls = train.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    assert ml.fit_classifier(nulls, ["a", "b"], "y", None, {"maxIter": 1}).transform(rows).count() == rows.count()


def test_halving(rows):
    grid = [{"maxDepth": d, "maxIter": 8} for d in (1, 2, 3, 4)]
    df = rows.withColumn("target", F.col("a") * F.col("a") + F.col("b"))
    model, scores = ml.select_model(df, ["a", "b"], "target", grid, "rmse", halving=2)
    table = scores.toPandas()
    assert table.groupby("rung").size().tolist() == [4, 2, 1] and table.groupby("rung").trees.first().tolist() == [2, 4, 8]
    assert table.chosen.sum() == 1 and table[table.chosen].rung.item() == 2
    for rung in (0, 1):  # those that go on are the best of their rung
        here, later = table[table.rung == rung], set(table[table.rung == rung + 1].params)
        assert set(here.sort_values("rmse").params[: len(later)]) == later
    own = model.transform(df.where("split = 'val'")).select(F.sqrt(F.avg((F.col("target") - F.col("prediction")) ** 2)).alias("rmse")).first().rmse
    assert abs(own - table[table.chosen].rmse.item()) < 1e-9


def test_a_search_ends_with_its_time(rows):
    df = rows.withColumn("target", F.col("a"))
    model, scores = ml.select_model(df, ["a", "b"], "target", [{"maxDepth": 1, "maxIter": 2}] * 6, "rmse", budget_s=0.0, parallel=1)
    assert scores.count() == 1 and scores.first().chosen and model is not None


def test_rows_are_kept_once_for_all_candidates(spark, rows):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ml.select_model(rows.withColumn("target", F.col("a")), ["a", "b"], "target", [{"maxDepth": 1, "maxIter": 1}] * 2, "rmse")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
