"""Model fitting with Spark ML and batch scoring."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool
from typing import Any

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.operators.evaluate import classification_metrics, regression_metrics

#: Metrics of which less is better.
MINIMISED = frozenset({"rmse", "mae", "logloss"})
METRICS = {"regression": ("rmse", "mae", "correlation", "r2"), "classification": ("accuracy", "precision", "recall", "f1", "logloss")}


def _pipeline(model, features: list[str]) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="skip"), model])


def fit_regressor(df: DataFrame, features: list[str], target: str, weight: str | None = None, params: dict[str, Any] | None = None) -> PipelineModel:
    """Gradient-boosted trees on the rows that have a target."""
    model = GBTRegressor(featuresCol="__features", labelCol=target, predictionCol="prediction", seed=42, **(params or {}))
    return _pipeline(model.setWeightCol(weight) if weight else model, features).fit(df.where(F.col(target).isNotNull()))


#: Classes of a sign: down, flat, up.
CLASSES = 3
#: Rounds, depth and step of boosted classifiers where params don't say.
BOOSTING = {"maxIter": 20, "maxDepth": 3, "stepSize": 0.3}
#: A step's target is kept within this, as few rows with a probability near 0 would decide a leaf else.
STEEPEST = 4.0


def fit_classifier(df: DataFrame, features: list[str], target: str, weight: str | None = None, params: dict[str, Any] | None = None) -> PipelineModel:
    """Gradient-boosted trees for the classes 0, 1 and 2, on the rows that have a target. The model adds prediction and
    probability (a vector). Params are maxIter, maxDepth, stepSize and those of Spark's regression trees; with numTrees, the
    number of a forest's trees, it is a random forest."""
    rows = df.where(F.col(target).isNotNull()).withColumn("__label", F.col(target).cast("double"))
    if params and "numTrees" in params:
        model = RandomForestClassifier(featuresCol="__features", labelCol="__label", predictionCol="prediction", probabilityCol="probability", rawPredictionCol="__raw", seed=42, **params)
        return _pipeline(model.setWeightCol(weight) if weight else model, features).fit(rows)
    return _boosted(rows, features, weight, BOOSTING | (params or {}))


def _boosted(rows: DataFrame, features: list[str], weight: str | None, params: dict[str, Any]) -> PipelineModel:
    """Spark's own boosted trees know two classes. Here each round fits a regression tree per class to the Newton step of the
    softmax likelihood, the residual over p (1 - p) weighted by that, and adds it to the class's margin."""
    trees = {k: v for k, v in params.items() if k not in ("maxIter", "stepSize")}
    assemble = VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="skip")
    data = assemble.transform(rows).select("__features", "__label", (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("__weight")).persist()
    shares = data.agg(F.sum("__weight").alias("all"), *[F.sum(F.when(F.col("__label") == k, F.col("__weight")).otherwise(0.0)).alias(str(k)) for k in range(CLASSES)]).first()
    # A class without rows starts at a small share rather than none.
    start = [math.log(((shares[str(k)] or 0.0) + 1e-3) / ((shares["all"] or 0.0) + CLASSES * 1e-3)) for k in range(CLASSES)]
    margins, stages = [F.lit(m) for m in start], []
    at = data.withColumns({f"__m{k}": margins[k] for k in range(CLASSES)})
    held, step_by = data, (CLASSES - 1) / CLASSES * params["stepSize"]
    for step in range(params["maxIter"]):
        total = sum((F.exp(F.col(f"__m{k}")) for k in range(1, CLASSES)), F.exp(F.col("__m0")))
        for k in range(CLASSES):
            p = F.exp(F.col(f"__m{k}")) / total
            near = F.greatest(p * (1 - p), F.lit(1e-6))
            residual = F.when(F.col("__label") == k, 1 - p).otherwise(-p)
            own = at.select("__features", F.greatest(F.least(residual / near, F.lit(STEEPEST)), F.lit(-STEEPEST)).alias("__step"), (F.col("__weight") * near).alias("__near"))
            tree = DecisionTreeRegressor(featuresCol="__features", labelCol="__step", weightCol="__near", predictionCol=f"__t{step}_{k}", seed=42, **trees)
            stages.append(tree.fit(own))
        for tree in stages[-CLASSES:]:
            at = tree.transform(at)
        # The margins of a round are kept for the next one, so that no round goes through all trees again.
        at = at.select("__features", "__label", "__weight", *[(F.col(f"__m{k}") + step_by * F.col(f"__t{step}_{k}")).alias(f"__m{k}") for k in range(CLASSES)]).persist()
        at.count()
        held.unpersist()
        held = at
    held.unpersist()

    sums = [f"{start[k]!r}D + {step_by!r}D * ({' + '.join(f'__t{i}_{k}' for i in range(params['maxIter']))})" for k in range(CLASSES)]
    margin = SQLTransformer(statement=f"SELECT *, {', '.join(f'{e} AS __m{k}' for k, e in enumerate(sums))} FROM __THIS__")
    total = " + ".join(f"exp(__m{k})" for k in range(CLASSES))
    share = SQLTransformer(statement=f"SELECT *, {', '.join(f'exp(__m{k}) / ({total}) AS __p{k}' for k in range(CLASSES))} FROM __THIS__")
    vector = VectorAssembler(inputCols=[f"__p{k}" for k in range(CLASSES)], outputCol="probability")
    own = ["__features", *[f"__{x}{k}" for k in range(CLASSES) for x in "mp"], *[f"__t{i}_{k}" for i in range(params["maxIter"]) for k in range(CLASSES)]]
    best = f"CAST(array_position(array({', '.join(f'__p{k}' for k in range(CLASSES))}), greatest({', '.join(f'__p{k}' for k in range(CLASSES))})) - 1 AS DOUBLE)"
    final = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(own)}), {best} AS prediction FROM __THIS__")
    return PipelineModel([assemble, *stages, margin, share, vector, final])


def _measured(model: PipelineModel, val: DataFrame, target: str, metric: str, task: str) -> float:
    out = model.transform(val)
    if metric == "logloss":
        return float(log_loss(out.where(F.col(target).isNotNull()), target).first()[metric] or 0.0)
    out = out.select(F.col(target).cast("double").alias("y"), F.col("prediction").cast("double").alias("yhat"))
    return float((regression_metrics(out, "y", "yhat") if task == "regression" else classification_metrics(out, "y", "yhat")).first()[metric] or 0.0)


#: Trees of a candidate: boosting rounds, or a forest's trees.
_SIZES = ("maxIter", "numTrees")


def select_model(df: DataFrame, features: list[str], target: str, grid: list[dict[str, Any]], metric: str = "rmse", weight: str | None = None, task: str = "regression", halving: int = 1, budget_s: float | None = None, parallel: int = 4) -> tuple[PipelineModel, DataFrame]:
    """Fits candidates on split = train and scores them on split = val; gives the best and a table of all scores: params,
    rung, trees, the metric, chosen.

    Train and val are kept in memory once for all candidates, which are fitted ``parallel`` at a time. With ``halving`` (2 or
    more) candidates get a part of their trees first: each rung keeps the better 1/halving of them and gives those halving
    times as many trees, up to their own number. After ``budget_s`` seconds no further candidate starts, and the best of
    those that are measured with the most trees is chosen (the first is always measured).
    """
    if metric not in METRICS[task]:
        raise ValueError(f"metric {metric!r} of a {task} is none of {', '.join(METRICS[task])}")
    fit = fit_regressor if task == "regression" else fit_classifier
    kept = df.where("split IN ('train', 'val')").select(*dict.fromkeys([*features, target, *([weight] if weight else []), "split"])).persist()
    train, val = kept.where("split = 'train'"), kept.where("split = 'val'")
    ends = None if budget_s is None else time.monotonic() + budget_s
    rungs = max(1, math.ceil(math.log(len(grid), halving)) + 1) if halving > 1 and len(grid) > 1 else 1
    size = {"maxIter": 20} if task == "regression" else {"maxIter": BOOSTING["maxIter"]}

    def run(number: int, rung: int) -> tuple[int, int, int, float, PipelineModel] | None:
        if ends is not None and time.monotonic() > ends and (number, rung) != first:
            return None
        params = grid[number]
        name = next((s for s in _SIZES if s in params), "maxIter")
        trees = max(1, math.ceil(params.get(name, size.get(name, 20)) / halving ** (rungs - 1 - rung)))
        model = fit(train, features, target, weight, params | {name: trees})
        return number, rung, trees, _measured(model, val, target, metric, task), model

    best = (lambda x: x[3]) if metric in MINIMISED else (lambda x: -x[3])
    alive, first, scored, last = list(range(len(grid))), (0, 0), [], []
    try:
        for rung in range(rungs):
            with ThreadPool(parallel) as pool:
                found = [x for x in pool.map(lambda n, r=rung: run(n, r), alive, chunksize=1) if x]
            if not found:
                break
            scored += found
            last = sorted(found, key=best)
            alive = [x[0] for x in last[: max(1, len(alive) // halving)]] if halving > 1 else alive
    finally:
        kept.unpersist()
    chosen = last[0]
    rows = [(str(sorted(grid[n].items())), rung, trees, value, (n, rung) == chosen[:2]) for n, rung, trees, value, _ in scored]
    return chosen[4], df.sparkSession.createDataFrame(rows, f"params string, rung int, trees int, {metric} double, chosen boolean")


def log_loss(df: DataFrame, y: str, probability: str = "probability") -> DataFrame:
    """One row: mean of -ln of the probability that the vector gives the true class; a class without one counts as 1e-15."""
    p = F.coalesce(F.get(vector_to_array(probability), F.col(y).cast("int")), F.lit(0.0))
    return df.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("logloss"))


def score_batches(df: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """The scorer's output for each Arrow batch, cast to the declared columns; empty batches are skipped."""
    from pyspark.sql.types import _parse_datatype_string

    fields = _parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                out = scorer(batch)
                yield pd.DataFrame({f.name: out[f.name].astype("float64") if isinstance(f.dataType, T.DoubleType) else out[f.name] for f in fields})

    return df.mapInPandas(run, fields)


def postprocess_outputs(df: DataFrame, tasks: dict[str, str], threshold: float = 0.0, compat: bool = False) -> DataFrame:
    """Raw outputs to typed ones. A classifier's are rounded and kept within 0 to 2, others are doubles; prediction is
    return_short.

    ``tasks`` says of each column "regression", "classification" (class ids) or "score"; a score below the threshold is
    neutral (1). With compat, class ids are held against the threshold too, which makes class 0 neutral.
    """
    out = {}
    for name, task in tasks.items():
        raw = F.col(name).cast("double")
        if task == "regression":
            out[name] = raw
        else:
            kept = F.least(F.greatest(F.rint(raw), F.lit(0.0)), F.lit(2.0)).cast("int")
            out[name] = F.when(F.abs(raw) < threshold, 1).otherwise(kept) if task == "score" or compat else kept
    df = df.withColumns(out)
    return df.withColumn("prediction", F.col("return_short")) if "return_short" in df.columns else df


def argmax_class(df: DataFrame, probs: str = "probability", output: str = "predicted_class") -> DataFrame:
    """The class with the highest probability, the first of several; probs is an array."""
    return df.withColumn(output, (F.array_position(probs, F.array_max(probs)) - 1).cast("int"))
