"""Demand regressors, delay classifiers and their seeded random searches, on MLlib."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.evaluate import regression_metrics
from tidemill.operators.ordered import row_numbers
from tidemill.session import packed, side_by_side

# Search grids of the demand forest and ranges of the boosted classifier.
FOREST_GRID = {
    "numTrees": [100, 150, 200, 300],
    "maxDepth": [8, 10, 12, 15, 30],
    "minInstancesPerNode": [3, 5, 8, 10],
    "featureSubsetStrategy": ["sqrt", "log2", "0.7"],
}
BOOST_RANGES = {"stepSize": (0.01, 0.5), "subsamplingRate": (0.5, 1.0), "minInstancesPerNode": (1, 10), "maxDepth": (3, 8)}


def assembled(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep``, ``label`` and the vector ``features``; rows with a missing feature are skipped."""
    inputs = [f"__f{i}" for i in range(len(features))]
    typed = df.select(
        *keep, F.col(label).cast("double").alias("label"), *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(features, inputs)]
    )
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip").transform(typed).select(*keep, "label", "features")


def time_split(df: DataFrame, day: str, cut: str) -> tuple[DataFrame, DataFrame]:
    at = F.lit(cut).cast("date")
    return df.filter(F.col(day) < at), df.filter(F.col(day) >= at)


def forest_regressor(trees: int = 200, depth: int = 12, leaf: int = 5, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)


def boosting_regressor(rounds: int = 150, depth: int = 5, rate: float = 0.08, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed)


def fit(estimator, train: DataFrame):
    with packed(train) as data:
        return estimator.fit(data)


def fit_and_score(estimator, train: DataFrame, test: DataFrame):
    """Fits, predicts the test rows (floored at 0) and returns (model, predictions, metrics)."""
    model = fit(estimator, train)
    scored = model.transform(test).withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0)))
    return model, scored, regression_metrics(scored, "label", "prediction")


def importances(spark, model, names: Sequence[str], n: int | None = None) -> DataFrame:
    """Feature importances from the model's own vector, which has one number per feature."""
    rows = sorted(zip(names, [float(v) for v in model.featureImportances.toArray()]), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows[: n or len(rows)], "feature string, importance double")


# ---- random search over time folds ----------------------------------------------------------

def draw(grid: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """n distinct seeded draws from a grid."""
    rng, out = random.Random(seed), []
    total = reduce(lambda a, b: a * len(b), grid.values(), 1)
    while len(out) < min(n, total):
        pick = {k: rng.choice(list(v)) for k, v in grid.items()}
        if pick not in out:
            out.append(pick)
    return out


def time_folds(df: DataFrame, day: str, folds: int = 4) -> DataFrame:
    """Adds ``fold`` 0..folds over the days in order; fold f is tested on models of the folds before."""
    days = df.select(day).distinct()
    numbered = row_numbers(days, [], [F.col(day)], F.year(day), "no")
    total = days.agg(F.count("*")).scalar()
    part = numbered.select(day, F.floor((F.col("no") - 1) * (folds + 1) / total).cast("int").alias("fold"))
    return df.join(part, day)


def random_search(train: DataFrame, day: str, grid: Mapping[str, Sequence] = FOREST_GRID, n_iter: int = 20, folds: int = 4,
                  seed: int = 42, at_once: int = 8) -> tuple[dict, list[tuple[dict, float]]]:
    """Mean absolute error over expanding time folds per draw; returns the best draw (of equal ones the first)
    and all of them.

    The folds are dealt once. The fits of all draws and folds are independent and are submitted ``at_once`` at
    a time, the largest first, so that one fit's small jobs do not leave the cluster idle. A fold without rows
    before it or in it has no error; a draw without any error is the worst.
    """
    draws = draw(grid, n_iter, seed)
    with packed(time_folds(train, day, folds).select("fold", "label", "features")) as dealt:
        present = {r["fold"] for r in dealt.select("fold").distinct().collect()}
        usable = [f for f in range(1, folds + 1) if f in present and any(g < f for g in present)]

        def error(params: dict, f: int) -> float:
            model = RandomForestRegressor(seed=seed, maxMemoryInMB=1024, **params).fit(dealt.filter(F.col("fold") < f))
            scored = model.transform(dealt.filter(F.col("fold") == f))
            return scored.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]

        tasks = [(i, f) for i in range(len(draws)) for f in usable]
        tasks.sort(key=lambda t: -t[1] * draws[t[0]].get("numTrees", 1) * draws[t[0]].get("maxDepth", 1))
        errors = dict(zip(tasks, side_by_side([partial(error, draws[i], f) for i, f in tasks], at_once)))
    board = []
    for i, params in enumerate(draws):
        own = [errors[i, f] for f in usable if errors[i, f] is not None]
        board.append((params, sum(own) / len(own) if own else float("inf")))
    return min(board, key=lambda r: r[1])[0], board


def refit(params: Mapping, train: DataFrame, test: DataFrame, seed: int = 42):
    """The best draw of a search, fitted on all training rows: (model, predictions, metrics) on the test rows."""
    return fit_and_score(RandomForestRegressor(seed=seed, maxMemoryInMB=1024, **params), train, test)


# ---- classifiers ----------------------------------------------------------------------------

def linear_classifier(max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(family="binomial", maxIter=max_iter)


def boosted_classifier(rounds: int = 100, depth: int = 5, rate: float = 0.2, subsample: float = 0.8, seed: int = 42, **more) -> GBTClassifier:
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, seed=seed, **more)


def forest_classifier(features: Sequence[str], label: str, trees: int = 100, seed: int = 42) -> Pipeline:
    """Forest on scaled features."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="__raw"),
            StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True),
            RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed),
        ]
    )


def positive_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("score", F.element_at(vector_to_array("probability"), 2))


def binarize(p: Column, threshold: float = 0.5) -> Column:
    return (p > threshold).cast("int")


def batch_predict(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return positive_probability(model.transform(df)).withColumn("predicted", binarize(F.col("score"), threshold))


def tune_boosted(train: DataFrame, validation: DataFrame, ranges: Mapping[str, tuple] = BOOST_RANGES, max_jobs: int = 10,
                 rounds: int = 42, seed: int = 42):
    """Seeded random search by validation AUC; returns (best model, leaderboard rows best first)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(seed)
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    with packed(train) as data, packed(validation) as held:
        draws = [
            {k: rng.randint(a, b) if isinstance(a, int) and isinstance(b, int) else round(rng.uniform(a, b), 4) for k, (a, b) in ranges.items()}
            for _ in range(max_jobs)
        ]

        def run(job: int, params: dict):
            model = GBTClassifier(maxIter=rounds, seed=seed, **params).fit(data)
            return job, params, float(judge.evaluate(model.transform(held))), model

        board = side_by_side([partial(run, job, params) for job, params in enumerate(draws)])
    board.sort(key=lambda r: (-r[2], r[0]))
    return board[0][3], [(job, str(params), auc) for job, params, auc, _ in board]


# ---- saving ---------------------------------------------------------------------------------

def save_model(model, path: str, features: Sequence[str], metrics: DataFrame) -> None:
    """The model, its feature list and its metrics, side by side."""
    spark = metrics.sparkSession
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
    wrapped.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(i, c) for i, c in enumerate(features)], "place int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(spark, path: str) -> tuple[PipelineModel, list[str], DataFrame]:
    names = [r.feature for r in spark.read.parquet(f"{path}/features").orderBy("place").collect()]
    return PipelineModel.load(f"{path}/model"), names, spark.read.parquet(f"{path}/metrics")


