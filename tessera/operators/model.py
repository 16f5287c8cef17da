"""Gradient-boosted pair scoring with pyspark.ml (trees grow level by level; scores are compared by AUC and F0.5)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train(rows: DataFrame, features: tuple[str, ...], trees: int = 60, depth: int = 6, rate: float = 0.05, seed: int = 42, linear: bool = False, leaf: int = 50, patience: int = 50) -> PipelineModel:
    """rows: features, label and is_val (the fold that stops boosting early).  leaf: the least rows of one.  patience:
    rounds without a gain on that fold after which the best number of trees is kept (0: all are)."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = rows.withColumn("label", F.col("label").cast("double"))
    if linear:
        return Pipeline(stages=[vector, LogisticRegression(regParam=1e-3)]).fit(rows.where("not is_val"))

    def boosted(n: int) -> PipelineModel:
        gbt = GBTClassifier(maxIter=n, maxDepth=depth, stepSize=rate, subsamplingRate=0.85, featureSubsetStrategy="0.9", minInstancesPerNode=leaf, seed=seed)
        return Pipeline(stages=[vector, gbt]).fit(rows.where("not is_val"))

    fitted = boosted(trees)
    val = vector.transform(rows.where("is_val")).select("features", "label")
    if patience and not val.isEmpty():
        best = best_round(fitted.stages[-1].evaluateEachIteration(val), patience)
        if best < trees:
            fitted = boosted(best)  # the same first trees, as each round has a seed of its own
    return fitted


def best_round(losses: list[float], patience: int) -> int:
    """The round (from 1) of least loss before the first run of `patience` rounds without a gain."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def features_of(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def importance(model: PipelineModel) -> dict[str, float]:
    """Features by their share in the splits' gains, or by the size of their coefficient; most important first."""
    fitted = model.stages[-1]
    values = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    return dict(sorted(zip(features_of(model), map(float, values.toArray()), strict=True), key=lambda x: (-abs(x[1]), x[0])))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    if list(features) != features_of(model):
        raise ValueError("the features differ from those the model was trained with")
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def auc(model: PipelineModel, rows: DataFrame) -> float:
    """Area under the ROC curve; NaN where one class is missing."""
    rows = rows.withColumn("label", F.col("label").cast("double"))
    if rows.select("label").distinct().limit(2).count() < 2:
        return float("nan")
    return BinaryClassificationEvaluator().evaluate(model.transform(rows))
