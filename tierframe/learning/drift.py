"""Can a model tell train rows from test rows?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.learning.models import FEATURES
from tierframe.operators.folds import holdout
from tierframe.sources.staging import materialize


@dataclass(frozen=True)
class DriftModel:
    """AUC on the held-out third (0.5: the two sets look alike) and the share
    of each feature in the gain."""

    auc: float
    importance: DataFrame


def drift_model(
    df: DataFrame,
    features: list[str],
    key: str = "id",
    iterations: int = 100,
    depth: int = 5,
    learning_rate: float = 0.2,
    seed: int = 44,
) -> DriftModel:
    """``df``: (key, target, features), target 0 for train and 1 for test."""
    rows = materialize(holdout(df, key).withColumn("target", F.col("target").cast("double")), "drift")
    booster = GBTClassifier(
        featuresCol=FEATURES,
        labelCol="target",
        validationIndicatorCol="held_out",
        maxIter=iterations,
        maxDepth=depth,
        stepSize=learning_rate,
        subsamplingRate=0.9,
        featureSubsetStrategy="0.9",
        minInstancesPerNode=30,
        seed=seed,
    )
    model = booster.fit(rows)
    auc = BinaryClassificationEvaluator(labelCol="target").evaluate(
        model.transform(rows.filter("held_out"))
    )
    gains = [(f, float(g)) for f, g in zip(features, model.featureImportances.toArray())]
    table = df.sparkSession.createDataFrame(gains, "feature string, gain double")
    return DriftModel(auc, table)
