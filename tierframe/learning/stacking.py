"""Meta model on the probabilities of several models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.functions.classes import N_CLASSES
from tierframe.learning.models import assemble, meta_regression
from tierframe.operators.scaling import StandardScale


@dataclass(frozen=True)
class Stack:
    scale: StandardScale
    model: object

    def predict(self, wide: DataFrame, keep: list[str]) -> DataFrame:
        columns = list(self.scale.mean)
        return self.model.predict(assemble(self.scale.apply(wide), columns, keep)).drop("features")


def fit_stack(wide: DataFrame, label: str, models: int = 4, c: float = 0.01) -> Stack:
    """``wide``: c0, c1, ... of all models and the class index as ``label``."""
    columns = [f"c{i}" for i in range(models * N_CLASSES)]
    known = wide.filter(F.col(label).isNotNull())
    scale = StandardScale.fit(known, columns)
    rows = assemble(scale.apply(known), columns, [label])
    learner = meta_regression(known.count(), c)
    return Stack(scale, learner.fit(rows, label))
