"""Functions on class labels and on arrays of class scores."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label code -> class index.
LABEL_TO_CLASS = {21: 0, 1: 1, 4: 2, 5: 3}
CLASS_TO_LABEL = {index: code for code, index in LABEL_TO_CLASS.items()}
N_CLASSES = len(LABEL_TO_CLASS)


def map_values(x: Column, mapping: dict) -> Column:
    """Partial value map: a value without an entry becomes NULL."""
    branches = F.when(F.lit(False), F.lit(None))
    for key, value in mapping.items():
        branches = branches.when(x == key, F.lit(value))
    return branches.cast("int")


def label_to_class(label: Column) -> Column:
    return map_values(label, LABEL_TO_CLASS)


def class_to_label(index: Column) -> Column:
    return map_values(index, CLASS_TO_LABEL)


def argmax(scores: Column) -> Column:
    """Index of the first maximum of an array column."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def argmax_of(scores: list[Column]) -> Column:
    """First maximum of separate columns; stays in generated code."""
    best = F.greatest(*scores)
    index = F.lit(None)
    for k in reversed(range(len(scores))):
        index = F.when(scores[k] == best, F.lit(k)).otherwise(index)
    return index.cast("int")


def one_hot(index: Column, n: int = N_CLASSES) -> list[Column]:
    """0/1 column per class; all zero for a value outside 0..n-1."""
    return [F.coalesce((index == k).cast("int"), F.lit(0)) for k in range(n)]


def weighted_sum(weights: list, scores: list[Column]) -> Column:
    """Sum of weight * score, added from left to right."""
    return reduce(add, [w * s for w, s in zip(weights, scores)])


def percent_of_total(x: Column, total: Column) -> Column:
    return F.try_divide(100 * x, total)
