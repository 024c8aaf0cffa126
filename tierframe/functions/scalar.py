"""Scalar functions for row features.

Rules they share: a ratio with denominator 0 is NULL, a guarded function
(angle, speed, travel time) gives 0 where its guard fails, and NULL input
stays NULL unless a guard says otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: Column) -> Column:
    """NaN orders above every number in Spark and poisons averages."""
    return F.when(~F.isnan(x), x)


def clamp_negative(x: Column) -> Column:
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def norm(*components: Column) -> Column:
    """Euclidean length of the given components."""
    return F.sqrt(reduce(add, [c * c for c in components]))


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def angle(x: Column, y: Column) -> Column:
    """Degrees of atan(x / y); 0 where y is 0, NULL where y is NULL."""
    return F.when(y == 0, F.lit(0.0)).otherwise(F.degrees(F.atan(ratio(x, y))))


def speed(energy: Column, mass: Column) -> Column:
    """v of E = m v^2 / 2; 0 without positive mass, NULL for negative energy."""
    moving = F.when(energy >= 0, F.sqrt(ratio(2 * energy, mass)))
    return F.when(mass > 0, moving).otherwise(F.lit(0.0))


def travel_time(distance: Column, velocity: Column) -> Column:
    return F.when(velocity > 0, ratio(F.abs(distance), velocity)).otherwise(F.lit(0.0))
