"""Standard scaling: fit on one table, apply to any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StandardScale:
    """Mean and population standard deviation per column."""

    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> "StandardScale":
        """One aggregate; two numbers per column come back."""
        row = df.agg(
            *[F.expr(f"avg(`{c}`) AS `mean_{c}`") for c in columns],
            *[F.expr(f"stddev_pop(`{c}`) AS `std_{c}`") for c in columns],
        ).first()
        return cls(
            {c: row[f"mean_{c}"] for c in columns}, {c: row[f"std_{c}"] for c in columns}
        )

    def apply(self, df: DataFrame) -> DataFrame:
        """Replaces the columns; a constant column becomes 0."""
        return df.withColumns(
            {
                c: (F.col(c) - F.lit(self.mean[c])) / F.lit(self.std[c] or 1.0)
                for c in self.mean
            }
        )
