"""Statistics of groups as states that later rows can be merged into.

A state table has one row per key and, for each source column, a struct of count,
sum, centred square sum, least and greatest value.  The state of the train rows,
once written, is merged with that of the test rows or of a later file without
reading the earlier rows again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierframe.operators.stats import Stat

# statistic -> what it is in terms of a state
FROM_STATE = {
    "count": "{0}.n",
    "max": "{0}.greatest",
    "mean": "{0}.total / nullif({0}.n, 0)",
    "min": "{0}.least",
    "std": "CASE WHEN {0}.n > 1 THEN sqrt({0}.squares / ({0}.n - 1)) END",
    "sum": "{0}.total",
}


def group_state(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, one struct per column), combined before the shuffle.

    NULL values are not counted; rows without a key take no part, as in
    ``group_stats``.  A group without any value has n = 0 and NULL else.
    """
    known = rows.filter(F.col(key).isNotNull())
    return known.groupBy(key).agg(*[_state(c, rows.schema[c].dataType).alias(c) for c in columns])


def _state(name: str, dtype: T.DataType) -> Column:
    value = F.col(name) if isinstance(dtype, T.IntegralType) else F.col(name).cast("double")
    n = F.count(value)
    return F.struct(
        n.alias("n"),
        F.sum(value).alias("total"),
        (F.var_pop(value) * n).alias("squares"),
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
    )


def merge_states(states: list[DataFrame], key: str) -> DataFrame:
    """One state of all: as if every row had been there from the start.

    One shuffle for any number of states.  A key has one row in each of them, so
    a group holds no more rows than there are states in the call.  All states
    need the same columns; a key may be missing from some.
    """
    first = states[0]
    if any(set(other.columns) != set(first.columns) for other in states):
        raise ValueError("states of different columns")
    together = reduce(DataFrame.unionByName, states)
    return together.groupBy(key).agg(
        *[_merged(f.name, f.dataType).alias(f.name) for f in first.schema.fields if f.name != key]
    )


def _merged(name: str, dtype: T.StructType) -> Column:
    none = {f.name: F.lit(None).cast(f.dataType) for f in dtype.fields}
    start = {**none, "n": F.lit(0).cast("long"), "squares": F.lit(0.0)}
    filled = F.filter(F.collect_list(name), lambda s: s["n"] > 0)
    merged = F.aggregate(filled, _struct(start), _together)
    return F.when(F.size(filled) > 0, merged).otherwise(_struct({**start, "squares": none["squares"]}))


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _together(a: Column, b: Column) -> Column:
    # centred at the means of the two parts: no difference of large squares
    n = a["n"] + b["n"]
    apart = b["total"] / b["n"] - a["total"] / F.nullif(a["n"], F.lit(0))
    weight = a["n"].cast("double") * b["n"] / n
    return _struct(
        {
            "n": n,
            "total": F.coalesce(a["total"] + b["total"], b["total"]),
            "squares": a["squares"] + b["squares"] + F.coalesce(apart * apart * weight, F.lit(0.0)),
            "least": F.least(a["least"], b["least"]),
            "greatest": F.greatest(a["greatest"], b["greatest"]),
        }
    )


def stats_of(state: DataFrame, key: str, stats: list[Stat]) -> DataFrame:
    """The statistics that ``group_stats`` gives for the rows behind the state."""
    return state.selectExpr(
        f"`{key}`",
        *[
            f"{stat.rounded(kind, FROM_STATE[kind].format(f'`{stat.source}`'))}"
            f" AS `{key}_{stat.family}_{kind}`"
            for stat in stats
            for kind in stat.kinds
        ],
    )
