"""Functions of the user's own: aggregates with mergeable states, and row functions.

Both run in Python on Arrow batches, for what no built-in function says; a built-in one
is faster wherever there is one.
"""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, FloatType, StructType

# keys whose states a task holds before it sends them on
HELD = 50_000
STATE = "_state"


@dataclass(frozen=True)
class OwnAggregate:
    """``start()`` is the state of no rows, ``add(state, frame)`` takes in rows of one key
    as a pandas frame, ``merge(a, b)`` joins two states and ``finish(state)`` is the
    value, of the SQL type ``type``.  The result may not depend on the order of rows or
    states.  A state is pickled, and should not grow with the rows."""

    start: Callable[[], Any]
    add: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]
    type: str

    def per_group(self, df: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
        """(key, name): the value of each key; rows without a key are left out.

        The rows are rebalanced and sorted by key first, so ``add`` gets the rows of a key
        in one frame per batch, and its calls grow with the keys and not with the rows.
        Tasks add their rows up, so a hot key, whose partition the rebalancing may split,
        arrives as one state per task and flush.  The states of a partition are merged in
        the order of the key: one state is held at a time.  Integers with NULLs are
        objects in the frames.
        """
        if isinstance(df.schema[key].dataType, (FloatType, DoubleType)):
            raise ValueError(f"{key} is fractional: no key for own aggregates")
        value_type = to_arrow_type(StructType.fromDDL(f"v {self.type}")[0].dataType)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            states: dict[Any, Any] = {}
            kind = None

            def packed() -> pa.RecordBatch:
                sent = pa.array([pickle.dumps(s) for s in states.values()], pa.binary())
                return pa.RecordBatch.from_arrays([pa.array(list(states), kind), sent], [key, STATE])

            for batch in batches:
                kind = batch.schema.field(key).type
                frame = batch.to_pandas(integer_object_nulls=True)
                for k, rows in frame.groupby(key, sort=False):
                    states[k] = self.add(states[k] if k in states else self.start(), rows)
                if len(states) >= HELD:
                    yield packed()
                    states.clear()
            if states:
                yield packed()

        def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind, at, state, any_yet = None, None, None, False

            def values(done: list[tuple]) -> pa.RecordBatch:
                found = [self.finish(s) for _, s in done]
                arrays = [pa.array([k for k, _ in done], kind), pa.array(found, value_type)]
                return pa.RecordBatch.from_arrays(arrays, [key, name])

            for batch in batches:
                kind = batch.schema.field(key).type
                done = []
                for k, sent in zip(*(batch.column(c).to_pylist() for c in (key, STATE))):
                    more = pickle.loads(sent)
                    if any_yet and k == at:
                        state = self.merge(state, more)
                        continue
                    if any_yet:
                        done.append((at, state))
                    at, state, any_yet = k, more, True
                if done:
                    yield values(done)
            if any_yet:
                yield values([(at, state)])

        rows = df.filter(F.col(key).isNotNull()).select(key, *[c for c in columns if c != key])
        rows = rows.hint("rebalance", key).sortWithinPartitions(key)
        of_key = StructType([df.schema[key]])
        states = rows.mapInArrow(partial, StructType([*of_key, *StructType.fromDDL(f"{STATE} binary")]))
        sorted_states = states.repartition(key).sortWithinPartitions(key)
        return sorted_states.mapInArrow(
            finished, StructType([*of_key, *StructType.fromDDL(f"`{name}` {self.type}")])
        )


def with_row_function(
    df: DataFrame, name: str, function: Callable[[tuple], Any], columns: list[str], type: str
) -> DataFrame:
    """``df`` with ``function`` of each row, which gets ``columns`` as named fields.

    NULL is None on both sides.  Only the named columns go to Python.
    """
    fields = namedtuple("fields", [f"f{n}" if not c.isidentifier() else c for n, c in enumerate(columns)])
    value_type = to_arrow_type(StructType.fromDDL(f"v {type}")[0].dataType)

    def applied(rows: pa.Array) -> pa.Array:
        return pa.array([function(fields(*row.values())) for row in rows.to_pylist()], value_type)

    return df.withColumn(name, F.arrow_udf(applied, type)(F.struct(*columns)))
