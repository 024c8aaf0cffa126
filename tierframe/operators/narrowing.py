"""The narrowest type of each column that holds all of its values.

Every column climbs from tinyint over smallint, int and bigint, or from float to
double, as far as its values ask for; text that is no number stays text.  One
aggregate looks at all columns: the cells are fanned out to (column, cell) and
combined in the task, so what is shuffled is a row per column and task, and the
driver gets a row per column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierframe.sources.tables import read_csv

NOT_A_NUMBER = "NaN"
# what a number looks like in text.  A leading zero or a plus sign would be lost,
# so such a column (ids like 007) stays text.
INTEGER = r"^(0|-?[1-9][0-9]*)$"
REAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
INFINITE = r"^-?Infinity$"
# a printed double has no more digits than that, and every integer below this is one
MOST_DIGITS = 17
EXACT_BELOW = float(1 << 53)

_INTEGERS = [
    (T.ByteType(), 1 << 7),
    (T.ShortType(), 1 << 15),
    (T.IntegerType(), 1 << 31),
    (T.LongType(), 1 << 63),
]


def text_types(df: DataFrame) -> T.StructType:
    """Schema for columns of text.

    NULL cells ask for nothing; ``NaN`` asks for a float.  A column without any
    value becomes double, as an absent one does in ``reindex``.  Numbers that
    neither bigint nor double holds (too many digits, too large, too small)
    keep a column text.
    """
    text, number, mantissa = F.col("text"), F.col("number"), F.col("mantissa")
    # each step is a projection of its own, so that no pattern is matched twice
    cells = (
        df.select(F.posexplode(F.array(*[_column(c) for c in df.columns])).alias("at", "text"))
        .filter(text.isNotNull())
        .select(
            "at",
            "text",
            F.when(text.rlike(REAL) | text.rlike(INFINITE), text.try_cast("double")).alias("number"),
            F.when(text.rlike(INTEGER), text.try_cast("bigint")).alias("whole"),
            F.regexp_replace(text, "[eE].*$", "").alias("mantissa"),
        )
    )
    digits = F.length(F.regexp_replace(F.regexp_replace(mantissa, "[-.]", ""), "^0+", ""))
    exact = ~text.rlike(INTEGER) | (F.abs(number) < EXACT_BELOW)
    in_range = (F.abs(number) < float("inf")) & ((number != 0) | ~mantissa.rlike("[1-9]"))
    is_real = text.rlike(INFINITE) | ((digits <= MOST_DIGITS) & exact & in_range)
    facts = _facts(
        cells.select("at", "text", "whole", F.when(is_real, number).alias("real")),
        integer=F.col("whole"),
        real=F.col("real"),
        no_integer=F.col("whole").isNull(),
        no_number=F.col("real").isNull() & (text != NOT_A_NUMBER),
        known=F.lit(True),
    )
    return T.StructType(
        [T.StructField(c, _type_of_text(facts.get(i))) for i, c in enumerate(df.columns)]
    )


def number_types(df: DataFrame) -> T.StructType:
    """Schema with the narrowest type for each integer and double column.

    Other columns keep their type, as does a column without any value.
    """
    fields = df.schema.fields
    cells = F.array(
        *[
            F.struct(
                (_column(f.name) if _is_integer(f) else F.lit(None)).cast("bigint").alias("whole"),
                (_column(f.name) if _is_double(f) else F.lit(None)).cast("double").alias("part"),
            )
            for f in fields
        ]
    )
    facts = _facts(
        df.select(F.posexplode(cells).alias("at", "cell")).select("at", "cell.*"),
        integer=F.col("whole"),
        real=F.col("part"),
        no_integer=F.lit(False),
        no_number=F.lit(False),
        known=F.col("whole").isNotNull() | F.col("part").isNotNull(),
    )
    return T.StructType([T.StructField(f.name, _narrowed(f, facts.get(i))) for i, f in enumerate(fields)])


def narrow_where_it_fits(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Every integer and double column in its narrowest type, but for ``keep``.

    No value changes: a double becomes float only if all its values are floats.
    """
    kept = set(keep)
    wanted = number_types(df)
    return df.select(
        *[
            _column(old.name)
            if old.name in kept or old.dataType == new.dataType
            else _column(old.name).cast(new.dataType).alias(old.name)
            for old, new in zip(df.schema.fields, wanted.fields)
        ]
    )


def csv_types(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a CSV file with a header row, from one pass over its text."""
    return text_types(spark.read.option("header", True).csv(path))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and types that hold every cell; NaN becomes NULL."""
    return read_csv(spark, path, csv_types(spark, path))


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _is_integer(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.IntegralType)


def _is_double(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.DoubleType)


def _facts(
    cells: DataFrame, integer: Column, real: Column, no_integer: Column, no_number: Column, known: Column
) -> dict[int, Row]:
    """What the values of each column ask for, by position; none for one without any."""
    fits = real.cast("float").cast("double") == real
    rows = cells.filter(known).groupBy("at").agg(
        F.min(integer).alias("least"),
        F.max(integer).alias("greatest"),
        F.bool_or(no_integer).alias("no_integer"),
        F.bool_or(no_number).alias("no_number"),
        F.coalesce(F.bool_and(fits), F.lit(True)).alias("fits_float"),
    )
    return {row["at"]: row for row in rows.collect()}


def _type_of_text(facts: Row | None) -> T.DataType:
    if facts is None:
        return T.DoubleType()
    if not facts["no_integer"]:
        return _integer_type(facts)
    if facts["no_number"]:
        return T.StringType()
    return T.FloatType() if facts["fits_float"] else T.DoubleType()


def _narrowed(field: T.StructField, facts: Row | None) -> T.DataType:
    if facts is None:
        return field.dataType
    if _is_integer(field):
        return _integer_type(facts)
    if _is_double(field) and facts["fits_float"]:
        return T.FloatType()
    return field.dataType


def _integer_type(facts: Row) -> T.DataType:
    return next(t for t, end in _INTEGERS if -end <= facts["least"] and facts["greatest"] < end)
