import pytest
from pyspark.sql import types as T

from tests.conftest import plan_of, rows_of
from tierframe.operators.narrowing import (
    csv_types,
    narrow_where_it_fits,
    number_types,
    read_csv_inferred,
    text_types,
)


def type_of(spark, *cells):
    return text_types(spark.createDataFrame([(c,) for c in cells], "x string"))["x"].dataType.simpleString()


@pytest.mark.parametrize(
    "cells, wanted",
    [
        (("-128", "127"), "tinyint"),
        (("-129",), "smallint"),
        (("128", None), "smallint"),
        (("-32768", "32767"), "smallint"),
        (("32768",), "int"),
        (("-2147483648", "2147483647"), "int"),
        (("2147483648",), "bigint"),
        (("-9223372036854775808", "9223372036854775807"), "bigint"),
        # no type holds these
        (("9223372036854775808",), "string"),
        (("9007199254740993", "0.5"), "string"),
        (("1.234567890123456789",), "string"),
        (("1e999",), "string"),
        (("1e-999",), "string"),
        # floats where all cells are, double else
        (("0.5", "1", "-2.25"), "float"),
        (("3.4028234663852886E38",), "float"),
        (("0.1",), "double"),
        (("1.7976931348623157E308",), "double"),
        (("16777217", "0.5"), "double"),
        (("-0", "1"), "float"),
        (("1", "NaN"), "float"),
        (("NaN", None), "float"),
        (("Infinity", "-Infinity", "1.5"), "float"),
        # text
        (("007",), "string"),
        (("+1",), "string"),
        ((" 1",), "string"),
        (("",), "string"),
        (("1", "2", "x"), "string"),
        (("1995-01-01",), "string"),
        # nothing known
        ((None, None), "double"),
        ((), "double"),
    ],
)
def test_types_of_text(spark, cells, wanted):
    assert type_of(spark, *cells) == wanted


def test_numbers_narrow_only_where_all_fit(spark):
    rows = [(1, 1 << 40, 0.5, 0.1, None, "a"), (-128, 0, 1e30, 2.0, None, None)]
    df = spark.createDataFrame(rows, "a long, b long, c double, d double, e double, `f.g` string")
    rows_with = df.collect()
    # 1e30 is no float
    assert [f.dataType.simpleString() for f in number_types(df)] == [
        "tinyint", "bigint", "double", "double", "double", "string",
    ]
    narrowed = narrow_where_it_fits(df, keep=["a"])
    assert narrowed.schema["a"].dataType == T.LongType()
    assert narrowed.collect() == rows_with
    assert narrow_where_it_fits(df.select("a")).schema["a"].dataType == T.ByteType()


def test_special_values_are_floats(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (-0.0,), (0.25,)], "x double")
    assert number_types(df)["x"].dataType == T.FloatType()
    values = [r[0] for r in narrow_where_it_fits(df).collect()]
    assert str(values) == "[inf, nan, -0.0, 0.25]"


def test_csv_without_a_schema(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as file:
        file.write("id,code,x,empty\n1,007,0.5,\n300,1,NaN,\n2,x,,\n")
    assert csv_types(spark, path).simpleString() == "struct<id:smallint,code:string,x:float,empty:double>"
    back = read_csv_inferred(spark, path)
    assert rows_of(back, "id") == [(1, "007", 0.5, None), (2, "x", None, None), (300, "1", None, None)]


def test_empty_csv(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as file:
        file.write("id,x\n")
    assert read_csv_inferred(spark, path).collect() == []


def test_types_need_one_combined_aggregate(spark):
    from tierframe.operators import narrowing

    seen = []
    original = narrowing._facts
    try:
        narrowing._facts = lambda cells, **kw: seen.append(cells) or original(cells, **kw)
        text_types(spark.createDataFrame([("1", "2")], "a string, b string"))
    finally:
        narrowing._facts = original
    assert len(seen) == 1 and "Exchange" not in plan_of(seen[0])
