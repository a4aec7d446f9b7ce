"""Types found in CSV files."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.sources import inference
from tallyframe.sources.inference import find_types, read_inferred, typed


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", " -2 ", None, "n/a"], "bigint"), (["9007199254740993", "9223372036854775807"], "bigint"), (["9223372036854775808", "1"], "decimal(38,0)"),
        (["1", "2.5"], "double"), (["1e3", "-.5", "inf"], "double"), (["0.1234567890123456789", "12"], "decimal(21,19)"),
        (["1e3", "0.1234567890123456789"], "double"), (["true", "FALSE", None], "boolean"), (["true", "1"], "string"),
        (["2020-02-29", "1999-12-31"], "date"), (["2020-02-30"], "string"), (["2020-02-29", "2020-02-29 10:11:12.5", "2020-02-29T10:11"], "timestamp_ntz"),
        (["2020-02-29", "5"], "string"), (["12d"], "string"), (["", None, "NaN"], "string"), (["9" * 39, "1"], "double"), (["x", "1"], "string"), ([], "string"),
    ],
)
def test_kinds(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert find_types(df, ["a.b"])["a.b"].dataType.simpleString() == kind


def test_each_pattern_is_tried_once_per_value(spark):
    """Of a value, and in one expression for all columns: a table of 60 columns makes no larger code than one of two."""
    text = " ".join(str(c) for c in inference._tests(F.col("v")).values())
    assert text.lower().count("rlike") == 3
    df = spark.createDataFrame([("-007.50\n", "12\n", "x") * 20, ("1", "+9", None) * 20], [f"c{i}" for i in range(60)])
    assert [f.dataType.simpleString() for f in find_types(df, df.columns)] == ["double", "bigint", "string"] * 20


def test_values_keep_every_digit(spark):
    df = spark.createDataFrame([("9007199254740993", "9223372036854775808", " x ", "nan"), (None, "7", "NA", "2")], "a string, b string, c string, d string")
    out = typed(df, find_types(df, df.columns))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(9007199254740993, Decimal("9223372036854775808"), " x ", None), (None, Decimal(7), None, 2)], key=repr)


def test_bad_lines_are_kept(spark, tmp_path):
    for name, lines in (("one.csv", ["id,name,bad_record", "1,ann,x", "2,bob", '3,"c,d",y']), ("two.csv", ["id,name,bad_record", "4,eve,z,9", "9007199254740993,,w"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    out = read_inferred(spark, str(tmp_path))
    assert out.dtypes == [("id", "bigint"), ("name", "string"), ("bad_record", "string"), ("bad_record_", "string")]
    rows = sorted(map(tuple, out.collect()), key=repr)
    assert rows == sorted([(1, "ann", "x", None), (3, "c,d", "y", None), (9007199254740993, None, "w", None), (None, None, None, "2,bob"), (None, None, None, "4,eve,z,9")], key=repr)
    assert read_inferred(spark, str(tmp_path)).where(F.col("id") > 2**53).count() == 1
