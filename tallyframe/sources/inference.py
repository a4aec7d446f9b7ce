"""Types of text columns, found from all their values.

Every value has a kind; kinds form a lattice under string, and a column takes the least kind that holds all of its values:
boolean, long, decimal, double; date, timestamp; string.  One aggregate over the table decides all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import col, quote
from .csvfiles import MISSING

WHOLE = r"^[+-]?[0-9]{1,38}$"
POINT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
FLOAT = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
ENDS = "\r\n\u0085\u2028\u2029"  # that may follow the last digit, as patterns read them
SAFE_DIGITS = 15  # that a double holds of any decimal number


def present(name: str) -> Column:
    """A field's text without the spaces around it; NULL if it is empty or marked as missing."""
    value = F.trim(col(name))
    return F.when((value != "") & ~value.isin(*MISSING), value)


def _digits(value: Column) -> tuple[Column, Column]:
    """Digits of a number before the point, without leading zeros, and after it."""
    value = F.rtrim(value, F.lit(ENDS))
    point = F.instr(value, ".")
    whole = F.length(F.ltrim(F.substring_index(value, ".", 1), F.lit("+-0")))
    return whole, F.when(point > 0, F.length(value) - point).otherwise(0)


def _tests(value: Column) -> dict[str, Column]:
    """What one value can be; a number is no word or date, so each pattern is tried once, and only where it may match."""
    number = F.col("number")
    whole = number & ~F.contains(value, F.lit(".")) & (F.length(F.trim(value, F.lit("+-" + ENDS))) <= 38)
    before, after = _digits(value)
    return {
        "boolean": ~number & F.lower(value).isin("true", "false"),
        "whole": whole, "long": whole & value.try_cast("bigint").isNotNull(),
        "point": number, "float": number | value.rlike(FLOAT),
        "date": ~number & value.rlike(DATE) & value.try_cast("date").isNotNull(),
        "moment": ~number & value.rlike(MOMENT) & value.try_cast("timestamp_ntz").isNotNull(),
        "before": F.when(number, before), "after": F.when(number, after), "digits": F.when(number, before + after),
    }


def find_types(text: DataFrame, names: Sequence[str]) -> T.StructType:
    """The type of each text column; a column without any value stays text.

    Whole numbers are long, or decimal beyond 64 bits, so ids keep every digit.  Numbers with a point are double, or decimal
    if some have more digits than a double holds and all fit into 38.
    """
    # One row per value, so that the code Spark generates stays small enough to be compiled, whatever the number of columns.
    values = text.select(F.posexplode(F.array(*[present(n) for n in names])).alias("at", "v")).where("v is not null")
    tested = values.withColumn("number", F.col("v").rlike(POINT)).select("at", *[c.alias(t) for t, c in _tests(F.col("v")).items()])
    counts = ("before", "after", "digits")
    aggs = [F.max(c).alias(c) if c in counts else F.bool_and(c).alias(c) for c in tested.columns[1:]]
    found = {r["at"]: r for r in tested.groupBy("at").agg(*aggs).collect()}  # one row per column

    def kind(r) -> T.DataType:
        if r is None:
            return T.StringType()
        if r["boolean"]:
            return T.BooleanType()
        if r["long"]:
            return T.LongType()
        if r["whole"] and r["before"] <= 38:
            return T.DecimalType(38, 0)
        if r["point"] and not r["whole"] and r["digits"] > SAFE_DIGITS and r["before"] + r["after"] <= 38:
            return T.DecimalType(max(1, r["before"] + r["after"]), r["after"])
        if r["float"]:
            return T.DoubleType()
        if r["date"]:
            return T.DateType()
        return T.TimestampNTZType() if r["moment"] else T.StringType()

    return T.StructType([T.StructField(n, kind(found.get(i))) for i, n in enumerate(names)])


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the types found; texts come unchanged but for missing marks, which are NULL."""
    chosen = {f.name: f.dataType for f in schema.fields}

    def value(name: str) -> Column:
        kind = chosen.get(name)
        if kind is None:
            return col(name)
        if isinstance(kind, T.StringType):
            return F.when(present(name).isNotNull(), col(name)).alias(name)
        return present(name).cast(kind).alias(name)

    return text.select(*[value(c) for c in text.columns])


def read_inferred(spark: SparkSession, path: str | list[str], bad: str = "bad_record") -> DataFrame:
    """Read CSV with a header and find the types of its columns from all rows.

    A line with more or fewer fields than the header is kept as text in the column ``bad``, which is NULL for good ones;
    the fields of such a line are NULL and say nothing about types.
    """
    names = spark.read.option("header", True).csv(path).columns
    while bad in names:
        bad += "_"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
    text = reader.option("nullValue", "").schema(schema).csv(path)
    good = text.select(*[F.when(F.col(quote(bad)).isNull(), F.col(quote(n))).alias(n) for n in names], F.col(quote(bad)))
    return typed(good, find_types(good, names))
