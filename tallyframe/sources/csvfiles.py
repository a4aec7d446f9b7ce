"""CSV input with stated schemas; ``inference`` finds types where none is stated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import GRADES
from ..functions.numeric import quote


def schema_of(**groups: Sequence[str]) -> T.StructType:
    """Schema from column names grouped by type name, e.g. ``schema_of(string=[..], double=[..])``."""
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(c, kinds[k]) for k, names in groups.items() for c in names])


# The columns the analyses use, matched to the file's header by name (see read_csv).
BATTING = schema_of(string=["playerID", "teamID", "lgID"], int=["yearID", "stint"], long="G AB R H 2B 3B HR RBI SB CS BB SO IBB HBP SH SF GIDP".split())

PLAYERS = (
    T.StructType().add("Player", T.StringType()).add("Rookie Year", T.IntegerType())
    .add("Final Year", T.IntegerType()).add("Position", T.StringType()).add("Height", T.StringType())
    .add("Weight", T.StringType()).add("DOB", T.StringType()).add("College", T.StringType())
)

# Rates of a season, in the order of the file.
SEASON_RATES = [
    "PER", "TS%", "FG%", "3P%", "2P%", "eFG%", "OWS", "DWS", "WS", "WS/48", "USG%", "OBPM", "DBPM", "BPM", "VORP",
]
SEASONS = schema_of(string=["Player", "Tm"], double=["Year", "G", "MP", *SEASON_RATES])
SEASON_JOINED = schema_of(
    string=["Player", "Pos_x"],
    double="G_x MP_x PS/G AST TRB 3P% FG% FT% eFG% VORP TS% BPM PER WS".split(),
)

PERCENT_COLUMNS = [
    "Percent of Students Chronically Absent", "Rigorous Instruction %", "Collaborative Teachers %",
    "Supportive Environment %", "Effective School Leadership %", "Strong Family-Community Ties %", "Trust %",
    "Student Attendance Rate", "Percent ELL", "Percent Asian", "Percent Black", "Percent Hispanic",
    "Percent White", "Percent Black / Hispanic",
]
# Ratings in words.
RATING_COLUMNS = [
    "Supportive Environment Rating", "Rigorous Instruction Rating", "Collaborative Teachers Rating",
    "Effective School Leadership Rating", "Strong Family-Community Ties Rating", "Student Achievement Rating",
    "Trust Rating",
]
SCHOOLS = schema_of(
    string=["School Name", "SED Code", "City", "Community School?", "School Income Estimate", *PERCENT_COLUMNS, *RATING_COLUMNS],
    double=["Economic Need Index", "Average ELA Proficiency", "Average Math Proficiency"],
    int=[f"Grade {g} ELA - All Students Tested" for g in GRADES]
    + [f"Grade {g} Math - All Students " + ("tested" if g == 3 else "Tested") for g in GRADES],
)


# Field texts that mean "missing" besides an empty field.
MISSING = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN",
    "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, whole: bool = False) -> DataFrame:
    """Read CSV with a header; empty and missing-marked fields are NULL, any other misfit is an error.

    By default the schema names the wanted columns, in any order, and they are matched with the header of
    the file.  With ``whole`` the schema lists all columns in file order and gives them its own names.
    Fields come in as text and are cast, because a typed reader would stop at a missing marker.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("mode", "FAILFAST")
    if whole:
        reader = reader.option("enforceSchema", True).schema(T.StructType([T.StructField(n, T.StringType()) for n in schema.names]))
    text = reader.csv(path)

    def typed(field: T.StructField) -> Column:
        value = text[quote(field.name)]
        return F.when(~value.isin(*MISSING), value).cast(field.dataType).alias(field.name)

    return text.select(*[typed(f) for f in schema.fields])
