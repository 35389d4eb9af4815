"""The schema of JSON lines as an aggregate, and a profile of every path they hold."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quoted names, names before a colon, and what remains: names of types.
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[A-Za-z_][A-Za-z_0-9]*(?=\s*:)|DECIMAL\(\s*\d+\s*,\s*\d+\s*\)|[A-Z_]+")
_NO_FIELDS = "STRUCT<>"


def _is_object(kind: Column) -> Column:
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def line_schema(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row from one pass over a column of JSON lines: ``lines``, ``malformed`` (lines that are
    no JSON objects), ``schema`` that fits all others, NULL if there are none. Empty lines count as
    no lines.

    Every line is parsed to a VARIANT and the types are merged by an aggregate, within tasks first,
    so nothing but a type moves. Numbers with a fraction are DOUBLE, fields of several types or
    without any value STRING, as the JSON reader has them.
    """
    line = F.col(column)
    parsed = lines.filter(F.trim(line) != "").select(F.try_parse_json(line).alias("value"))
    is_object = _is_object(F.schema_of_variant("value"))
    found = parsed.agg(
        F.count("*").alias("lines"),
        F.count_if(~is_object).alias("malformed"),
        F.schema_of_variant_agg(F.when(is_object, F.col("value"))).alias("kind"),
    )
    return found.select("lines", "malformed", F.when(_is_object(F.col("kind")), F.col("kind")).alias("schema"))


def infer_schema(lines: DataFrame, column: str = "value") -> T.StructType:
    """The schema of a column of JSON lines; without fields if no line is an object."""
    kind = line_schema(lines, column).first()["schema"]
    found = T._parse_datatype_string(_spark_type(kind)) if kind else T.StructType()
    return T.StructType([_nullable(field) for field in found])


def _spark_type(kind: str) -> str:
    """A type of VARIANT values as a type of columns."""
    names = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}

    def changed(token: re.Match) -> str:
        word = token.group()
        if word.startswith("DECIMAL("):
            return "DOUBLE"
        return word if kind[token.end() :].lstrip().startswith(":") else names.get(word, word)

    return _TOKEN.sub(changed, kind).replace(f": {_NO_FIELDS}", ": STRING")


def _nullable(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, field.dataType, True)


def undeclared_fields(found: T.StructType, declared: T.StructType, prefix: str = "") -> list[str]:
    """Paths of fields that lines hold and a declared schema does not, in order."""
    out = []
    for field in found:
        path = f"{prefix}{field.name}"
        known = declared[field.name].dataType if field.name in declared.names else None
        if known is None:
            out.append(path)
            continue
        mine, theirs = field.dataType, known
        while isinstance(mine, T.ArrayType) and isinstance(theirs, T.ArrayType):
            mine, theirs = mine.elementType, theirs.elementType
        if isinstance(mine, T.StructType) and isinstance(theirs, T.StructType):
            out += undeclared_fields(mine, theirs, f"{path}.")
    return sorted(out)


def path_profile(lines: DataFrame, column: str = "value") -> DataFrame:
    """``path``, ``type``, ``values``: of every path in a column of JSON lines, not known in
    advance, how many values of each type it has that are not null. Names are joined by dots,
    the elements of an array are its path and ``[]``, the whole line is ``$``. Lines that are no
    JSON are left out; a path that holds nothing but nulls has none, with the type NULL.

    Nested values are taken apart level by level until none is left. A level is counted within
    tasks before its paths, types and counts move.
    """
    value = F.try_parse_json(F.col(column)).alias("value")
    level = lines.filter(F.trim(F.col(column)) != "").select(F.lit("$").alias("path"), value).filter("value IS NOT NULL")
    counts = None
    while True:
        kinds = level.select("path", _kind(F.col("value")).alias("type")).groupBy("path", "type").agg(F.count("*").alias("values"))
        counts = kinds if counts is None else counts.unionByName(kinds)
        nested = level.filter(_kind(F.col("value")).isin("OBJECT", "ARRAY"))
        if nested.limit(1).count() == 0:
            break
        level = _taken_apart(nested)
    # One row per path and type is left, so a path's rows are few.
    known = F.max(F.col("type") != "NULL").over(Window.partitionBy("path"))
    values = F.when(F.col("type") == "NULL", 0).otherwise(F.col("values")).alias("values")
    return counts.withColumn("known", known).filter("type != 'NULL' OR NOT known").select("path", "type", values)


def _kind(value: Column) -> Column:
    """The kind of a VARIANT value: OBJECT, ARRAY, STRING, NUMBER, BOOLEAN or NULL."""
    name = F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)
    return F.when(name.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), name).when(name == "VOID", "NULL").otherwise("NUMBER")


def _taken_apart(nested: DataFrame) -> DataFrame:
    """The values directly inside objects and arrays, with their paths."""
    spark = nested.sparkSession
    inside = nested.select("path", F.col("value").alias("outer")).lateralJoin(spark.tvf.variant_explode(F.col("outer").outer()))
    name = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).when(F.col("path") == "$", F.col("key"))
    return inside.select(name.otherwise(F.concat("path", F.lit("."), "key")).alias("path"), "value")
