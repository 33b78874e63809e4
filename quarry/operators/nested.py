"""Schema discovery over JSON text with nested objects and arrays.

Each value is parsed to VARIANT, and an aggregate merges the types of all rows: objects
field by field (a field that a row lacks is optional), arrays by their elements, integers
into wider numbers.  Types that can't be merged (a number here, an object there) become text,
which reads back as the JSON it was, so the discovered schema reads every row.
Fields are named by path: ``a.b`` is field b of object a, ``c[]`` an element of array c.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
    _parse_datatype_string,
)

#: Digits before the point that a merge of fractions and 64-bit integers comes to; numbers with more stay decimals.
INTEGER_DIGITS = 20


def _plain(kind: DataType) -> DataType:
    """The type to read with: conflicts and fields that are always null as text, fractions as double."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType)) for f in kind.fields]) if kind.fields else StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType))
    if isinstance(kind, (VariantType, NullType)):
        return StringType()
    return DoubleType() if isinstance(kind, DecimalType) and kind.precision - kind.scale <= INTEGER_DIGITS else kind


def infer_json_schema(df: DataFrame, json_col: str) -> StructType:
    """The schema that reads every JSON object of the column; other texts (no JSON, no object) take no part."""
    parsed = df.select(F.try_parse_json(F.col(json_col).cast("string")).alias("v"))
    objects = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    merged = objects.agg(F.schema_of_variant_agg("v")).first()[0]  # one text back
    if not merged or not merged.startswith("OBJECT<"):
        return StructType([])
    # names that are no plain words come quoted, so the word before a bracket is a type
    kind = _parse_datatype_string(re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", merged))
    found = _plain(kind)
    return found if isinstance(found, StructType) else StructType([])


def read_json(df: DataFrame, json_col: str, schema: StructType, name: str = "value") -> DataFrame:
    """``df`` with the column parsed to ``schema`` as ``name``."""
    return df.withColumn(name, F.from_json(F.col(json_col).cast("string"), schema))


def _field(name: str):
    return lambda x: x.getField(name)


def _paths(values: Column, kind: DataType, path: str):
    """(path, type, number of non-null values in a row) of everything below an array of values."""
    if isinstance(kind, StructType):
        if path:
            yield path, "struct", F.size(values)
        for f in kind.fields:
            below = F.filter(F.transform(values, _field(f.name)), lambda x: x.isNotNull())
            yield from _paths(below, f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, ArrayType):
        yield path, "array", F.size(values)
        below = F.filter(F.flatten(values), lambda x: x.isNotNull())
        yield from _paths(below, kind.elementType, f"{path}[]")
    else:
        yield path, kind.simpleString(), F.size(values)


def discover_json(df: DataFrame, json_col: str) -> DataFrame:
    """(field, inferred_type, values): every path of the discovered schema with its non-null values in all rows.

    Two passes: one merges the types, one counts.
    """
    schema = infer_json_schema(df, json_col)
    rows = read_json(df.select(json_col), json_col, schema, "__v") if schema.fields else df
    found = list(_paths(F.when(F.col("__v").isNull(), F.array().cast(ArrayType(schema))).otherwise(F.array("__v")), schema, "")) if schema.fields else []
    if not found:
        return df.sparkSession.createDataFrame([], "field string, inferred_type string, values bigint")
    counts = rows.agg(*[F.coalesce(F.sum(n.cast("bigint")), F.lit(0).cast("bigint")).alias(f"n{k}") for k, (_, _, n) in enumerate(found)])
    fields = [x for k, (path, kind, _) in enumerate(found) for x in (F.lit(path), F.lit(kind), F.col(f"n{k}"))]
    return counts.select(F.stack(F.lit(len(found)), *fields)).toDF("field", "inferred_type", "values")
