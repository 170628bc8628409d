"""Casts of whole columns, nested ones too, to the types of a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cast(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if given == wanted:
        return value
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, given.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        return F.transform_values(value, lambda _, x: _cast(x, given.valueType, wanted.valueType))
    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        parts = [
            _cast(value[f.name], f.dataType, wanted[f.name].dataType).alias(f.name)
            for f in given.fields
            if f.name in wanted.names
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(given, T.StringType) and isinstance(wanted, T.IntegerType):
        return F.trim(value).try_cast("double").try_cast(wanted)  # '2.0' is a 2 as well
    if isinstance(given, T.StringType) and not isinstance(wanted, T.StringType):
        return F.trim(value).try_cast(wanted)
    return value


def typed(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with text in place of numbers and booleans cast to the types of ``schema``; text
    that is none becomes null.  Columns that are absent or unknown are left alone."""
    wanted = T.StructType.fromDDL(schema)
    changed = {
        f.name: _cast(F.col(f.name), f.dataType, wanted[f.name].dataType)
        for f in df.schema.fields
        if f.name in wanted.names and f.dataType != wanted[f.name].dataType
    }
    return df.withColumns(changed) if changed else df
