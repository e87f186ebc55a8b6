"""Resolve possibly-missing (nested) columns against a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_path(schema: T.StructType, path: str) -> bool:
    """True if ``a.b.c`` resolves: struct fields by name, map values by key."""
    dtype: T.DataType = schema
    for part in path.split("."):
        if isinstance(dtype, T.StructType):
            if part not in dtype.fieldNames():
                return False
            dtype = dtype[part].dataType
        elif isinstance(dtype, T.MapType):
            dtype = dtype.valueType
        else:
            return False
    return True


def col_or_null(schema: T.StructType | DataFrame, path: str) -> Column:
    """``col(path)`` if it resolves, else a null literal (a missing column is null).

    Pass the schema when resolving several paths: ``DataFrame.schema`` is a
    JVM round trip each time it is read.
    """
    if isinstance(schema, DataFrame):
        schema = schema.schema
    return F.col(path) if has_path(schema, path) else F.lit(None)
