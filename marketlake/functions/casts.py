"""Casts of text that cost little where the text does not fit.

A failing cast raises and catches an exception for every row.  A pattern that every
castable text matches keeps the others from the cast and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark trims white space and control characters before it casts.
_TRIMMED = r"^[\x00-\x20\x7f-\x9f]*"
_BEGINS = {
    T.BooleanType: _TRIMMED + "[tTfFyYnN01]",
    T.ByteType: _TRIMMED + "[-+0-9]", T.ShortType: _TRIMMED + "[-+0-9]",
    T.IntegerType: _TRIMMED + "[-+0-9]", T.LongType: _TRIMMED + "[-+0-9]",
    T.FloatType: _TRIMMED + "[-+0-9.iInN]", T.DoubleType: _TRIMMED + "[-+0-9.iInN]",
    T.DecimalType: _TRIMMED + "[-+0-9.]",
}


def try_cast_text(text: Column, dtype: T.DataType) -> Column:
    """``try_cast`` of a text column, tried only where the text can begin a value."""
    pattern = _BEGINS.get(type(dtype))
    cast = text.try_cast(dtype)
    return cast if pattern is None else F.when(text.rlike(pattern), cast)


def holds_typed_leaf(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(holds_typed_leaf(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return holds_typed_leaf(dtype.elementType)
    return not isinstance(dtype, T.StringType)


def try_cast_leaves(value: Column, dtype: T.DataType) -> Column:
    """A value with text leaves as ``dtype``; a leaf that does not fit is NULL, the rest stays."""
    if not holds_typed_leaf(dtype):
        return value
    if isinstance(dtype, T.StructType):
        fields = [try_cast_leaves(value.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: try_cast_leaves(item, dtype.elementType))
    return try_cast_text(value, dtype)
