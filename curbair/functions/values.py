"""Missing-value tests and defaults.

Spark orders NaN above every number and lets it poison ``avg``; here NaN counts
as missing everywhere, like NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_FLOATING = (T.DoubleType, T.FloatType)


def is_missing(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, _FLOATING):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def without_nan(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, _FLOATING):
        return F.when(~F.isnan(column), column)
    return column


def is_positive(column: Column, data_type: T.DataType) -> Column:
    """``column > 0`` that also rejects NaN; the comparison stays pushable."""
    if isinstance(data_type, _FLOATING):
        return (column > 0) & ~F.isnan(column)
    return column > 0


def needs_fill(column: Column, data_type: T.DataType, zero_is_missing: bool = True) -> Column:
    """TRUE where a value is missing (or zero); never NULL."""
    missing = is_missing(column, data_type)
    if zero_is_missing:
        return missing | F.coalesce(column == 0, F.lit(False))
    return missing


def usable_mean(column: Column, data_type: T.DataType, zero_is_missing: bool = True) -> Column:
    """Mean over the values that need no fill, 0 if there are none."""
    keep = ~needs_fill(column, data_type, zero_is_missing)
    return F.coalesce(F.avg(F.when(keep, column)), F.lit(0.0))


def has_path(schema: T.DataType, path: str) -> bool:
    """Does a dotted field path exist in a struct type?"""
    for part in path.split("."):
        if not isinstance(schema, T.StructType) or part not in schema.fieldNames():
            return False
        schema = schema[part].dataType
    return True


def field_or(schema: T.StructType, path: str, default: Column) -> Column:
    """Nested field, or ``default`` where it is absent, NULL or below a NULL."""
    if has_path(schema, path):
        return F.coalesce(F.col(path), default)
    return default
