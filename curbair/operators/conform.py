"""Column conformance: declared columns out of whatever a file holds."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from curbair.functions.times import as_time
from curbair.schemas import FLAG_ATTRIBUTES, NUMBER_ATTRIBUTES, TEXT_ATTRIBUTES

log = logging.getLogger(__name__)


class ConformError(ValueError):
    """A data set lacks columns its processing cannot do without."""


def lenient_cast(column: Column, source: T.DataType, target: str) -> Column:
    """``column`` as ``target``; what does not convert becomes NULL.

    Integers may be written as decimals (``161.0``), which is how columns with gaps
    are often saved. A column already of the target type stays a bare reference, which
    keeps predicates on it pushable into the scan.
    """
    if source.simpleString() == target:
        return column
    if target in ("timestamp", "timestamp_ntz"):
        return as_time(column, source, target)
    if isinstance(source, T.StringType) and target in ("int", "bigint"):
        return F.coalesce(column.try_cast(target), column.try_cast("double").try_cast(target))
    if isinstance(source, (T.StringType, T.FractionalType)):
        return column.try_cast(target)
    return column.cast(target)


def conform(
    df: DataFrame,
    columns: Mapping[str, str] | Iterable[str],
    required: Iterable[str] = (),
    name: str = "data set",
    carry: Iterable[str] = (),
) -> DataFrame:
    """Project to the declared columns that exist, in declared order.

    Missing columns are logged and left out; a missing required column, or none
    present at all, raises. With a mapping the kept columns are also cast.
    ``carry`` adds columns as they are.
    """
    types = dict(columns) if isinstance(columns, Mapping) else {c: None for c in columns}
    present = [c for c in types if c in df.columns]
    if not present:
        raise ConformError(f"{name}: none of the columns {list(types)} is present")
    lacking = [c for c in required if c not in present]
    if lacking:
        raise ConformError(f"{name}: required columns missing: {lacking}")
    absent = [c for c in types if c not in present]
    if absent:
        log.warning("%s: columns missing and left out: %s", name, absent)
    return df.select(*[
        (lenient_cast(F.col(c), df.schema[c].dataType, types[c]) if types[c] else F.col(c)).alias(c)
        for c in present
    ], *carry)


def value_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose name contains "value" in any case."""
    return [
        f.name for f in df.schema.fields
        if "value" in f.name.lower() and isinstance(f.dataType, T.NumericType)
    ]


def fill_defaults(
    df: DataFrame,
    texts: Iterable[str] = tuple(TEXT_ATTRIBUTES),
    numbers: Iterable[str] = tuple(NUMBER_ATTRIBUTES),
    flags: Iterable[str] = tuple(FLAG_ATTRIBUTES),
) -> DataFrame:
    """NULL to '' / 0 / False for the listed columns that exist."""
    fills: dict[str, str | float | bool] = {}
    for names, default in ((texts, ""), (numbers, 0.0), (flags, False)):
        fills.update({c: default for c in names if c in df.columns})
    return df.na.fill(fills) if fills else df


def first_existing(df: DataFrame, preference: Iterable[str]) -> str | None:
    return next((c for c in preference if c in df.columns), None)
