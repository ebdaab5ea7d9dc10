"""Group-mean imputation and the profile of what it fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.functions.values import is_missing, needs_fill, usable_mean
from curbair.operators.conform import value_columns
from curbair.operators.joins import ROWS, lookup_join
from curbair.sources.staging import staged

_MEAN, _SUM, _COUNT = "__mean_", "__sum_", "__count_"


def group_means(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], zero_is_missing: bool = True
) -> DataFrame:
    """Mean of the usable values of every column per group, plus the group's row count."""
    return df.groupBy(*keys).agg(
        *[
            usable_mean(F.col(c), df.schema[c].dataType, zero_is_missing).alias(_MEAN + c)
            for c in columns
        ],
        F.count(F.lit(1)).alias(ROWS),
    )


def mean_parts(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, zero_is_missing: bool = True
) -> DataFrame:
    """Sum and number of the usable values of every column per group, and the group's
    rows: parts of means, which those of other increments can be added to."""
    columns = value_columns(df) if columns is None else list(columns)
    parts = []
    for c in columns:
        usable = F.when(~needs_fill(F.col(c), df.schema[c].dataType, zero_is_missing), F.col(c).cast("double"))
        parts += [F.sum(usable).alias(_SUM + c), F.count(usable).alias(_COUNT + c)]
    return df.groupBy(*keys).agg(*parts, F.count(F.lit(1)).alias(ROWS))


def add_mean_increment(
    new_rows: DataFrame, path: str, increment: str, keys: Sequence[str],
    columns: Sequence[str] | None = None, zero_is_missing: bool = True,
) -> None:
    """Store the parts of one increment; storing it again replaces it."""
    mean_parts(new_rows, keys, columns, zero_is_missing).write.mode("overwrite").parquet(f"{path}/increment={increment}")


def read_means(spark: SparkSession, path: str) -> DataFrame:
    """Means over all increments, in the form ``impute`` takes: no old row is read again."""
    parts = spark.read.parquet(path).drop("increment")
    columns = [c.removeprefix(_SUM) for c in parts.columns if c.startswith(_SUM)]
    keys = [c for c in parts.columns if c != ROWS and not c.startswith((_SUM, _COUNT))]
    return parts.groupBy(*keys).agg(
        *[F.coalesce(F.sum(_SUM + c) / F.nullif(F.sum(_COUNT + c), F.lit(0)), F.lit(0.0)).alias(_MEAN + c) for c in columns],
        F.sum(ROWS).alias(ROWS))


def impute(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
    zero_is_missing: bool = True, means: DataFrame | None = None,
) -> DataFrame:
    """Replace missing (and zero) values by the mean of their group's usable values.

    ``columns`` defaults to every numeric column named like a value. A window over
    the group would move every row and put a whole group into one task; instead
    the means are aggregated map-side, staged, and joined back, which leaves the
    rows where they are as long as the table of means is small. ``df`` is read twice,
    so it should be a scan or staged. With ``means`` (of ``read_means``) it is read once,
    and what earlier increments held counts too; a group they do not know gets 0.
    """
    columns = value_columns(df) if columns is None else list(columns)
    if not columns:
        return df
    known = means is not None
    means = staged(means if known else group_means(df, keys, columns, zero_is_missing), "group-means")
    joined = lookup_join(
        df, means.select(*keys, *[_MEAN + c for c in columns]), keys, how="left", null_safe=True,
        counts=means.select(*keys, ROWS),
    )

    def filled(c: str):
        bad = needs_fill(F.col(c), df.schema[c].dataType, zero_is_missing)
        mean = F.coalesce(_MEAN + c, F.lit(0.0)) if known else F.col(_MEAN + c)
        return F.when(bad, mean).otherwise(F.col(c).cast("double")).alias(c)

    return joined.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def missing_profile(
    df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None,
    zero_is_missing: bool = True,
) -> DataFrame:
    """Per group and value column: nulls, zeros and the mean that would fill them."""
    columns = value_columns(df) if columns is None else list(columns)
    counted = []
    for c in columns:
        data_type = df.schema[c].dataType
        missing = is_missing(F.col(c), data_type)
        counted.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(missing).alias("nulls"),
            F.count_if((F.col(c) == 0) & ~missing).alias("zeros"),
            usable_mean(F.col(c), data_type, zero_is_missing).alias("fill_mean"),
        ))
    wide = df.groupBy(*keys).agg(F.array(*counted).alias("__profile"))
    return wide.select(*keys, F.inline("__profile"))
