"""Union and difference of half-open intervals, at any resolution.

Intervals are cut at the borders of calendar buckets, and every sweep runs within one key
and bucket, so no window sees a whole history. A sweep compares each interval with the
running maximum of the ends before it; nothing is exploded into days or hours.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from curbair.operators.joins import lookup_join
from curbair.sources.staging import staged

_BUCKET = "__bucket"
_EPOCH = date(1970, 1, 1)
# the number of the bucket a date lies in, and the date a bucket begins at
BUCKETS = {
    "day": (F.unix_date, F.date_from_unix_date),
    "month": (lambda day: (F.year(day) - 1970) * 12 + F.month(day) - 1, lambda n: F.add_months(F.lit(_EPOCH), n)),
    "year": (lambda day: F.year(day) - 1970, lambda n: F.add_months(F.lit(_EPOCH), n * 12)),
}


def _islands(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Intervals of each group of ``by`` that meet or overlap as one.

    An island is named by the start it begins at. Rows that start together share the range
    frame, so whichever of them the sweep takes first, they end up in the same island.
    """
    order = Window.partitionBy(*by).orderBy(start)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = df.withColumn("__reached", reached).withColumn(
        "__begins", F.when(F.col("__reached").isNull() | (F.col(start) > F.col("__reached")), F.col(start)))
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = begins.withColumn("__island", F.max("__begins").over(upto))
    return numbered.groupBy(*by, "__island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__island")


def _pieces(df: DataFrame, keys: Sequence[str], start: str, end: str, bucket: str) -> DataFrame:
    """Non-empty intervals cut at the borders of buckets.

    Borders are counted in dates, so the session's time zone moves none of them between
    intervals, and takes no part at all in bounds that have no zone.
    """
    kind = df.schema[start].dataType
    number, border = BUCKETS[bucket]
    real = df.select(*keys, start, end).filter(F.col(start) < F.col(end))
    # one bucket more than the end lies in: a clock set back over midnight returns to the day before
    last = number(F.col(end).cast("date")) + 1
    cut = real.withColumn(_BUCKET, F.explode(F.sequence(number(F.col(start).cast("date")), last)))
    bound = lambda n: border(n).cast(kind)
    return cut.withColumns({
        start: F.greatest(F.col(start), bound(F.col(_BUCKET))),
        end: F.least(F.col(end), bound(F.col(_BUCKET) + 1))}).filter(F.col(start) < F.col(end))


def interval_union(
    df: DataFrame, keys: Sequence[str] = (), start: str = "range_start", end: str = "range_end",
    bucket: str = "month",
) -> DataFrame:
    """Disjoint intervals that cover what the given ones cover, per key; (keys, start, end).

    Intervals that adjoin become one. Empty ones, reversed ones and those with a NULL
    bound cover nothing.
    """
    merged = _islands(_pieces(df, keys, start, end, bucket), [*keys, _BUCKET], start, end)
    return _across(merged, keys, start, end)


def _across(pieces: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Disjoint pieces (keys, bucket, start, end) with those joined that adjoin at a border.

    Only pieces that reach a border of their bucket can go on, at most two per bucket; the
    window over a whole key sees these alone.
    """
    inside = Window.partitionBy(*keys, _BUCKET)
    edge = pieces.withColumns({
        "__low": F.min(start).over(inside), "__high": F.max(end).over(inside)})
    outer = (F.col(start) == F.col("__low")) | (F.col(end) == F.col("__high"))
    columns = [*keys, start, end]
    met = _islands(edge.filter(outer).select(columns), keys, start, end)
    return met.select(columns).unionByName(edge.filter(~outer).select(columns))


def interval_difference(
    wanted: DataFrame, covered: DataFrame, keys: Sequence[str] = (), match: Sequence[str] = (),
    start: str = "range_start", end: str = "range_end", bucket: str = "month",
) -> DataFrame:
    """What the wanted intervals of each key cover and no covered interval does, as disjoint
    half-open intervals (keys, start, end).

    ``covered`` holds for every key, or with ``match`` (some of ``keys``) for keys that
    agree on these columns.
    """
    asked = _islands(_pieces(wanted, keys, start, end, bucket), [*keys, _BUCKET], start, end)
    taken = _islands(_pieces(covered, match, start, end, bucket), [*match, _BUCKET], start, end).select(
        *match, _BUCKET, F.col(start).alias("__from"), F.col(end).alias("__to"))
    asked, taken = staged(asked, "wanted-pieces"), staged(taken, "covered-pieces")
    within = (F.col("__from") < F.col(end)) & (F.col(start) < F.col("__to"))
    met = lookup_join(asked, taken, [*match, _BUCKET], how="inner").filter(within).withColumn(
        "__from", F.greatest(F.col("__from"), F.col(start)))
    # a mark of no length at the start of every wanted piece; after each mark or covered
    # interval a gap lasts until the next one begins, or the piece ends
    marks = asked.withColumns({"__from": F.col(start), "__to": F.col(start)})
    order = Window.partitionBy(*keys, _BUCKET, start).orderBy("__from", "__to")
    rows = marks.unionByName(met.select(marks.columns))
    gaps = rows.withColumn("__next", F.coalesce(F.lead("__from").over(order), F.col(end))).select(
        *keys, _BUCKET, F.greatest(F.col(start), F.col("__to")).alias(start), F.least(F.col(end), F.col("__next")).alias(end))
    return _across(gaps.filter(F.col(start) < F.col(end)), keys, start, end)
