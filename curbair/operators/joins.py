"""Joins of a large table with a smaller one keyed by the same columns.

A broadcast is used only after its side has been measured. Past the limit the
join shuffles; keys holding a large share of the rows are taken out of that
shuffle first, so no task receives a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from curbair.sources.staging import staged

BROADCAST_BYTES = 64 << 20
HOT_KEYS = 1000

_KEY = "__key_"
ROWS = "__rows"


def measured_bytes(df: DataFrame) -> int:
    """Size of a table in memory, by one aggregate over it.

    Counted as text bytes plus 16 bytes per field; nested values count by the
    length of their text form.
    """
    lengths = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            lengths.append(F.sum(F.octet_length(f.name)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            lengths.append(F.sum(F.octet_length(F.to_json(F.struct(f.name)))))
    row = df.agg(F.count(F.lit(1)), *lengths).first()
    return row[0] * 16 * len(df.columns) + sum(v or 0 for v in row[1:])


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def _match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [
        F.col(k).eqNullSafe(F.col(_KEY + k)) if null_safe else F.col(k) == F.col(_KEY + k)
        for k in keys
    ]
    return reduce(lambda a, b: a & b, pairs)


def _prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *[F.col(k).alias(_KEY + k) for k in keys],
        *[F.col(c) for c in df.columns if c not in keys],
    )


def hot_keys(
    counts: DataFrame, keys: Sequence[str], rows: str, share: int | None = None
) -> DataFrame:
    """Keys that hold at least 1/``share`` of all rows: at most ``share`` of them."""
    share = HOT_KEYS if share is None else share
    total = counts.agg(F.sum(rows)).first()[0] or 0
    return counts.filter(F.col(rows) * share >= max(total, 1)).select(*keys)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    small: bool | None = None,
    counts: DataFrame | None = None,
    computed: bool = False,
) -> DataFrame:
    """Join ``fact`` with a table keyed by the same columns.

    ``how`` is left, inner, left_semi or left_anti; the first two attach the other
    columns of ``lookup``. ``small`` skips the measurement when the caller has
    already made it; ``counts`` (keys plus a ``__rows`` column) skips the counting
    of keys that the shuffled form needs. That form reads ``fact`` up to three times:
    ``computed`` says it is no plain scan and is staged for it. Measuring reads the
    lookup once more, so one that is costly to compute should be staged beforehand.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    keys = list(keys)
    extra = [] if "_" in how else [c for c in lookup.columns if c not in keys]
    shared = sorted(set(extra) & set(fact.columns))
    if shared:
        raise ValueError(f"both sides have {shared}: rename or drop them on one side")
    side = _prefixed(lookup.select(*keys, *extra), keys)

    def meet(rows: DataFrame, other: DataFrame) -> DataFrame:
        joined = rows.join(other, _match(keys, null_safe), how)
        return joined.select(*fact.columns, *extra)

    if fits_broadcast(side) if small is None else small:
        return meet(fact, F.broadcast(side))

    if computed:
        fact = staged(fact, "join-rows")
    if counts is None:
        counts = staged(fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)), "key-counts")
    hot = F.broadcast(staged(_prefixed(hot_keys(counts, keys, ROWS), keys), "hot-keys"))
    is_hot = _match(keys, null_safe=True)
    hot_side = _prefixed(lookup.join(hot, is_hot, "left_semi").select(*keys, *extra), keys)
    # at most HOT_KEYS rows if the lookup is unique on its keys; if it is not, and they
    # are many, AQE's splitting of skewed partitions is left to deal with them
    if fits_broadcast(hot_side):
        hot_side = F.broadcast(hot_side)
    return meet(fact.join(hot, is_hot, "left_semi"), hot_side).unionByName(
        meet(fact.join(hot, is_hot, "left_anti"), side)
    )


def unknown_ids(fact: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Every listed id that no row of ``fact`` has."""
    return ids.select(key).distinct().join(fact.select(key).distinct(), key, "left_anti")


def known_ids(
    fact: DataFrame, ids: DataFrame, key: str, require_known: bool = True
) -> DataFrame:
    """Rows whose ``key`` is listed in ``ids``.

    A listed id without any row raises, as a request for an unknown station does,
    with the number of such ids; ``unknown_ids`` lists them all.
    """
    listed = staged(ids.select(key).distinct(), "listed-ids")
    if require_known:
        unknown = staged(unknown_ids(fact, listed, key), "unknown-ids")
        count = unknown.count()
        if count:
            raise LookupError(f"{count} unknown {key}, {unknown.first()[0]!r} among them")
    return lookup_join(fact, listed, [key], how="left_semi")


def unprocessed(inputs: DataFrame, done: DataFrame, key: str = "source_file") -> DataFrame:
    """Inputs without a finished output, by name."""
    finished = staged(done.select(key).distinct(), "finished")
    return lookup_join(inputs, finished, [key], how="left_anti")
