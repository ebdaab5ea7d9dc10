"""Relations between hourly demand and hourly pollution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from curbair.operators.joins import lookup_join
from curbair.operators.spines import hour_number, hourly_spine
from curbair.sources.staging import staged

HOUR = "datetime_hour"


def _at_grain(demand: DataFrame, keys: Sequence[str], x: str) -> None:
    """Demand must have no key beside those it is met by, or all its places meet all readings."""
    loose = [c for c in demand.columns if c not in {*keys, x}]
    if loose:
        raise ValueError(f"demand has {loose} beside {list(keys)}: aggregate it to these keys, or join by them")


def demand_air(
    demand: DataFrame, air: DataFrame, on: Sequence[str] = (HOUR,), x: str = "trips"
) -> DataFrame:
    """Hours (and places) where both demand and pollution are known.

    Both sides are aggregates already, so rows, not raw readings, meet here. Demand with
    further keys (places that are not in ``on``) raises.
    """
    _at_grain(demand, on, x)
    return air.join(demand, list(on))


def demand_air_correlation(
    demand: DataFrame, air: DataFrame, by: Sequence[str] = ("parameter",),
    on: Sequence[str] = (HOUR,), x: str = "trips", y: str = "value_mean",
) -> DataFrame:
    """Pearson correlation of demand and pollution per pollutant."""
    return demand_air(demand, air, on, x).groupBy(*by).agg(
        F.corr(F.col(x).cast("double"), F.col(y)).alias("correlation"),
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("hours"),
    )


def lag_correlation(
    demand: DataFrame, air: DataFrame, max_lag: int, by: Sequence[str] = ("parameter",),
    places: Sequence[str] = (), x: str = "trips", y: str = "value_mean",
) -> DataFrame:
    """Correlation of demand at t - k with pollution at t, for k = 0..max_lag hours.

    The lag is a shift in *time*: each demand hour is offered to the pollution
    hours it may act on, and the two meet by equality. Gaps therefore never make
    a lag of one row out of several hours, and no series is held in one task. Demand
    with keys beside ``places`` and the hour raises.
    """
    _at_grain(demand, (*places, HOUR), x)
    lags = F.sequence(F.lit(0), F.lit(max_lag))
    shifted = demand.select(*places, F.col(HOUR), x, F.explode(lags).alias("lag_hours")).withColumn(
        HOUR, F.col(HOUR) + F.make_dt_interval(hours=F.col("lag_hours"))
    )
    pairs = air.select(*{*places, *by}, HOUR, y).join(shifted, [*places, HOUR])
    return pairs.groupBy(*by, "lag_hours").agg(
        F.corr(F.col(x).cast("double"), F.col(y)).alias("correlation"),
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("hours"),
    )


def lag_correlation_blocks(
    demand: DataFrame, air: DataFrame, max_lag: int, by: Sequence[str] = ("parameter",),
    places: Sequence[str] = (), x: str = "trips", y: str = "value_mean", block_hours: int = 744,
) -> DataFrame:
    """``lag_correlation`` on dense arrays: what is shuffled does not grow with the lags.

    Demand becomes one array per place and block of ``block_hours`` hours, with a halo of
    the ``max_lag`` hours before it, so a demand hour is sent to two blocks at most. A
    block of readings meets its array by equality, and one pass gives the sums of all lags.
    Both sides must have one row per hour (a second one raises); hours without a value are
    no pair, and a lag without pairs has no row.
    """
    _at_grain(demand, (*places, HOUR), x)
    if not 0 <= max_lag <= block_hours:
        raise ValueError("the lags must not be longer than a block")
    number = hour_number(F.col(HOUR))
    ahead = demand.filter(F.col(x).isNotNull() & F.col(HOUR).isNotNull()).select(
        *places, number.alias("__n"), F.col(x).cast("double").alias("__x"))
    behind = air.filter(F.col(y).isNotNull() & F.col(HOUR).isNotNull()).select(
        *dict.fromkeys([*places, *by]), number.alias("__n"), F.col(y).cast("double").alias("__y"))
    ahead, behind = staged(ahead, "demand-hours"), staged(behind, "air-hours")
    # sums of values near their mean keep their digits; one row each
    mean_x, mean_y = (df.agg(F.coalesce(F.avg(c), F.lit(0.0))).first()[0] for df, c in ((ahead, "__x"), (behind, "__y")))

    own = F.floor(F.col("__n") / block_hours)
    halo = F.pmod("__n", F.lit(block_hours)) >= block_hours - max_lag
    sent = ahead.withColumn("__block", F.explode(F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))))
    place = (F.col("__n") - F.col("__block") * block_hours + max_lag).cast("int")
    arrays = sent.groupBy(*places, "__block").agg(
        F.map_from_entries(F.collect_list(F.struct(place, F.col("__x") - mean_x))).alias("__map")
    ).select(*places, "__block", F.transform(
        F.sequence(F.lit(0), F.lit(block_hours + max_lag - 1)), lambda i: F.try_element_at("__map", i)).alias("__xs"))
    keys = list(dict.fromkeys([*places, *by]))
    offset = (F.col("__n") - own * block_hours).cast("int").alias("at")
    blocks = behind.withColumn("__block", own).groupBy(*keys, "__block").agg(
        F.collect_list(F.struct(offset, (F.col("__y") - mean_y).alias("y"))).alias("__ys"),
        F.countDistinct("__n").alias("__hours"))
    once = F.when(F.size("__ys") == F.col("__hours"), F.col("__ys")).otherwise(
        F.raise_error(F.lit("readings have more than one row of an hour")))
    met = blocks.withColumn("__ys", once).join(arrays, [*places, "__block"])

    def sums(lag: Column) -> Column:
        zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])

        def add(s: Column, pair: Column) -> Column:
            value = F.get("__xs", pair["at"] + max_lag - lag)
            more = F.struct(
                (s["n"] + 1).alias("n"), (s["x"] + value).alias("x"), (s["y"] + pair["y"]).alias("y"),
                (s["xx"] + value * value).alias("xx"), (s["yy"] + pair["y"] * pair["y"]).alias("yy"),
                (s["xy"] + value * pair["y"]).alias("xy"))
            return F.when(value.isNull(), s).otherwise(more)

        return F.struct(lag.alias("lag_hours"), F.aggregate("__ys", zero, add).alias("s"))

    each = met.select(*by, F.inline(F.transform(F.sequence(F.lit(0), F.lit(max_lag)), sums)))
    total = each.groupBy(*by, "lag_hours").agg(*[F.sum(f"s.{c}").alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    n = F.col("n")
    spread = lambda a, b: F.col(a + b) - F.col(a) * F.col(b) / n
    scale = F.sqrt(F.greatest(spread("x", "x"), F.lit(0.0)) * F.greatest(spread("y", "y"), F.lit(0.0)))
    return total.filter("n > 0").select(
        *by, "lag_hours", (spread("x", "y") / F.nullif(scale, F.lit(0.0))).alias("correlation"), n.cast("long").alias("hours"))


def moving_average(
    hourly: DataFrame, keys: Sequence[str], value: str, hours: int = 24, block_days: int = 31,
    fill_gaps: bool = True,
) -> DataFrame:
    """Mean over the last ``hours`` hours of each series; hours without a value count as missing.

    The frame is a range of hours, so gaps need no rows of their own:
    ``fill_gaps`` only decides whether hours without a row are reported too, which
    multiplies sparse series. A series is cut into blocks of ``block_days`` days;
    the last ``hours`` - 1 hours of a block are also given to the next one. Every
    window then sees a bounded number of rows, however long the series is.
    """
    block_hours = block_days * 24
    if not 0 < hours <= block_hours:
        raise ValueError("the window must be shorter than a block")
    series = hourly.select(*keys, HOUR, value)
    series = hourly_spine(series, keys) if fill_gaps else series.filter(F.col(HOUR).isNotNull())
    number = hour_number(F.col(HOUR))
    placed = series.withColumns({"__n": number, "__block": F.floor(number / block_hours)})
    tail = F.pmod("__n", F.lit(block_hours)) > block_hours - hours
    blocks = F.when(tail, F.array(F.col("__block"), F.col("__block") + 1)).otherwise(
        F.array("__block")
    )
    spread = placed.withColumn("__in", F.explode(blocks))
    frame = Window.partitionBy(*keys, "__in").orderBy("__n").rangeBetween(1 - hours, 0)
    averaged = spread.withColumn("moving_mean", F.avg(value).over(frame))
    return averaged.filter(F.col("__in") == F.col("__block")).select(
        *keys, HOUR, value, "moving_mean"
    )


def _rank_of(share: float, rows: Column) -> Column:
    """The least k with k / (rows - 1) >= share; 1 for a single row and a share above 0."""
    others = rows - 1
    low = F.floor(others * share)
    enough = low / F.nullif(others, F.lit(0)) >= share
    rank = F.when(others == 0, F.lit(1 if share > 0 else 0)).when(enough, low).otherwise(low + 1)
    return rank.cast("bigint")


def _piece_with_rank(counted: DataFrame, keys: list[str], share: float, pieces: int) -> DataFrame:
    """Of every group's values, the piece of the value range that holds the wanted rank.

    Adds ``__n``, the rows of the whole group, and ``__before``, those below the piece.
    """
    started = "__n" in counted.columns
    probabilities = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    groups = staged(counted.groupBy(*keys).agg(
        F.percentile_approx("__v", probabilities, pieces * 10).alias("__edges"),
        (F.max("__n") if started else F.sum("__c")).alias("__n"),
        (F.max("__before") if started else F.lit(0).cast("bigint")).alias("__before"),
    ), "value-edges")
    placed = lookup_join(
        counted.select(*keys, "__v", "__c"), groups, keys, how="inner", null_safe=True
    ).withColumn("__piece", F.size(F.filter("__edges", lambda edge: edge < F.col("__v"))))
    sums = placed.groupBy(*keys, "__n", "__before", "__piece").agg(F.sum("__c").alias("__in"))
    earlier = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    below = F.col("__before") + F.coalesce(F.sum("__in").over(earlier), F.lit(0))
    rank = F.greatest(_rank_of(share, F.col("__n")), F.lit(1))
    target = sums.withColumn("__before", below).filter(
        (rank > F.col("__before")) & (rank <= F.col("__before") + F.col("__in"))
    ).drop("__in")
    return lookup_join(
        placed.select(*keys, "__piece", "__v", "__c"), staged(target, "value-piece"),
        [*keys, "__piece"], how="inner", null_safe=True, computed=True,
    ).drop("__piece")


def upper_cut(
    df: DataFrame, value: str, share: float, by: Sequence[str] = (), pieces: int = 256,
    group_rows: int = 200_000,
) -> DataFrame:
    """Per group, the value a row must exceed for its percent rank to reach ``share``.

    percent_rank = (rows with a smaller value) / (n - 1), and 0 for a single row. The
    cut is therefore the k-th smallest value for the least k with k / (n - 1) >=
    share, and NULL for k = 0 (every row qualifies). Found exactly: values are
    counted first, so copies weigh nothing; while a group has more than
    ``group_rows`` distinct values, it is narrowed to the piece between approximate
    quantiles that holds the k-th row; only what is left is put in order.
    """
    keys = list(by) or ["__all"]
    known = df.filter(F.col(value).isNotNull())
    if not by:
        known = known.withColumn("__all", F.lit(0))
    counted = staged(
        known.groupBy(*keys, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__c")),
        "distinct-values",
    )
    while (counted.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > group_rows:
        counted = staged(_piece_with_rank(counted, keys, share, pieces), "narrowed-values")
    if "__n" not in counted.columns:
        counted = counted.withColumns({
            "__n": F.sum("__c").over(Window.partitionBy(*keys)),
            "__before": F.lit(0),
        })
    upto = F.col("__before") + F.sum("__c").over(Window.partitionBy(*keys).orderBy("__v"))
    rank = _rank_of(share, F.col("__n"))
    reached = F.when((rank > 0) & (F.col("__upto") >= rank), F.col("__v"))
    return counted.withColumn("__upto", upto).groupBy(*keys).agg(
        F.min(reached).alias(f"{value}_cut")
    ).select(*by, f"{value}_cut")


def hotspots(
    cells: DataFrame, share: float, top: int | None = None, by: Sequence[str] = ("parameter",),
    x: str = "trips", y: str = "value_mean", order: Sequence[str] = (),
) -> DataFrame:
    """Cells whose demand and pollution both rank in the upper part of their group.

    Both percent ranks must reach ``share``. All such cells are returned, or a report
    of the ``top`` ones by pollution, then demand, then ``order``.
    """
    cells = staged(cells, "cells")
    measures = F.array(*[
        F.struct(F.lit(m).alias("__measure"), F.col(m).cast("double").alias("__value"))
        for m in (x, y)
    ])
    cuts = upper_cut(cells.select(*by, F.inline(measures)), "__value", share, [*by, "__measure"])
    cut_of = {
        m: F.max(F.when(F.col("__measure") == m, F.col("__value_cut"))) for m in (x, y)
    }
    wide = staged(cuts.groupBy(*by).agg(*[c.alias(f"__cut_{m}") for m, c in cut_of.items()]), "cuts")
    kept = lookup_join(cells, wide, by, how="inner", null_safe=True)
    for m in (x, y):
        cut = F.col(f"__cut_{m}")
        kept = kept.filter(F.col(m).isNotNull() & (cut.isNull() | (F.col(m) > cut)))
    kept = kept.select(*cells.columns)
    if top is None:
        return kept
    return kept.orderBy(F.col(y).desc(), F.col(x).desc(), *[F.col(c) for c in order]).limit(top)
