"""Mixing documents to target shares by raking, then sampling.

Token weights of the cells (one per combination of the marginals' values) are fitted to
the target share of every value of every marginal in turn, over and over (iterative
proportional fitting), until all shares are met. A document is then kept with its
cell's calibrated probability: the fitted weight over the present one, scaled so that
the largest is one. In expectation the kept tokens have the target marginals.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbair.llm.common import fresh
from curbair.operators.joins import lookup_join
from curbair.sources.staging import discard, staged

#: Cells that are fitted on the driver; more are fitted by Spark, by the same steps.
DRIVER_CELLS = 200_000
STEPS, TOLERANCE = 50, 1e-9
#: A share that misses its target by more than this is warned of.
MISSED = 0.01

log = logging.getLogger(__name__)


def word_count(text: Column) -> Column:
    """Words between blanks (0x20, 0x09-0x0D); 0 for NULL."""
    parts = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(parts, F.lit(0)).cast("long")


def tempered(cells: DataFrame, margin: str, power: float) -> dict[str | None, float]:
    """Target shares of a marginal: its present shares to a power, brought to sum 1."""
    got = {r[0]: float(r[1]) for r in cells.groupBy(margin).agg(F.sum("tokens")).collect() if r[1]}
    total = sum(v**power for v in sorted(got.values()))
    return {k: v**power / total for k, v in got.items()}


def _targets(cells: DataFrame, margin: str, targets: Mapping[str | None, float] | float) -> DataFrame:
    """(margin, target) for every value of a marginal, by the rules of ``calibrated``."""
    got = staged(cells.groupBy(margin).agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double").alias("tokens")), "margin")
    present = F.col("tokens") > 0
    if isinstance(targets, (int, float)):
        raw = got.withColumn("target", F.when(present, F.pow("tokens", F.lit(float(targets)))).otherwise(0.0))
    else:
        kind = got.select(margin).schema.add("given", "double")
        given = got.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], kind)
        met = staged(lookup_join(got, given, [margin], null_safe=True), "given")
        others = met.filter(present & F.col("given").isNull()).agg(F.sum("tokens")).first()[0] or 1.0
        left = max(0.0, 1.0 - sum(targets.values()))
        raw = met.withColumn("target", F.when(present, F.coalesce("given", F.col("tokens") * F.lit(left / others))).otherwise(0.0))
    raw = staged(raw.select(margin, "target"), "raw")
    total = raw.agg(F.sum("target")).first()[0] or 1.0
    return staged(raw.withColumn("target", F.col("target") / F.lit(total)), "targets")


def _rake_here(codes: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray]) -> list[np.ndarray]:
    factors = [np.ones(len(t)) for t in targets]
    for _ in range(STEPS):
        worst = 0.0
        for m, target in enumerate(targets):
            weight = tokens * np.prod([f[c] for f, c in zip(factors, codes, strict=True)], axis=0)
            share = np.bincount(codes[m], weight, len(target)) / weight.sum()
            change = np.divide(target, share, out=np.zeros_like(target), where=share > 0)
            worst = max(worst, float(np.abs(share - target)[share > 0].max(initial=0)))
            factors[m] = factors[m] * change
        if worst <= TOLERANCE:
            break
    return factors


def _rake_spread(cells: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame]) -> DataFrame:
    """The same steps with the cells in a table; ``factor`` is the product of all."""
    now = staged(cells.withColumn("factor", F.lit(1.0)), "cells")
    weight = F.sum(F.coalesce("tokens", F.lit(0)) * F.col("factor"))
    for _ in range(STEPS):
        worst = 0.0
        for margin in margins:
            total = now.agg(weight).first()[0] or 1.0
            share = staged(now.groupBy(margin).agg((weight / F.lit(total)).alias("share")), "share")
            change = staged(lookup_join(share, targets[margin], [margin], null_safe=True).select(
                margin, "share", "target", F.when(F.col("share") > 0, F.col("target") / F.col("share")).otherwise(0.0).alias("change")), "change")
            worst = max(worst, change.filter("share > 0").agg(F.max(F.abs(F.col("share") - F.col("target")))).first()[0] or 0.0)
            after = staged(lookup_join(now, change.select(margin, "change"), [margin], null_safe=True).withColumn(
                "factor", F.col("factor") * F.col("change")).drop("change"), "cells")
            discard(now, share, change)
            now = after
        if worst <= TOLERANCE:
            break
    return now


def _miss_here(factors: np.ndarray, codes: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray]) -> float:
    weight = tokens * factors
    total = weight.sum() or 1.0
    return max(float(np.abs(np.bincount(c, weight, len(t)) / total - t).max(initial=0)) for c, t in zip(codes, targets, strict=True))


def _miss_spread(fitted: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame]) -> float:
    weight, worst = F.sum(F.coalesce("tokens", F.lit(0)) * F.col("factor")), 0.0
    total = fitted.agg(weight).first()[0] or 1.0
    for margin in margins:
        share = staged(fitted.groupBy(margin).agg((weight / F.lit(total)).alias("share")), "share")
        met = lookup_join(share, targets[margin], [margin], null_safe=True)
        worst = max(worst, met.agg(F.max(F.abs(F.col("share") - F.col("target")))).first()[0] or 0.0)
        discard(share)
    return worst


def calibrated(
    spark: SparkSession, cells: DataFrame, margins: Sequence[str], targets: Mapping[str, Mapping[str | None, float] | float],
    driver_cells: int = DRIVER_CELLS,
) -> DataFrame:
    """The cells (margins, tokens) with their keeping probability and ``residual``: by how
    much the share that misses its target most still misses it.

    Targets can contradict each other in the cells there are; then raking ends after STEPS
    rounds with what it has reached, and a miss beyond MISSED is warned of.

    A value without a target shares what the targets leave of 1 with its like, by
    tokens; with nothing left its documents go. Targets of absent values are left out
    and the others brought to sum 1. A number instead of targets takes the present shares
    to that power. Cells without tokens get probability 1. Beyond ``driver_cells`` cells
    the targets are staged tables, and neither cells nor values reach the driver.
    """
    if cells.count() <= driver_cells:
        wanted: dict[str, dict] = {}
        for margin in margins:
            asked = targets[margin]
            if isinstance(asked, (int, float)):
                asked = tempered(cells, margin, float(asked))
            got = {r[0]: float(r[1] or 0) for r in cells.groupBy(margin).agg(F.sum("tokens")).collect()}
            given = {k: v for k, v in asked.items() if got.get(k, 0) > 0}
            other = {k: v for k, v in got.items() if k not in asked and v > 0}
            left = max(0.0, 1.0 - sum(asked.values()))
            given |= {k: left * v / sum(other.values()) for k, v in other.items()}
            total = sum(given.values())
            wanted[margin] = {k: given.get(k, 0.0) / total if total else 0.0 for k in got}
        rows = sorted(cells.select(*margins, "tokens").collect(), key=lambda r: tuple((v is not None, str(v)) for v in r[:-1]))
        values = {m: sorted({r[m] for r in rows}, key=lambda v: (v is not None, str(v))) for m in margins}
        at = {m: {v: i for i, v in enumerate(values[m])} for m in margins}
        codes = [np.array([at[m][r[m]] for r in rows], np.int64) for m in margins]
        tokens = np.array([float(r["tokens"] or 0) for r in rows])
        factors, missed = np.ones(len(rows)), 0.0
        if tokens.sum() > 0:
            goals = [np.array([wanted[m][v] for v in values[m]]) for m in margins]
            found = _rake_here(codes, tokens, goals)
            factors = np.prod([f[c] for f, c in zip(found, codes, strict=True)], axis=0)
            missed = _miss_here(factors, codes, tokens, goals)
        ratio = [float(f) for f in factors]
        schema = cells.select(*margins, "tokens").schema.add("factor", "double")
        fitted = spark.createDataFrame([(*r, f) for r, f in zip(rows, ratio, strict=True)], schema)
    else:
        goals = {m: _targets(cells, m, targets[m]) for m in margins}
        fitted = _rake_spread(cells.select(*margins, "tokens"), margins, goals)
        missed = _miss_spread(fitted, margins, goals)
    if missed > MISSED:
        log.warning("targets contradict each other: a share misses its target by %.3f", missed)
    top = fitted.filter("tokens > 0").agg(F.max("factor")).first()[0] or 1.0
    return fitted.withColumn(
        "probability", F.when(F.col("tokens") > 0, F.col("factor") / F.lit(top)).otherwise(1.0)).drop("factor").withColumn("residual", F.lit(float(missed)))


def draw(id_col: str, seed: int) -> Column:
    """A number in [0, 1) from the id: the first 13 hex digits of an md5."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, margins: Mapping[str, Column], targets: Mapping[str, Mapping[str | None, float]] | float,
    id_col: str = "doc_id", text_col: str = "text", seed: int = 0, driver_cells: int = DRIVER_CELLS,
) -> DataFrame:
    """``docs`` with ``tokens``, ``probability`` and ``kept`` as three more columns.

    ``margins`` names the marginals' values per document (text), ``targets`` the share
    of tokens each should have; a number instead takes the present shares to that power.
    A NULL value of a marginal is a value of its own. Texts that are NULL or without
    words weigh nothing and are kept. Rows with equal ids draw alike. Columns of
    ``docs`` stay; those named like the three results are replaced. Empty tables give
    empty results. Targets that contradict each other are warned of; ``calibrated``
    returns by how much they are missed.
    """
    spark = docs.sparkSession
    rows = docs.drop("tokens", "probability", "kept")
    names = {m: fresh(rows, f"__{m}") for m in margins}
    rows = rows.withColumns({names[m]: c.cast("string") for m, c in margins.items()})
    rows = rows.withColumn("tokens", word_count(F.col(text_col)))
    keys = list(names.values())
    cells = staged(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "cells")
    if isinstance(targets, (int, float)):
        wanted = {names[m]: float(targets) for m in margins}
    else:
        wanted = {names[m]: targets[m] for m in margins}
    fitted = staged(calibrated(spark, cells, keys, wanted, driver_cells).drop("tokens", "residual"), "mixture")
    joined = lookup_join(rows, fitted, keys, null_safe=True)
    return joined.withColumn("probability", F.when(F.col("tokens") > 0, F.col("probability")).otherwise(1.0)).withColumn(
        "kept", draw(id_col, seed) < F.col("probability")).drop(*keys)
