"""URL allow and block rules by a sort-merge range join.

A rule (host, path) fits its host and all subdomains if the url's path starts with its
path. With the host's labels reversed, the urls a rule fits under one host form an
interval of keys: everything that starts with the rule's own key. A url is placed under
each of its host's suffixes that some rule names, rules and urls are sorted by key, and
one sweep keeps the stack of the rules that are open at the current key, the innermost
on top. The longest rule over a url's suffixes wins.

A suffix such as a top-level domain holds a large share of all urls, so urls are dealt
over salts by a hash; the rules of a suffix go to every salt in use there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbair.operators.joins import lookup_join
from curbair.sources.staging import staged

#: Urls of one suffix that may meet in one run of the sweep.
SALT_ROWS = 20_000


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ",")


_OUT = pa.schema([("row", pa.int64()), ("rule", pa.int64())])


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The innermost open rule of every url, over events sorted by group, path and kind."""
    group, stack = None, []
    for batch in batches:
        rows, rules = [], []
        for name, salt, path, row, rule in zip(
                *(batch.column(c).to_pylist() for c in ("key", "salt", "path", "row", "rule")), strict=True):
            if (name, salt) != group:
                group, stack = (name, salt), []
            while stack and not path.startswith(stack[-1][0]):
                stack.pop()
            if row is None:
                stack.append((path, rule))
            elif stack:
                rows.append(row)
                rules.append(stack[-1][1])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(rules, pa.int64())], schema=_OUT)


def judge_urls(
    urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every url.

    ``rules`` has host, path and verdict (allow or block). The longest fitting rule,
    host and path together, gives the verdict; of equally long ones that with the longer
    host, then the blocking one. ``rule`` is its host and path as one string, NULL if
    none fits, when ``default`` is the verdict. A url that is NULL or without ``://`` has
    an empty host and path and fits only a rule with both empty. Repeated urls are each
    judged, repeated rules count once, rules with NULL parts not at all; empty tables
    give empty or default results. Other columns are not read.
    """
    known = rules.select(
        F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), "path", "verdict"
    ).dropna().groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    known = staged(known.withColumn("key", reversed_host(F.col("host")))
                   .withColumn("rule", F.monotonically_increasing_id()), "url-rules")
    url = F.col(url_col).cast("string")
    rows = staged(urls.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
                  .withColumn("row", F.monotonically_increasing_id()), "urls")

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(F.reverse(labels), F.lit(1), i), ","))
    placed = rows.select("row", "path", F.explode(F.array_distinct(suffixes)).alias("key"))
    placed = lookup_join(placed, known.select("key").distinct(), ["key"], how="left_semi")
    salts = staged(placed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_rows)).cast("int").alias("salts")), "salts")
    points = lookup_join(placed, salts, ["key"], how="inner").select(
        "key", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int").alias("salt"), "path", "row",
        F.lit(None).cast("long").alias("rule"))
    opens = known.join(salts, "key").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "path",
        F.lit(None).cast("long").alias("row"), "rule")
    # a rule opens before the urls with its own key: NULL rows come first
    order = ["key", "salt", "path", F.col("row").asc_nulls_first()]
    fits = points.unionByName(opens).repartition("key", "salt").sortWithinPartitions(*order).mapInArrow(
        _sweep, "row long, rule long")

    text = F.concat("host", "path")
    rank = F.struct(F.length(text), F.length("host"), F.col("verdict"), text.alias("text"))
    ranked = lookup_join(fits, known.select("rule", rank.alias("rank")), ["rule"], how="inner")
    best = ranked.groupBy("row").agg(F.max("rank").alias("best"))
    judged = rows.join(best, "row", "left")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.text").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
