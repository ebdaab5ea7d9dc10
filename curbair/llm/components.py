"""Connected components of a link table, by alternating large and small stars.

Each round hangs every vertex's neighbours under the smallest of them; the number of
rounds grows with the logarithm of the longest path. Links stay in tables: nothing of
their number reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbair.sources.staging import discard, staged


#: Links up to this many bytes are joined by broadcast; a link is two 64-bit numbers.
SMALL_BYTES, LINK_BYTES = 8 << 20, 32


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long) that is not its own root.

    The root is the smallest node reachable. Loops and repeated links are allowed;
    rows with a NULL end are no links. An empty table gives an empty table.
    """
    edges = staged(_ordered(links), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        # a star has at most two rows per link, and a minimum per node no more than that
        small = 2 * state[0] * LINK_BYTES <= SMALL_BYTES
        after = staged(_small_star(_large_star(edges, small), small), "links")
        discard(edges)
        edges = after


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links, the larger end first."""
    return links.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _side(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Repeated links are left in: at most one per link, and the small star drops them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(_side(low, small), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(_side(low, small), "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return low.select("a", F.col("m").alias("b")).unionByName(hung).distinct()
