"""Exact search for the largest integer inner products by pivot-table elimination.

Every vector's distances to a set of pivots are computed once and stored. Together they
fix the vector's place in the span of the pivots: its coordinates there, and the length of
what is left. Of two vectors these give the largest lower bound of their distance that the
pivots allow, ``|c(q) - c(x)|^2 + (r(q) - r(x))^2``, and so an upper bound of the inner
product, ``c(q) c(x) + r(q) r(x)``. Candidates are evaluated in the order of that bound
until none left can reach the k-th best score; ties count as reaching it, so the answer
is exact.

Queries go in blocks of bounded size, each broadcast against one scan of the table; a
task keeps only the best k of each query of the block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbair.sources.staging import discard, staged

#: Pivots, the rows they are chosen from, and bytes of queries that are broadcast at once.
PIVOTS, PIVOT_SAMPLE, BLOCK_BYTES = 64, 2000, 32 << 20
#: Candidates evaluated for a query between two looks at the stopping rule.
STEP = 64
#: Sums of products up to this size fit 64 bits; larger ones are summed in Python's integers.
LARGEST = 2.0**62
#: Room for the rounding of coordinates, as a share of the sizes.
SLACK = 1e-12

_SCHEMA = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                     ("row", pa.int64()), ("score", pa.string())])


def integer_vectors(rows: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, vec_id, asked, x): scale * component of every vector that takes part; its floor
    is taken by the tasks, as it may pass 64 bits."""
    finite = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                      & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    x = F.transform(vector_col, lambda v: F.lit(float(scale)) * v.cast("double"))
    return rows.filter(F.col(vector_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("asked"), x.alias("x"))


def choose_pivots(sample: list[list[float]], count: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each pivot is the one farthest from those before it."""
    points = np.array(sorted(map(tuple, sample)), dtype=np.float64)
    pivots = [points[0]]
    away = np.full(len(points), np.inf)
    while len(pivots) < min(count, len(points)):
        away = np.minimum(away, ((points - pivots[-1]) ** 2).sum(axis=1))
        pivots.append(points[away.argmax()])
    return np.array(pivots)


def pivot_span(pivots: np.ndarray) -> np.ndarray:
    """An orthonormal basis (columns) of what the pivots span; near-dependent ones add none."""
    size = np.abs(pivots).max(initial=0)
    if not pivots.size or not size:
        return np.zeros((pivots.shape[1], 0))
    _, values, rows = np.linalg.svd(pivots / size, full_matrices=False)
    return np.ascontiguousarray(rows[values > 1e-9 * values[0]].T)


def places(x: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Coordinates in the span of the pivots, then the length of the rest, rounded up."""
    inside = x @ span
    size = (x * x).sum(axis=1)
    rest = np.sqrt(np.maximum(size - (inside * inside).sum(axis=1), 0) + SLACK * size)
    return np.column_stack([inside, rest])


def _matrix(column: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the vectors of ``dim`` components, and the floors of those as a matrix."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
    at = np.flatnonzero(lengths == dim)
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    return at, np.floor(values.reshape(len(at), dim))


def _pivot_table(spans):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = [None] * batch.num_rows
            for dim, span in spans.value.items():
                at, x = _matrix(batch.column("x"), dim)
                for i, row in zip(at.tolist(), places(x, span), strict=True):
                    table[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(table, pa.list_(pa.float64()))], names=[*batch.schema.names, "place"])

    return run


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, exact at any size; object integers
    where 64 bits do not hold them."""
    if not x.size or np.abs(x).max() * np.abs(q).max(initial=0) * max(1, len(q)) < LARGEST:
        return x.astype(np.int64) @ q.astype(np.int64)
    other = list(map(int, q.tolist()))
    return np.array([sum(a * b for a, b in zip(map(int, row), other, strict=True)) for row in x.tolist()], object)


class _Best:
    """The best k candidates seen by a task for each query of a block."""

    def __init__(self, ids, rows, x, place, k: int):
        self.ids, self.rows, self.x, self.place, self.k = ids, rows, x, place, k
        self.norm = (x**2).sum(axis=1)
        self.found: list[list[tuple]] = [[] for _ in ids]  # (-score, vec_id, row), ascending
        self.offered = self.evaluated = 0

    def offer(self, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, place: np.ndarray) -> None:
        norm = (x**2).sum(axis=1)
        for start in range(0, len(self.ids), 64):
            mine = slice(start, min(start + 64, len(self.ids)))
            # room for the rounding of sums of products, which are at most half the sizes
            upper = self.place[mine] @ place.T + 1e-6 + SLACK * (self.norm[mine, None] + norm[None])
            for i in range(mine.start, mine.stop):
                self._scan(i, upper[i - start], ids, rows, x)

    def _scan(self, i: int, upper: np.ndarray, ids, rows, x) -> None:
        best = self.found[i]
        other = ids != self.ids[i]
        self.offered += int(other.sum())
        least = float(-best[-1][0]) * (1 - 1e-15 * np.sign(-best[-1][0])) if len(best) == self.k else -np.inf
        live = np.flatnonzero((upper >= least) & other)
        live = live[np.argsort(-upper[live], kind="stable")]
        for at in range(0, len(live), STEP):
            part = live[at : at + STEP]
            if len(best) == self.k and upper[part[0]] < -best[-1][0]:
                break
            self.evaluated += len(part)
            scores = exact_products(x[part], self.x[i]).tolist()
            best = sorted([*best, *zip((-s for s in scores), ids[part].tolist(), rows[part].tolist(), strict=True)])[: self.k]
        self.found[i] = best


def _search(block, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: _Best(*part, k) for dim, part in block.value.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            for dim, queries in best.items():
                at, x = _matrix(batch.column("x"), dim)
                if len(at):
                    place = batch.column("place").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                    queries.offer(ids[at], rows[at], x, place.reshape(len(at), -1))
        for queries in best.values():
            for i, found in enumerate(queries.found):
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, queries.rows[i])), pa.array(np.full(n, queries.ids[i])),
                     pa.array([v for _, v, _ in found], pa.int64()), pa.array([r for *_, r in found], pa.int64()),
                     pa.array([str(-s) for s, *_ in found], pa.string())], schema=_SCHEMA)

    return run


def _as_long(score: str) -> Column:
    """A whole number written in digits as the nearest 64-bit one."""
    edge = F.when(F.startswith(F.col(score), F.lit("-")), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
    return F.coalesce(F.expr(f"try_cast({score} AS bigint)"), edge)


def top_inner_products(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 10, scale: int = 1024, pivots: int = PIVOTS, block: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products.

    Candidates are all rows whose id differs from the query's; fewer than ``k`` give all.
    Ties go to the smaller id. Vectors that are NULL or hold NULL or non-finite
    components take no part, nor do NULL ids; vectors meet only those of their own
    length. Repeated rows are candidates each, and a repeated query is answered for each
    of its rows (equal answers, repeated ranks). An empty table gives an empty result.
    Scores are exact at any size; those with up to 38 digits are ranked by their value, and
    one beyond 64 bits is reported as the nearest 64-bit number. Other columns are not
    read, whatever their names.

    Pivots are chosen from PIVOT_SAMPLE rows with the smallest id hashes, and ``block``
    queries (by default as many as BLOCK_BYTES hold) are sent at once; both change the
    work, never the result.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors.filter(F.col(id_col).isNotNull()), is_query, id_col, vector_col, scale)
    sample: dict[int, list] = {}
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("x")
    for r in chosen.collect():
        sample.setdefault(len(r.x), []).append(r.x)
    # lengths the sample misses get the origin as their pivot
    lengths = {r.n for r in rows.select(F.size("x").alias("n")).distinct().collect()}
    spans = {n: pivot_span(choose_pivots(sample[n], pivots) if n in sample else np.zeros((1, n))) for n in lengths}
    table = staged(rows.mapInArrow(
        _pivot_table(spark.sparkContext.broadcast(spans)),
        "row long, vec_id long, asked boolean, x array<double>, place array<double>"), "pivot-table")

    asked = table.filter("asked")
    count = asked.count()
    block = block or max(1, BLOCK_BYTES // (16 * (max(lengths, default=0) + 8)))
    blocks = max(1, -(-count // block))
    part = F.pmod(F.xxhash64("row"), F.lit(blocks))
    results = None
    for number in range(blocks):
        got: dict[int, list] = {}
        for r in asked.filter(part == number).collect():  # about ``block`` rows
            got.setdefault(len(r.x), []).append(r)
        held = {n: (np.array([r.vec_id for r in rs]), np.array([r.row for r in rs]),
                    np.floor(np.array([r.x for r in rs], np.float64).reshape(len(rs), n)),
                    np.array([r.place for r in rs], np.float64).reshape(len(rs), -1)) for n, rs in got.items()}
        sent = spark.sparkContext.broadcast(held)
        found = table.select("row", "vec_id", "x", "place").mapInArrow(
            _search(sent, k), "query_row long, query_id long, vec_id long, row long, score string")
        # 64 bits first, then the value as far as decimals go, then the double
        wide = F.expr("try_cast(score AS decimal(38,0))")
        order = [F.desc(F.col("score").cast("double")), F.desc_nulls_last("wide"), F.asc("vec_id"), F.asc("row")]
        rank = F.row_number().over(Window.partitionBy("query_row").orderBy(*order))
        best = staged(found.withColumn("wide", wide).withColumn("rank", rank).filter(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", _as_long("score").alias("score")), "best")
        results = best if results is None else results.unionByName(best)
    discard(table)
    return results
