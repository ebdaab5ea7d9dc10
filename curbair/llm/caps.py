"""Near-duplicate vectors by spherical-cap filters.

Filter directions form a structured random product code: the space is cut into four
blocks, each with its own small set of random unit vectors, and a direction is one of
them from every block. A vector passes every filter whose direction it exceeds a
threshold with; the product structure lets it list them without looking at all (pairs
of blocks first, then a two-list search). Vectors meet in the filters they share, and
every meeting pair is verified in double precision.

The directions adapt to the table: their number grows with the rows so that an average
filter keeps a few vectors, and the threshold is fitted on a bounded sample so that a
vector passes about FILTERS of them. Vectors that pass few take their LEAST best ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbair.llm.components import connected_components
from curbair.operators.joins import lookup_join
from curbair.sources.staging import discard, staged

FILTERS, LEAST, PER_FILTER = 16, 8, 4
#: Vectors the threshold is fitted on.
SAMPLE = 1000
#: A filter with more vectors is cut into blocks that meet pairwise.
BLOCK = 1024
SEED = 11


@dataclass
class ProductCode:
    """Block codes and the threshold."""

    parts: list[np.ndarray]  # of each block: codes x components
    threshold: float = 0.0

    def at_once(self) -> int:
        """Vectors whose lists take a few megabytes together."""
        return max(1, (1 << 20) // len(self.parts[0]) ** 2)

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all code pairs of the first and of the last two blocks."""
        ends = np.cumsum([p.shape[1] for p in self.parts])
        s = [x[:, e - p.shape[1] : e] @ p.T / 2.0 for p, e in zip(self.parts, ends, strict=True)]
        n = len(x)
        return ((s[0][:, :, None] + s[1][:, None, :]).reshape(n, -1),
                (s[2][:, :, None] + s[3][:, None, :]).reshape(n, -1))

    def decode(self, x: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per unit vector the filters it exceeds the threshold with, or its ``least``
        best ones if they are fewer, and the scores."""
        front, back = self.lists(x)
        width = back.shape[1]
        out = []
        for a, b in zip(front, back, strict=True):
            ia, ib, counts = reaching(a, b, self.threshold)
            if counts.sum() < least:
                # the best sums lie among the first few of either list
                top = np.sort((_largest(a, least)[:, None] + _largest(b, least)[None, :]).ravel())[::-1]
                ia, ib, counts = reaching(a, b, top[min(least, len(top)) - 1] - 1e-12)
            first = np.repeat(np.arange(len(ia)), counts)
            second = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
            out.append((ia[first].astype(np.int64) * width + ib[second], a[ia[first]] + b[ib[second]]))
        return out


def _largest(x: np.ndarray, count: int) -> np.ndarray:
    return np.partition(x, len(x) - count)[len(x) - count :] if count < len(x) else x


def reaching(a: np.ndarray, b: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of either list that can reach ``level`` with one of the other, largest
    first, and for each of the first list how many of the second it reaches it with.
    Only these few are sorted, so long lists cost one comparison an entry."""
    ia, ib = (np.flatnonzero(one >= level - other.max() - 1e-12) for one, other in ((a, b), (b, a)))
    ia, ib = ia[np.argsort(-a[ia])], ib[np.argsort(-b[ib])]
    return ia, ib, np.searchsorted(-b[ib], a[ia] - level, side="right")


def product_code(dim: int, codes: int) -> ProductCode:
    rng = np.random.default_rng([SEED, dim, codes])
    parts = []
    for part in np.array_split(np.arange(dim), 4):
        c = rng.normal(size=(codes, len(part)))
        parts.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300))
    return ProductCode(parts)


def fitted_code(sample: np.ndarray, rows: int) -> ProductCode:
    """A code with about rows * FILTERS / PER_FILTER directions, and its threshold."""
    code = product_code(sample.shape[1], codes_for(rows))
    low, high, step = 0.0, 1.0, code.at_once()
    for _ in range(14):
        code.threshold = (low + high) / 2
        passed = sum(int(reaching(a, b, code.threshold)[2].sum()) for at in range(0, len(sample), step)
                     for a, b in zip(*code.lists(sample[at : at + step]), strict=True))
        low, high = (code.threshold, high) if passed > FILTERS * len(sample) else (low, code.threshold)
    return code


def codes_for(rows: int) -> int:
    """Vectors of each block's code: the directions, its fourth power, grow with the rows."""
    return max(8, int(np.ceil((max(rows, 1) * FILTERS / PER_FILTER) ** 0.25)))


def _units(column: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
    at = np.flatnonzero(lengths == dim)
    x = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return at, x / np.linalg.norm(x, axis=1, keepdims=True)


_FILTERS = pa.schema([("cid", pa.int64()), ("filters", pa.list_(pa.int64()))])


def _decode(codes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = min((code.at_once() for code in codes.value.values()), default=1)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                out: list = [[]] * part.num_rows
                for dim, code in codes.value.items():
                    at, x = _units(part.column("x"), dim)
                    for i, (ids, _) in zip(at.tolist(), code.decode(x, LEAST), strict=True):
                        out[i] = np.sort(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"), pa.array(out, pa.list_(pa.int64()))], schema=_FILTERS)

    return run


_FOUND = pa.schema([("cid", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


class _Meeting:
    """Vectors of one filter, or of two of its blocks, and the links among them."""

    def __init__(self, cosine: float):
        self.cosine = cosine

    def links(self, table: pa.Table) -> pa.RecordBatch | None:
        ids = table.column("cid").to_numpy()
        ids, at = np.unique(ids, return_index=True)
        if len(ids) < 2:
            return None
        table = table.take(pa.array(at))
        _, x = _units(table.column("x").combine_chunks(), len(table.column("x")[0]))
        near = x @ x.T >= self.cosine
        np.fill_diagonal(near, False)
        side = table.column("side").to_numpy()
        if side.max():  # two blocks: pairs inside one of them are met elsewhere
            near &= side[:, None] != side[None, :]
        if not near.any():
            return None
        # a pair counts in the first filter that both pass
        mine = table.column("filter")[0].as_py()
        lists = table.column("filters").combine_chunks()
        owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
        values = lists.flatten().to_numpy()
        owner, values = owner[values < mine], values[values < mine]
        names, where = np.unique(values, return_inverse=True)
        has = np.zeros((len(ids), len(names)), np.float32)
        has[owner, where] = 1
        near &= (has @ has.T) == 0
        linked = near.any(axis=1)
        if not linked.any():
            return None
        copies = table.column("copies").to_numpy()
        root = np.arange(len(ids))
        while True:  # smallest member reachable inside this meeting
            low = np.minimum(root, np.where(near, root[None, :], len(ids)).min(axis=1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[linked]), pa.array(ids[root[linked]]),
             pa.array((near.astype(np.float64) @ copies)[linked].astype(np.int64))], schema=_FOUND)


def _meet(cosine: float):
    keys = ("label", "dim", "filter", "i", "j")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting, held, current, out = _Meeting(cosine), [], None, []

        def finish():
            if sum(h.num_rows for h in held) > 1:
                found = meeting.links(pa.Table.from_batches(held))
                if found is not None:
                    out.append(found)

        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist()]
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                key = tuple(c[start] for c in columns)
                if key != current:
                    finish()
                    held, current = [], key
                held.append(batch.slice(start, end - start))
            if out:
                yield from out
                out = []
        finish()
        yield from out

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = 0.98,
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors with equal labels link at a cosine of at least ``cosine``; no pair below it
    ever links. A vector that is NULL, empty, zero, or holds NULL or non-finite
    components links with nothing, nor does one with a NULL label; lengths that differ
    never meet. Exact copies (also repeated rows) count as links of each other, and each
    copy has all the links of the vector. A component is named by its smallest id; a
    NULL id links but names nothing unless it is alone. ``kept`` is whether the id is
    the component's. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    x = F.transform(vector_col, lambda v: v.cast("double"))
    valid = (F.col(label_col).isNotNull() & (F.size(vector_col) > 0)
             & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
             & F.exists(x, lambda v: v != 0))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.coalesce(valid, F.lit(False)).alias("valid"), x.alias("x")
    ).withColumn("sign", F.when(F.col("valid"), F.sha2(F.to_json("x"), 256)))
    classes = staged(
        rows.filter("valid").groupBy("label", "sign").agg(
            F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("x").alias("x"))
        .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("x")), "vectors")

    counts = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    codes = {}
    for dim, count in counts.items():
        sample = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("sign")).limit(SAMPLE).select("x").toArrow()
        codes[dim] = fitted_code(_units(sample.column("x").combine_chunks(), dim)[1], count)
    found = staged(_links(spark, classes, codes, cosine), "vector-links")

    roots = connected_components(found.filter("cid != root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    owned = classes.select("cid", "label", "sign", "first", "copies").join(links, "cid", "left").join(
        roots, F.col("cid") == F.col("node"), "left").select(
        "label", "sign", "first", F.coalesce("root", "cid").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    owned = staged(owned, "owned")
    named = owned.groupBy("root").agg(F.min("first").alias("name"))
    by_sign = staged(owned.join(named, "root").select("label", "sign", "links", "name"), "by-sign")
    discard(owned)
    joined = lookup_join(rows.select("id", "label", "sign"), by_sign, ["label", "sign"])
    name = F.coalesce("name", "id")
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        name.alias("component_id"), name.eqNullSafe(F.col("id")).alias("kept"))


def _links(spark, classes: DataFrame, codes: dict, cosine: float) -> DataFrame:
    """(cid, root, links) as found in each meeting: links counted in this one alone."""
    listed = staged(classes.select("cid", "x").mapInArrow(
        _decode(spark.sparkContext.broadcast(codes)), "cid long, filters array<long>"), "filters")
    rows = classes.select("cid", "label", "dim").join(listed, "cid").select(
        "label", "dim", "cid", F.explode("filters").alias("filter"))
    sizes = rows.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = staged(rows.join(sizes, ["label", "dim", "filter"]).withColumn(
        "blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")), "met")
    # a vector of a large filter goes to every pair of blocks that holds its own
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = met.withColumn("own", own).withColumn("other", other).select(
        "label", "dim", "filter", "cid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"))
    carried = classes.select("cid", "copies", "x").join(listed, "cid")
    order = ["label", "dim", "filter", "i", "j"]
    ready = placed.join(carried, "cid").select(*order, "side", "cid", "copies", "x", "filters")
    return ready.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        _meet(cosine), "cid long, root long, links long")
