"""Vector operators against brute force, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbair.llm import caps
from curbair.llm.caps import near_vectors
from curbair.llm.topk import top_inner_products

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(rng, n, dim=16, spread=0.02):
    centres = rng.normal(size=(max(1, n // 6), dim))
    return [[float(v) for v in centres[rng.integers(len(centres))] + spread * rng.normal(size=dim)] for _ in range(n)]


def brute_links(rows, cosine=0.98):
    def unit(x):
        if not x or any(v is None or not np.isfinite(v) for v in x) or not any(x):
            return None
        v = np.array(x, np.float32).astype(np.float64)
        return v / np.linalg.norm(v)

    units = [None if label is None else unit(x) for _, x, label in rows]
    links = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None
              and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine]
             for i in range(len(rows))]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            for j in near:
                if root[j] < root[i]:
                    root[i], changed = root[j], True
    return links, root


@pytest.mark.parametrize("block", [1024, 5])
def test_cap_filters_find_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, x, int(rng.integers(2))) for i, x in enumerate(clustered(rng, 150))]
    rows += [(150 + i, rows[0][1], rows[0][2]) for i in range(12)]
    links, root = brute_links(rows)
    found = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == len(rows)
    total = sum(map(len, links))
    assert sum(r.n_links for r in found.values()) >= 0.98 * total
    assert all(found[i].n_links <= len(links[i]) for i in found)
    same = sum(found[i].component_id == root[i] for i in found)
    assert same >= 0.98 * len(rows) and all(r.kept == (r.component_id == r.vec_id) for r in found.values())


def test_cap_filters_on_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
            (7, [1.0, 2.0], None), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 1), (10, [2.0, 4.0], 1), (10, [2.0, 4.0], 1),
            (11, [1.0, 2.0, 3.0], 1), (12, [1.0, 2.0], 2), (13, [1.0], 1), (14, [2.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n_links": F.lit("x"), "filter": F.lit(1), "cid": F.lit(2)})
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 8, 11, 12)]
    linked = [(9, 2, 9, True), (10, 2, 9, False), (10, 2, 9, False), (13, 1, 13, True), (14, 1, 13, False)]
    assert found == sorted(alone + linked)
    assert near_vectors(df.limit(0)).count() == 0


def brute_top(rows, wanted, k=10):
    kept = [(i, np.floor(1024 * np.array(x, np.float32).astype(np.float64)).astype(np.int64)) for i, x, _ in rows
            if x is not None and all(v is not None and np.isfinite(v) for v in x)]
    out = []
    for q, x in kept:
        if wanted(q):
            scores = sorted((-int(x @ y), i) for i, y in kept if i != q and len(x) == len(y))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 3])
def test_top_products_equal_brute_force(spark, block):
    rng = np.random.default_rng(9)
    rows = [(i, x, 0) for i, x in enumerate(clustered(rng, 200, dim=8))]
    rows += [(200 + i, rows[3][1], 0) for i in range(30)]  # ties
    found = top_inner_products(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, block=block)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, lambda i: i % 10 == 0)


def test_top_products_on_odd_vectors(spark):
    rows = [(0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0), (3, [float("nan"), 0.0], 0), (4, [float("-inf"), 0.0], 0),
            (5, [3.0], 0), (6, [0.5, 0.5], 0), (10, [-1.0, -1.0], 0), (20, [], 0), (None, [9.0, 9.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "away": F.lit(1), "score": F.lit(1)})
    found = sorted(tuple(r) for r in top_inner_products(df, F.col("vec_id") % 10 == 0).collect())
    assert found == brute_top(rows[:-1], lambda i: i % 10 == 0)
    assert top_inner_products(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_components_of_long_paths_and_loops(spark):
    from curbair.llm.components import connected_components

    path = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_products_of_large_components_and_repeated_queries(spark):
    """Nothing is refused: products beyond 64 bits are exact, their report is the nearest."""
    big = [2.0**70, -(2.0**70), 3e38, 2.0**40, 1.0, 0.0]
    rows = [(i, [big[i % 6], big[(i + 1) % 6] / 3, 1.5]) for i in range(60)]
    rows += [(10, [5.0, 1.0, 0.5]), (10, [5.0, 1.0, 0.5]), (20, [2.0**45, 2.0**45, -1.0]), (21, [2.0**45, 2.0**45, -1.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    held = [(i, [int(np.floor(1024 * v)) for v in x]) for i, x in rows]
    expected = []
    for q, x in held:
        if q % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in held if i != q)[:4]
            expected += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores, 1)]
    found = top_inner_products(df, F.col("vec_id") % 10 == 0, k=4)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_most_candidates_are_eliminated():
    """The joint bound of all pivots is never too low and leaves few candidates."""
    from curbair.llm import topk

    rng = np.random.default_rng(2)
    x = np.floor(1024 * np.array(clustered(rng, 3000, dim=64, spread=0.3)))
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None])
    for count, most in ((64, 0.05), (48, 1.0), (5, 1.0)):
        span = topk.pivot_span(topk.choose_pivots(x[:2000].tolist(), count))
        place = topk.places(x, span)
        scores = x.astype(np.int64) @ x[:40].astype(np.int64).T
        assert (place @ place[:40].T + 1e-6 + topk.SLACK * 2 * (x**2).sum(axis=1)[:, None] >= scores).all()
        best = topk._Best(np.arange(40), np.arange(40), x[:40], place[:40], 10)
        for at in range(0, 3000, 500):
            part = slice(at, at + 500)
            best.offer(np.arange(3000)[part], np.arange(3000)[part], x[part], place[part])
        for i in range(40):
            order = sorted((-int(s), j) for j, s in enumerate(scores[:, i]) if j != i)[:10]
            assert [(s, v) for s, v, _ in best.found[i]] == order
        assert best.evaluated <= most * best.offered


def test_near_vectors_close_to_the_limit(spark):
    """Recall for pairs whose cosine lies between 0.98 and 0.985."""
    rng = np.random.default_rng(8)
    rows, pairs = [], 0
    for i in range(300):
        a = rng.normal(size=32)
        a /= np.linalg.norm(a)
        side = rng.normal(size=32)
        side -= (side @ a) * a
        side /= np.linalg.norm(side)
        cosine = rng.uniform(0.9802, 0.985)
        b = cosine * a + np.sqrt(1 - cosine**2) * side
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, b.tolist(), 0)]
        pairs += 1
    found = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_links for r in found) / 2 >= 0.95 * pairs


def test_directions_grow_with_the_rows():
    assert [caps.codes_for(n) for n in (0, 10**6, 4 * 10**6, 10**9)] == [8, 45, 64, 252]
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = caps.fitted_code(x, 20_000_000)
    assert len(code.parts[0]) == 95
    for a, b, (ids, scores) in zip(*code.lists(x), code.decode(x, 8), strict=True):
        sums = a[:, None] + b[None, :]
        level = min(code.threshold, np.sort(sums.ravel())[-8])
        assert sorted(ids.tolist()) == np.flatnonzero(sums.ravel() >= level - 1e-12).tolist()
        assert np.allclose(scores, sums.ravel()[ids])
