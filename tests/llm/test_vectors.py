"""Top-k search and spherical-cap filters."""

import math

import numpy as np
import pytest
from brute import components
from pyspark.sql import functions as F

from skyledger.llm import cap_filters, topk_search
from skyledger.llm.components import connected_components

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "s", 1) for i, v, lab in rows], SCHEMA)


def awkward(rng, n):
    rows = [(i, rng.standard_normal(16) * 0.3, int(rng.integers(0, 3))) for i in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [], 1), (n + 3, [None] * 16, 1), (n + 4, [math.nan] * 16, 1), (n + 5, [math.inf] + [1.0] * 15, 1)]
    rows += [(n + 6, [0.0] * 16, 1), (None, rows[0][1], 0), (n + 7, rows[3][1], None), (50, rows[50][1], rows[50][2]), (n + 8, [0.5] * 7, 0)]
    rows += [(n + 10 + i, rows[5][1], rows[5][2]) for i in range(30)]
    return rows


def usable(v):
    return v is not None and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark):
    rows = awkward(np.random.default_rng(0), 900)
    got = topk_search.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5, pivots=8, fit_rows=200).collect()
    known = {i: np.floor(256 * np.asarray(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and usable(v)}
    want = []
    for q in (i for i in known if i % 50 == 0):
        best = sorted((-int(known[q] @ x), i) for i, x in known.items() if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_top_k_small_and_empty(spark):
    few = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [-1.0, 0.5], 0)]
    got = topk_search.top_k(vectors(spark, few), F.col("vec_id") == 0, k=5).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 65536), (2, -65536)]
    assert topk_search.top_k(vectors(spark, few).limit(0), F.col("vec_id") == 0).count() == 0
    assert topk_search.top_k(vectors(spark, [(0, None, 0)]), F.col("vec_id") == 0).count() == 0


def _brute_links(rows, similarity):
    known = {}
    for i, v, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if i is not None and v is not None and label is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, np.float32).astype(float)
            known[i] = (label, x / np.linalg.norm(x))
    return known, [
        (a, b) for a, (la, x) in known.items() for b, (lb, y) in known.items() if a < b and la == lb and len(x) == len(y) and x @ y >= similarity
    ]


@pytest.mark.parametrize("bucket_rows", [2048, 16])
def test_cap_filters_equal_brute_force(spark, bucket_rows):
    rng = np.random.default_rng(1)
    rows = awkward(rng, 300)
    centre = rng.standard_normal(16) * 0.3
    rows += [(2000 + i, centre + rng.standard_normal(16) * 0.02, 1) for i in range(60)]
    step = rng.standard_normal(16) * 0.3
    rows += [(3000 + i, np.array(rows[7][1]) + step * 0.13 * i, rows[7][2]) for i in range(6)]  # a chain of neighbours
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cap_filters.near_duplicates(vectors(spark, rows), bucket_rows=bucket_rows).collect()}
    known, links = _brute_links(rows, 0.93)
    ids = {i for i, _, _ in rows}
    group = components({i for i in ids if i is not None}, links)
    count = {i: sum(i in pair for pair in links) for i in ids}
    want = {i: (count[i], group.get(i), i is None or group[i] == i) for i in ids}
    assert got == want


def test_cap_filters_recall(spark):
    """Pairs at the least similarity that counts meet in a common filter nearly always."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.standard_normal((2000, 64))
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * away
    lists = []
    for z in (x, y):
        row, number = cap_filters.decode(z)
        lists.append([set(number[row == i].tolist()) for i in range(2000)])
    met = np.mean([bool(a & b) for a, b in zip(*lists, strict=True)])
    assert met > 0.995
    assert min(map(len, lists[0])) >= cap_filters.LEAST_FILTERS


def test_cap_filters_empty(spark):
    assert cap_filters.near_duplicates(vectors(spark, []).limit(0)).count() == 0
    one = cap_filters.near_duplicates(vectors(spark, [(5, None, None)])).collect()
    assert [tuple(r) for r in one] == [(5, 0, 5, True)]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({x for e in edges for x in e if x is not None and None not in e}, [e for e in edges if None not in e])
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
