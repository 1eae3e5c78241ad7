"""Operator 6 against brute force: exact in one leaf, recall over many."""

import numpy as np
import pandas as pd
import pytest

from churnlens.llm import forest
from churnlens.llm.common import spanning


def brute(rows, threshold=0.93):
    """vec_id -> (links, smallest vec_id reachable)."""
    good = [(v, np.array(e, float), l) for v, e, l in rows if v is not None and e and l is not None
            and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links = {v: set() for v, _, _ in rows}
    for i, (a, x, l) in enumerate(good):
        for b, y, m in good[i + 1:]:
            if l == m and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for v in links:
        seen, todo = {v}, [v]
        while todo:
            for u in links[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        out[v] = (len(links[v]), min((x for x in seen if x is not None), default=None))
    return out


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
            (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [0.0, 1.0], 1),
            (13, [0.0, 1.0], 1), (14, [0.0, 1.0], 1), (15, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as vec", "'g' as grp", "0 as tree")
    expected = brute(rows)
    found = forest.near_duplicates(spark, table).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (*expected[r.vec_id], expected[r.vec_id][1] == r.vec_id), r
    assert forest.near_duplicates(spark, table.limit(0)).count() == 0
    twice = forest.near_duplicates(spark, table.union(table)).collect()
    assert len(twice) == 2 * len(rows)


def test_recall_over_leaves(spark, monkeypatch):
    """Small leaves on dense and sparse groups: no link that isn't, and nearly all that are."""
    monkeypatch.setattr(forest, "LEAF", 60)
    rng = np.random.default_rng(4)
    groups = [c + rng.normal(0, s, (n, 24)) for c, s, n in
              [(rng.normal(0, 1, 24), 0.15, 150), (rng.normal(0, 1, 24), 0.25, 60), *[(rng.normal(0, 1, 24), 0.2, 3) for _ in range(60)]]]
    x = np.concatenate(groups)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(rng.permutation(x))]
    found = {r.vec_id: r for r in forest.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    expected = brute(rows)
    total, got = sum(n for n, _ in expected.values()), sum(r.n_links for r in found.values())
    assert all(found[v].n_links <= n for v, (n, _) in expected.items())
    assert got >= 0.9 * total
    same = sum(found[v].component_id == c for v, (_, c) in expected.items())
    assert same >= 0.97 * len(rows)


@pytest.mark.parametrize("n", [5, 700])
def test_forest_spans(n):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, n, 3 * n), rng.integers(0, n, 3 * n)
    links = spanning(a, b, n)
    assert len(links) <= n - 1


def ball(rng, n, spread=0.22, size=64):
    """Vectors around one direction, whose pairs are mostly linked."""
    centre = rng.normal(0, 1, size)
    return centre / np.linalg.norm(centre) + rng.normal(0, spread / size**0.5, (n, size))


def exact(x, threshold=0.93):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(x[i:i + 1000] @ x.T >= threshold).sum(axis=1) - 1 for i in range(0, len(x), 1000)])


def links_of(spark, x):
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x), "label": 0}),
                                  "vec_id long, embedding array<double>, label int")
    found = forest.near_duplicates(spark, table).select("vec_id", "n_links").toPandas().sort_values("vec_id")
    return found["n_links"].to_numpy()


@pytest.mark.parametrize("n", [5_000, 20_000])
def test_a_dense_ball_loses_no_link(spark, n):
    """Production parameters; a group far beyond a leaf, and of several parts."""
    x = ball(np.random.default_rng(n), n)
    expected = exact(x)
    assert expected.mean() > 0.5 * n
    assert (links_of(spark, x) == expected).all()


def test_dense_balls_among_others(spark):
    """Production parameters: balls that share their label with each other and with strangers."""
    rng = np.random.default_rng(8)
    x = np.concatenate([ball(rng, 2_000), ball(rng, 1_500), rng.normal(0, 1, (3_000, 64))])
    expected, got = exact(x), links_of(spark, x)
    assert (got <= expected).all() and got.sum() >= 0.99 * expected.sum()


def test_one_direction_collapses(spark, monkeypatch):
    """Multiples of a vector are one vector: 900 of them and leaves of 4 grow no tree."""
    monkeypatch.setattr(forest, "LEAF", 4)
    seen, grow = [], forest.grow
    monkeypatch.setattr(forest, "grow", lambda vectors, *rest: (seen.append(vectors.count()), grow(vectors, *rest))[1])
    rows = [(i, [0.1 * (i % 300 + 1) if j == 2 else 0.0 for j in range(4)], 0) for i in range(900)]
    rows += [(i, [float(i), -2.0 * i, 0.0, 3.0 * i], 0) for i in range(901, 1000)]
    found = {r.vec_id: r for r in forest.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert seen == [2]
    assert {r.n_links for v, r in found.items() if v < 900} == {899} and {r.n_links for v, r in found.items() if v > 900} == {98}
