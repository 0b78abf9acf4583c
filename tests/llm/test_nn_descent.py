import numpy as np
import pytest
from pyspark.sql import functions as F
from readloom.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.93):
    """vec_id, n_links, component_id, kept from all cosines."""
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    groups = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            groups.setdefault((label, len(v)), []).append(k)
    for g in groups.values():
        x = np.array([rows[k][1] for k in g])
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if a != b:
                links[g[a]] += 1
                up[root(g[a])] = root(g[b])
    low = {}
    for k, (i, _, _) in enumerate(rows):
        low[root(k)] = min((x for x in (low.get(root(k)), i) if x is not None), default=None)
    return sorted(repr((i, links[k], low[root(k)], None if i is None else i == low[root(k)])) for k, (i, _, _) in enumerate(rows))


def f32(x):
    return x.astype(np.float32).astype(float).tolist()


def vectors(r, dim=24):
    """Lone vectors, pairs, many copies of one, and a group of near copies that is larger than a list, a window and a tile."""
    base = r.standard_normal((150, dim))
    found = [(f32(b), 1) for b in base] + [(f32(b + 0.15 * r.standard_normal(dim)), 1) for b in base[:40]] + [(f32(base[7]), 1)] * 120
    middle = r.standard_normal(dim)
    return found + [(f32(middle + 0.15 * r.standard_normal(dim)), 2) for _ in range(400)] + [(f32(3 * b), 2) for b in base[:60]]


ODD = [(900_001, None, 1), (900_002, [0.0] * 24, 1), (900_003, [None] + [1.0] * 23, 1), (900_004, [float("nan")] * 24, 1), (900_005, [1.0] * 24, None), (900_006, [1.0, 2.0], 1), (900_007, [2.0, 4.0], 1), (900_008, [float("-inf")] * 24, 2), (None, [1.0, 2.0], 1), (None, None, 1), (900_006, [1.0, 2.0], 1), (900_009, [], 1), (900_010, [-1.0, -2.0], 1), (None, [5.0, 0.0, 1.0], 9), (900_011, [1e30] * 24, 7), (900_012, [1e-30] * 24, 7)]


def test_links_equal_all_cosines(spark):
    rows = [(k * 3, v, label) for k, (v, label) in enumerate(vectors(np.random.default_rng(4)))] + ODD
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("component_id", F.lit("x")).withColumn("id", F.lit(1))
    found = nn_descent.near_groups(df)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert sorted(map(repr, map(tuple, found.collect()))) == plain(rows)


def test_rounds_find_what_the_first_windows_miss(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "WINDOW", 8)
    rows = [(k, v, label) for k, (v, label) in enumerate(vectors(np.random.default_rng(5)))]
    found = nn_descent.nodes(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    state, audit = nn_descent.graph(found, "<f4", orders=1)
    true = sum(int(r.split(", ")[1]) for r in plain([(r.id, r.key, r.label) for r in found.collect()]))
    assert audit.recall >= 0.97 and audit.rounds > 2
    assert state.agg(F.sum("links")).first()[0] >= 0.97 * true
    assert state.agg(F.max("cap")).first()[0] > 400  # saturated lists have grown


def test_pivots_of_many_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "TILE", 16)
    rows = [(k, v, label) for k, (v, label) in enumerate(vectors(np.random.default_rng(6)))]
    assert sorted(map(repr, map(tuple, nn_descent.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()))) == plain(rows)


def test_low_recall_fails(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "audited", lambda *_: nn_descent.Audit(10, 10, 0.5, 1))
    with pytest.raises(ValueError, match="0.500"):
        nn_descent.near_groups(spark.createDataFrame([(1, [1.0, 2.0], 1)], SCHEMA), orders=1).collect()


def test_empty_and_double_tables(spark):
    assert nn_descent.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in nn_descent.near_groups(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect()] == [(1, 0, 1, True)]
    double = [(1, [0.1, 0.2], 1), (2, [0.1, 0.2 + 1e-12], 1), (3, [1e200, 2e200], 1), (4, [0.2, -0.1], 1)]
    assert sorted(tuple(r) for r in nn_descent.near_groups(spark.createDataFrame(double, "vec_id long, embedding array<double>, label int")).collect()) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


def test_a_window_sends_no_more_than_lists_take(spark, monkeypatch):
    """All pairs of a window were sent, six times as many as lists can take; a task that merged them went out of memory."""
    r = np.random.default_rng(7)
    x = r.standard_normal((90, 16))
    x[60:] = x[60] + 0.01 * r.standard_normal((30, 16))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids, sizes, worst = np.arange(90) * 7, np.ones(90, np.int64), np.full(90, -2.0)
    out = nn_descent.Updates(1)
    assert not list(out.meet(x, ids, sizes, worst, 0.93, 10))
    (rows,) = out.rows()
    got = {(a, b) for a, b in zip(rows.column("owner")[0].as_py(), rows.column("other")[0].as_py(), strict=True)}
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    rank = np.argsort(np.argsort(-sim, axis=1), axis=1)
    assert got == {(7 * a, 7 * b) for a, b in zip(*np.nonzero((rank < 10) | (sim >= 0.93)), strict=True)}

    made = [(k, [float(v) for v in r.standard_normal(8)], 1) for k in range(300)]
    found = nn_descent.nodes(spark.createDataFrame(made, SCHEMA), "vec_id", "embedding", "label")
    sent = nn_descent.windows(found, "<f4", 0.93, 10, 3, 42, 8).selectExpr("sum(size(owner))").first()[0]
    assert 300 * 10 <= sent <= 300 * 10 * 2 * 3 * 1.1

    asked = []
    monkeypatch.setattr(nn_descent, "MERGED", 1000)
    monkeypatch.setattr(nn_descent, "merged", lambda *a, f=nn_descent.merged: asked.append(a[3]) or f(*a))
    nn_descent.graph(found, "<f4", orders=3)
    assert asked[0] * 1000 >= sent  # a bucket has no more than a task merges
