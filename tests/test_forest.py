"""Binned forests and tree explanations against slow second implementations."""

import itertools
import json
import math
import pickle
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayledger.operators import boost, explain, forest
from tests.test_boost import rows_of

S = forest.Settings


@pytest.fixture(scope="module")
def table(spark):
    x, y = rows_of(160, 8)
    rows = [(i, [float(v) for v in r], int(k), 1.0 + int(k)) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, x array<double>, y int, w double").repartition(3)
    return df.withColumn("features", array_to_vector("x")).drop("x")


def slow_tree(x, y, w, t, s, edges):
    """Plain loops, nodes numbered as they are made; (column, cut, left, right, value) per node."""
    times = forest.times_drawn(np.arange(len(y)), t, s)
    nodes, level = {}, [(0, np.flatnonzero(times))]
    made, depth = 1, 0
    while level:
        following = []
        for node, rows in level:
            h = w[rows] * times[rows]
            g = h * y[rows]
            value = g.sum() / h.sum()
            best = (1e-9, None)
            if depth < (30 if s.max_depth is None else s.max_depth) and 0 < g.sum() < h.sum():
                for c in forest.node_columns([node], t, x.shape[1], s)[0]:
                    for cut in edges[c]:
                        left = x[rows, c] <= cut
                        if left.sum() < s.min_samples_leaf or (~left).sum() < s.min_samples_leaf:
                            continue
                        drop = g[left].sum() ** 2 / h[left].sum() + g[~left].sum() ** 2 / h[~left].sum() - g.sum() ** 2 / h.sum()
                        if drop > best[0] + 1e-12:
                            best = (drop, (int(c), cut, rows[left], rows[~left]))
            if best[1] is None:
                nodes[node] = (-1, None, value)
                continue
            c, cut, left, right = best[1]
            nodes[node] = (c, cut, value)
            following += [(made, left), (made + 1, right)]
            made += 2
        level, depth = following, depth + 1
    return nodes


@pytest.mark.parametrize("s", [S(5, 3, 4, "sqrt"), S(4, None, 2, 0.7), S(3, 1, 5, "log2")])
def test_both_ways_match_plain_loops(table, s):
    edges = boost.bin_edges(table, "features", max_bins=16)
    matrix = boost.binned(table, "features", edges, F.col("id").cast("long").alias("key"), F.col("y").cast("double").alias("y"), "w").cache()
    n_bins = max(map(len, edges)) + 1
    x, y = rows_of(160, 8)
    apart, levels = boost.grown_apart(matrix, 5, n_bins, s, forest.grow_in_task), forest.grow_by_levels(matrix, 5, n_bins, s)
    assert len(apart) == len(levels) == s.n_estimators
    for t, (a, b) in enumerate(zip(apart, levels)):
        want = slow_tree(x, y, 1.0 + y, t, s, edges)
        for tree in (a, b):
            got = {i: (c, edges[c][k] if c >= 0 else None, pytest.approx(v)) for i, (c, k, v) in enumerate(zip(tree.column, tree.bin, tree.value))}
            assert want == got
        assert a.lists()[:4] == b.lists()[:4] and a.gain == pytest.approx(b.gain) and a.cover == pytest.approx(b.cover)


def test_draws_follow_their_laws():
    s = S(max_features=0.5)
    times = np.stack([forest.times_drawn(np.arange(20000), t, s) for t in range(10)])
    for k in range(4):
        assert (times == k).mean() == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.004)
    assert np.corrcoef(times)[0, 1:] == pytest.approx(0, abs=0.03)
    columns = forest.node_columns(np.arange(4000), 3, 10, s)
    assert columns.shape == (4000, 5) and (np.diff(columns, axis=1) > 0).all()
    assert np.bincount(columns.ravel(), minlength=10) / 4000 == pytest.approx(0.5, abs=0.04)
    assert [forest.column_count(140, S(max_features=m)) for m in ("sqrt", "log2", 0.7)] == [11, 7, 98]


def test_estimator_averages_its_trees(table):
    s = S(6, 3, 3, "sqrt")
    estimator = forest.BinnedForest(labelCol="y", weightCol="w", settings=json.dumps(s._asdict()))
    model = estimator.fit(table)
    x, y = rows_of(160, 8)
    nodes = {}
    for tree, node, column, cut, left, right, value, _, _ in model.nodes():
        nodes[tree, node] = (column, cut, left, right, value)

    def chance(row):
        total = 0.0
        for t in range(6):
            n = 0
            while nodes[t, n][0] >= 0:
                c, cut, left, right, _ = nodes[t, n]
                n = left if row[c] <= cut else right
            total += nodes[t, n][4]
        return total / 6

    got = {r["id"]: r["p"] for r in model.transform(table).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx([chance(r) for r in x])
    share = model.featureImportances.toArray()
    assert share.sum() == pytest.approx(1) and share[3] == 0 and share[0] > share[2]
    far = estimator.copy({estimator.taskBytes: 1}).fit(table)
    assert [n[:6] for n in far.nodes()] == [n[:6] for n in model.nodes()]


def slow_shapley(x, tree, n_features):
    """Shapley values by every subset of features; outside a subset, covers weigh both children."""

    def value(node, known):
        column, cut, left, right, share, cover = tree[node]
        if column < 0:
            return share
        if column in known:
            return value(left if x[column] <= cut else right, known)
        return sum(tree[c][5] * value(c, known) for c in (left, right)) / (tree[left][5] + tree[right][5])

    phi = np.zeros(n_features)
    for i in range(n_features):
        rest = [j for j in range(n_features) if j != i]
        for k in range(n_features):
            for chosen in itertools.combinations(rest, k):
                w = math.factorial(k) * math.factorial(n_features - k - 1) / math.factorial(n_features)
                phi[i] += w * (value(0, {*chosen, i}) - value(0, set(chosen)))
    return phi


@pytest.mark.parametrize("tabled", [12, 1])
def test_pattern_tables_give_shapley_values(spark, table, monkeypatch, tabled):
    monkeypatch.setattr(explain, "TABLED", tabled)
    monkeypatch.setattr(explain, "TABLE_CELLS", 64)
    model = forest.BinnedForest(labelCol="y", weightCol="w", settings=json.dumps(S(3, 4, 3, 0.7)._asdict())).fit(table)
    leaves = explain.leaf_paths(explain.node_table(spark, model))
    x, _ = rows_of(160, 8)
    got = explain.shapley_batch(x[:25], leaves)
    trees = {}
    for tree, node, column, cut, left, right, value, _, cover in model.nodes():
        trees.setdefault(tree, {})[node] = (column, cut, left, right, value, cover)
    want = np.array([sum(slow_shapley(row, t, 5) for t in trees.values()) / 3 for row in x[:25]])
    assert got == pytest.approx(want, abs=1e-9)


def test_trees_are_made_one_by_one_and_in_shares(monkeypatch):
    drawn = []
    times = forest.times_drawn
    monkeypatch.setattr(forest, "times_drawn", lambda key, t, s: drawn.append(t) or times(key, t, s))
    rng = np.random.default_rng(4)
    bins, y, key = rng.integers(0, 9, (300, 4)).astype(np.uint8), rng.integers(0, 2, 300).astype(float), np.arange(300)
    s = S(6, None, 2, 0.7)
    grown = forest.grow_in_task(bins, y, 1 + y, key, 9, s)
    first = next(grown)
    assert drawn == [0]  # no tree is kept until the last is grown
    whole = [first, *grown]
    monkeypatch.setattr(forest, "TASK_CELLS", 50)  # nodes are summed a few at a time
    dealt = {t: tree for some in forest.shares(s, 4) for t, tree in zip(some, forest.grow_in_task(bins, y, 1 + y, key, 9, s, some))}
    assert sorted(dealt) == list(range(6))
    assert [dealt[t].lists() for t in range(6)] == [t.lists() for t in whole]


def test_shares_of_trees_make_the_same_forest(table):
    edges = boost.bin_edges(table, "features", max_bins=16)
    matrix = boost.binned(table, "features", edges, F.col("id").cast("long").alias("key"), F.col("y").cast("double").alias("y"), "w").cache()
    n_bins, s = max(map(len, edges)) + 1, S(7, 4, 2, 0.7)
    one = boost.grown_apart(matrix, 5, n_bins, s, forest.grow_in_task)
    many = boost.grown_apart(matrix, 5, n_bins, s, forest.grow_in_task, forest.shares(s, 3))
    assert [t.lists() for t in many] == [t.lists() for t in one]


def test_small_nodes_have_cells_for_the_bins_they_hold(monkeypatch):
    rng = np.random.default_rng(6)
    bins, y, key = rng.integers(0, 60, (700, 4)).astype(np.uint8), rng.integers(0, 2, 700).astype(float), np.arange(700)
    cells, cuts = [], forest.best_cuts
    monkeypatch.setattr(forest, "best_cuts", lambda g, h, n, s: cells.append(g.size) or cuts(g, h, n, s))
    s = S(4, None, 2, 0.7)
    grown = [t.lists() for t in forest.grow_in_task(bins, y, 1 + 0.3 * y, key, 60, s)]
    nodes = sum(len(lists[0]) for lists in grown)
    assert sum(cells) < nodes * forest.column_count(4, s) * 60 / 4
    monkeypatch.setattr(forest, "SMALL_NODES", ())  # cells for every bin
    assert [t.lists() for t in forest.grow_in_task(bins, y, 1 + 0.3 * y, key, 60, s)] == grown


def test_the_set_bits_of_a_mask():
    held = np.array([0b1, 0b10100, 0b10100, 1 << 63 | 1, 1 << 63 | 1, (1 << 64) - 1], np.uint64)
    assert forest._nth_bit(held, np.array([0, 0, 1, 0, 1, 41])).tolist() == [0, 2, 4, 0, 63, 41]


@pytest.mark.parametrize("s", [S(5, 3, 4, "sqrt"), S(4, None, 2, 0.7), S(3, 1, 5, "log2")])
def test_counted_draws_match_plain_loops(table, s, monkeypatch):
    edges = boost.bin_edges(table, "features", max_bins=16)
    x, y = rows_of(160, 8)
    bins = np.stack([np.searchsorted(e, x[:, c], side="left") for c, e in enumerate(edges)], axis=1).astype(np.uint8)
    w, key, n_bins = 1.0 + 0.3 * y, np.arange(160), max(map(len, edges)) + 1
    summed = [t.lists() for t in forest.grow_in_task(bins, y, w, key, n_bins, s)]
    counts, count = [], forest._Draws._count
    monkeypatch.setattr(forest._Draws, "_count", lambda *a: counts.append(len(a[2])) or count(*a))
    for name, value in {"COUNTED": 0, "LARGE_NODE": 30, "AT_ONCE": 16, "JOINT": 200, "TASK_CELLS": 90}.items():
        monkeypatch.setattr(forest, name, value)
    counted = [t.lists() for t in forest.grow_in_task(bins, y, w, key, n_bins, s)]
    assert counts and min(counts) >= 30 and len(counted) == s.n_estimators
    for t, (a, b) in enumerate(zip(counted, summed)):
        assert a[:4] == b[:4] and all(v == pytest.approx(u) for v, u in zip(a[4:], b[4:]))
        got = {i: (c, edges[c][k] if c >= 0 else None, pytest.approx(v)) for i, (c, k, v) in enumerate(zip(a[0], a[1], a[4]))}
        assert slow_tree(x, y, w, t, s, edges) == got


def test_draws_are_counted_where_classes_weigh_alike(monkeypatch):
    x, y = np.random.default_rng(2).integers(0, 40, (4, 90)).astype(np.uint8), np.arange(90) % 2.0
    assert forest._Draws.of(x, y, 1 + y, 2).weights == [1.0, 2.0]
    assert forest._Draws.of(x, 0 * y, 1 + y, 2) is None and forest._Draws.of(x, 2 * y, 1 + y, 2) is None
    assert forest._Draws.of(x, 0 * y, 3 + 0 * y, 2).weights == [3.0, 1.0]
    monkeypatch.setattr(forest, "JOINT", 1)  # a number a column
    assert forest._Draws.of(x, y, 1 + y, 2) is not None and forest._Draws.of(x, y, 1 + y, 1) is None


def test_candidates_with_the_same_trees_are_one_fit(spark):
    rng = np.random.default_rng(11)
    rows = [(p, k % 3 == 0, 400 * p + k, float(rng.integers(0, 2)), bytearray(rng.integers(0, 9, 3 + p).astype(np.uint8).tobytes())) for p in (0, 1) for k in range(80)]
    parts = spark.createDataFrame(rows, "part int, held boolean, key long, y double, bins binary")
    # sqrt and log2 of 3 or 4 columns draw as many
    candidates = [S(3, 2, 2, "sqrt"), S(6, None, 2, "sqrt"), S(9, 4, 2, "log2"), S(5, 4, 3, "sqrt"), S(9, 2, 2, 0.9), S(9, 0, 2, "sqrt")]
    weights = {0: (1.0, 1.5), 1: (1.0, 2.0)}

    def scores(alike):
        fits = boost.fit_side_by_side(parts, candidates, {0: 3, 1: 4}, weights, forest.grow_in_task, forest.BinnedForestModel._chance, forest.effort, alike)
        found = sorted((r["candidate"], r["part"], r["y"], r["score"]) for r in fits.collect())
        return fits.rdd.getNumPartitions(), found

    alone, together = scores(None), scores(forest.alike)
    assert alone[0] == 12 and together[0] < 12
    assert len(alone[1]) == 6 * 54 and together[1] == alone[1]


def test_a_tree_that_was_less_deep():
    rng = np.random.default_rng(3)
    bins, y, key = rng.integers(0, 9, (300, 4)).astype(np.uint8), rng.integers(0, 2, 300).astype(float), np.arange(300)
    (whole,) = forest.grow_in_task(bins, y, 1 + y, key, 9, S(1, None, 2, 0.7))
    for depth in (0, 1, 2, 5, 30):
        (short,) = forest.grow_in_task(bins, y, 1 + y, key, 9, S(1, depth, 2, 0.7))
        end, cut_off = short.walk(bins), whole.upto(depth)
        assert cut_off.walk(bins).tolist() == end.tolist() and np.array(cut_off.value)[end].tolist() == np.array(short.value)[end].tolist()
    assert whole.upto(None) is whole


def test_fields_of_a_number_do_not_touch():
    x, y = np.zeros((1, 4), np.uint8), np.array([0.0, 1.0, 0.0, 1.0])
    most = forest._Draws.of(x, y, 1 + y, 1).packed[-1]  # a positive, drawn as often as can be
    whole = np.bincount(np.zeros(forest.AT_ONCE, int), np.full(forest.AT_ONCE, most))
    assert [int(v[0]) for v in forest._fields(whole)] == [forest.AT_ONCE, 9 * forest.AT_ONCE, 9 * forest.AT_ONCE]
    assert whole[0] < 2**53 and forest.LARGE_NODE <= forest.AT_ONCE


@pytest.mark.parametrize("kind", [forest, boost])
def test_large_matrices_need_no_package_in_a_task(kind, tmp_path):
    rng = np.random.default_rng(14)
    n = max(forest.COUNTED, boost.JOINED)
    bins, y, key = rng.integers(0, 9, (n, 3)).astype(np.uint8), rng.integers(0, 2, n).astype(float), np.arange(n)
    sent = cloudpickle.dumps((kind.grow_in_task, (bins, y, 1 + y, key, 9, kind.Settings(2, max_depth=2))))
    (tmp_path / "sent").write_bytes(sent)
    run = "import pickle; grow, given = pickle.load(open('sent', 'rb')); pickle.dump([t.lists() for t in grow(*given)], open('trees', 'wb'))"
    subprocess.run([sys.executable, "-c", run], cwd=tmp_path, env={"PATH": ""}, check=True)
    made = pickle.loads((tmp_path / "trees").read_bytes())
    assert made == [t.lists() for t in kind.grow_in_task(bins, y, 1 + y, key, 9, kind.Settings(2, max_depth=2))]
