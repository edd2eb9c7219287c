"""Second-order boosted trees against a slow second implementation."""

import json
import math
import threading
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayledger.operators import boost, explain, metrics, models, prep
from stayledger.plans import star

S = boost.Settings


def rows_of(n=240, seed=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.normal(size=n).round(2), rng.integers(0, 2, n), np.full(n, 3), rng.integers(0, 40, n) == 0])
    chance = 1 / (1 + np.exp(-(x[:, 0] - 4) * 0.7 - x[:, 1] + x[:, 2]))
    return x.astype(float), (rng.random(n) < chance).astype(int)


@pytest.fixture(scope="module")
def table(spark):
    x, y = rows_of()
    rows = [(i, [float(v) for v in r], int(k), 1.0 + 2.0 * int(k)) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, x array<double>, y int, w double").repartition(3)
    return df.withColumn("features", array_to_vector("x")).drop("x")


def slow_fit(x, y, w, s, edges, seen_by_round):
    """Plain loops over all cuts; a tree is nested (column, cut, left, right) or a number."""
    margin, trees, gains = np.zeros(len(y)), [], {}

    def grow(rows, depth, g, h, columns):
        gt, ht = g[rows].sum(), h[rows].sum()
        leaf = -gt / (ht + s.reg_lambda) * s.learning_rate
        best = (1e-6, None)
        for c in columns if depth < s.max_depth else ():
            for cut in edges[c]:
                left = rows[x[rows, c] <= cut]
                right = rows[x[rows, c] > cut]
                hl, hr = h[left].sum(), h[right].sum()
                if not len(left) or not len(right) or hl < s.min_child_weight or hr < s.min_child_weight:
                    continue
                gain = g[left].sum() ** 2 / (hl + s.reg_lambda) + g[right].sum() ** 2 / (hr + s.reg_lambda) - gt**2 / (ht + s.reg_lambda)
                if gain > best[0] + 1e-12:
                    best = (gain, (c, cut, left, right))
        if best[1] is None:
            return leaf
        c, cut, left, right = best[1]
        gains.setdefault(c, []).append(best[0])
        return c, cut, grow(left, depth + 1, g, h, columns), grow(right, depth + 1, g, h, columns)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for r in range(s.n_estimators):
        p = 1 / (1 + np.exp(-margin))
        seen = np.flatnonzero(seen_by_round(r))
        tree = grow(seen, 0, w * (p - y), w * p * (1 - p), boost.drawn_columns(x.shape[1], r, s))
        margin = margin + np.array([value(tree, row) for row in x])
        trees.append(tree)
    return margin, gains


@pytest.mark.parametrize("s", [S(1, 1.0, 1, 0.0, 1.0, 1.0), S(6, 0.3, 3, 2.0, 1.0, 1.0, 2.5), S(7, 0.3, 3, 1.0, 0.6, 0.6)])
def test_both_ways_match_plain_loops(table, s):
    edges = boost.bin_edges(table, "features")
    matrix = boost.binned(table, "features", edges, F.col("id").cast("long").alias("key"), F.col("y").cast("double").alias("y"), "w").cache()
    n_bins = max(map(len, edges)) + 1
    x, y = rows_of()
    want, _ = slow_fit(x, y, 1.0 + 2.0 * y, s, edges, lambda r: boost.drawn_rows(np.arange(len(y)), r, s))
    apart, levels = boost.grown_apart(matrix, 5, n_bins, s, boost.grow_in_task), boost.grow_by_levels(matrix, 5, n_bins, s)
    for trees in (apart, levels):
        assert len(trees) == s.n_estimators
        bins = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
        got = sum(np.array(t.value)[t.walk(bins)] for t in trees)
        assert got == pytest.approx(want, abs=1e-9)
    for a, b in zip(apart, levels):
        assert a.lists()[:4] == b.lists()[:4] and a.gain == pytest.approx(b.gain) and a.cover == pytest.approx(b.cover)


def test_margins_are_written_anew(table, monkeypatch):
    monkeypatch.setattr(boost, "REFRESH", 2)
    edges = boost.bin_edges(table, "features")
    matrix = boost.binned(table, "features", edges, F.col("id").cast("long").alias("key"), F.col("y").cast("double").alias("y"), "w")
    n_bins, s = max(map(len, edges)) + 1, S(5, 0.3, 2, 1.0)
    a, b = boost.grown_apart(matrix, 5, n_bins, s, boost.grow_in_task), boost.grow_by_levels(matrix, 5, n_bins, s)
    assert [t.lists()[:4] for t in a] == [t.lists()[:4] for t in b]


def test_cuts_are_values_with_rows_on_both_sides(table):
    edges = boost.bin_edges(table, "features")
    x, _ = rows_of()
    assert edges[0] == list(range(8)) and edges[2] == [0.0] and edges[3] == [] and edges[4] == [0.0]
    assert len(edges[1]) <= 255 and set(edges[1]) <= set(x[:, 1].tolist()) and max(edges[1]) < x[:, 1].max()
    few = boost.bin_edges(table, "features", max_bins=4)
    assert all(len(e) <= 3 for e in few) and few[4] == [0.0]  # a rare value keeps its cut
    with pytest.raises(ValueError):
        boost.bin_edges(table, "features", max_bins=257)
    with pytest.raises(ValueError):
        boost.bin_edges(table.limit(0), "features")


def test_rows_and_columns_are_drawn_in_their_shares():
    s = S(subsample=0.7, colsample_bytree=0.5)
    keys = np.arange(20000)
    drawn = np.stack([boost.drawn_rows(keys, r, s) for r in range(20)])
    assert drawn.mean(axis=1) == pytest.approx(0.7, abs=0.015)
    assert drawn.mean(axis=0).std() == pytest.approx(math.sqrt(0.7 * 0.3 / 20), rel=0.1)  # rounds are independent
    assert (drawn[3] == boost.drawn_rows(keys, 3, s)).all()
    columns = [tuple(boost.drawn_columns(9, r, s)) for r in range(30)]
    assert {len(c) for c in columns} == {4} and len(set(columns)) > 10
    assert len(boost.drawn_columns(1, 0, s)) == 1


def test_estimator_scores_saves_and_ranks_by_gain(spark, table, tmp_path):
    s = S(4, 0.3, 2, 1.0, 1.0, 1.0)
    estimator = boost.BoostedTrees(labelCol="y", weightCol="w", settings=json.dumps(s._asdict()))
    model = estimator.fit(table)
    x, y = rows_of()
    margin, gains = slow_fit(x, y, 1.0 + 2.0 * y, s, model.fitted["edges"], lambda r: np.ones(len(y), bool))
    got = {r["id"]: r["p"] for r in model.transform(table).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(1 / (1 + np.exp(-margin)))
    mean = np.array([np.mean(gains.get(c, [0.0])) for c in range(5)])
    assert model.featureImportances.toArray() == pytest.approx(mean / mean.sum())
    table_ = explain.builtin_importance(spark, model, [f"f{i}" for i in range(5)])
    assert table_.count() == 5
    Pipeline(stages=[estimator]).fit(table).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[0].nodes() == model.nodes()
    assert model.transform(table.limit(0)).count() == 0
    far = estimator.copy({estimator.taskBytes: 1}).fit(table)
    assert [n[:6] for n in far.nodes()] == [n[:6] for n in model.nodes()]


def test_folds_share_one_preprocessing(clinical, monkeypatch):
    """One fit of the preprocessor per fold, and the scores of fits made one by one."""
    target = "hospital_expire_flag"
    rows = clinical.withColumn("fold", (F.col("stay_id") % 2).cast("int"))
    stage = prep.build_preprocessor(["anchor_age", "creatinine_first"], ["gender"])
    options = [dict(n_estimators=n, max_depth=d, min_child_weight=0.5, subsample=1.0, positive_weight=p) for n, d, p in ((3, 2, 0.0), (5, 1, 0.0), (3, 2, 2.0))]
    pipelines = {str(i): models.build_boosted_trees(stage, target=target, **o) for i, o in enumerate(options)}
    pipelines["forest"] = models.build_random_forest(stage, target=target, n_estimators=3, max_depth=2)
    fits = []
    plain = prep.TabularPreprocessor._fit
    monkeypatch.setattr(prep.TabularPreprocessor, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    got = {(r["model"], r["fold"]): (r["auroc"], r["auprc"]) for r in models.fold_scores(pipelines, rows, target=target, n_folds=2).collect()}
    assert len(fits) == 2 and len(got) == 8
    for (name, k), areas in got.items():
        if name == "forest":  # its rows are drawn by keys of the fold table
            assert all(0 <= v <= 1 for v in areas)
            continue
        model = pipelines[name].fit(rows.where(F.col("fold") != k))
        held = models.predict_positive(model, rows.where(F.col("fold") == k), keep=[target])
        row = metrics.discrimination_metrics(held, target=target, probability=models.SCORE).first()
        assert areas == pytest.approx((row["auroc"], row["auprc"]))


def test_large_matrices_are_fitted_by_levels_in_folds(clinical):
    target = "hospital_expire_flag"
    rows = clinical.withColumn("fold", (F.col("stay_id") % 2).cast("int"))
    pipeline = models.build_boosted_trees(prep.build_preprocessor(["anchor_age"], []), target=target, n_estimators=2, max_depth=1, subsample=1.0, min_child_weight=0.1)
    near = models.fold_scores({"a": pipeline}, rows, target=target, n_folds=2).orderBy("fold").collect()
    pipeline.getStages()[-1]._set(taskBytes=1)
    far = models.fold_scores({"a": pipeline}, rows, target=target, n_folds=2).orderBy("fold").collect()
    assert near == far


def test_fits_lie_apart_and_the_longest_comes_first(spark):
    rng = np.random.default_rng(2)
    rows = [(p, k % 3 == 0, 400 * p + k, float(k % 2), rng.integers(0, 4, 2).astype(np.uint8).tobytes()) for p in (0, 1) for k in range(40)]
    parts = spark.createDataFrame([(p, h, k, y, bytearray(b)) for p, h, k, y, b in rows], "part int, held boolean, key long, y double, bins binary")
    candidates = [S(2, 0.3, 1, 0.0), S(9, 0.3, 3, 0.0), S(5, 0.3, 2, 0.0)]
    scored = boost.fit_side_by_side(
        parts, candidates, {0: 2, 1: 2}, {0: (1.0, 1.0), 1: (1.0, 2.0)}, boost.grow_in_task, boost.BoostedTreesModel._chance, boost.effort
    )
    assert scored.rdd.getNumPartitions() == 6
    at = {(r["candidate"], r["part"]): r["at"] for r in scored.withColumn("at", F.spark_partition_id()).collect()}
    assert sorted(at, key=at.get) == [(1, 0), (1, 1), (2, 0), (2, 1), (0, 0), (0, 1)]


def test_bytes_are_read_where_they_lie():
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array([b"abc", b"def", b"ghi", b"jkl"], kind)
        for part in (column, column.slice(1, 2), column.slice(3)):
            got = boost.byte_rows(part, 3)
            assert got.tobytes() == b"".join(part.to_pylist()) and got.shape == (len(part), 3)
            assert column.buffers()[2].address <= got.ctypes.data < column.buffers()[2].address + 12  # no copy
    assert boost.byte_rows(pa.array([], pa.binary()), 3).shape == (0, 3)
    assert boost.byte_rows(pa.array([b"", b""], pa.binary()), 0).shape == (2, 0)


def test_rows_walk_some_at_a_time(monkeypatch):
    monkeypatch.setattr(boost, "WALKED", 7)
    monkeypatch.setattr(boost, "STEPS", 2)
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 256, (60, 3)).astype(np.uint8)
    bins[0] = 255
    tree = boost.Tree()
    for node, column, cut in ((0, 1, 90), (1, 0, 254), (3, 2, 40), (5, 1, 0), (2, 2, 120)):
        tree.cut(node, column, cut, 1.0)

    def end(row, node):
        while tree.column[node] >= 0:
            node = tree.left[node] if row[tree.column[node]] <= tree.bin[node] else tree.right[node]
        return node

    assert tree.walk(bins).tolist() == [end(r, 0) for r in bins]
    begun = rng.integers(0, len(tree.column), 60)
    before = begun.tolist()
    assert tree.walk(bins, begun).tolist() == [end(r, n) for r, n in zip(bins, before)] and begun.tolist() == before
    assert boost.Tree().walk(np.zeros((3, 0), np.uint8)).tolist() == [0, 0, 0]


def test_a_value_at_a_cut_goes_left_and_nan_right(spark):
    trees = [[[0, -1, -1], [1, 0, 0], [1, 0, 0], [2, 0, 0], [0.0, -1.0, 1.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]]
    model = boost.BoostedTreesModel(state=json.dumps({"edges": [[1.0, 2.5], []], "trees": trees}))
    df = spark.createDataFrame([(x, [x, 7.0]) for x in (2.4, 2.5, 2.6, float("nan"), -0.0)], "x double, v array<double>")
    scored = model.transform(df.withColumn("features", array_to_vector("v"))).select("prediction").collect()
    assert [r["prediction"] for r in scored] == [0, 0, 1, 1, 0]


def test_both_sums_of_a_column_take_one_pass(monkeypatch):
    rng = np.random.default_rng(3)
    bins, y = rng.integers(0, 30, (400, 4)).astype(np.uint8), rng.integers(0, 2, 400).astype(float)
    monkeypatch.setattr(np, "bincount", None)  # which sums one value a pass
    trees = list(boost.grow_in_task(bins, y, 1 + y, np.arange(400), 30, S(3, 0.3, 3, 0.5, subsample=0.7)))
    assert len(trees) == 3 and max(len(t.column) for t in trees) > 3


def test_fits_are_placed_without_texts(spark):
    parts = spark.createDataFrame([(5, False, 1, 1.0, bytearray(b"a"))], "part int, held boolean, key long, y double, bins binary")
    scored = boost.fit_side_by_side(parts, [S(2, 0.3, 1, 0.0)], {5: 1}, {5: (1.0, 1.0)}, boost.grow_in_task, boost.BoostedTreesModel._chance, boost.effort)
    assert "concat_ws" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_kinds_of_trees_are_fitted_side_by_side(clinical, monkeypatch):
    both, fit = threading.Barrier(2, timeout=120), models._tree_scores
    monkeypatch.setattr(models, "_tree_scores", lambda *a: both.wait() and None or fit(*a))
    target = "hospital_expire_flag"
    rows = clinical.withColumn("fold", (F.col("stay_id") % 2).cast("int"))
    stage = prep.build_preprocessor(["anchor_age", "lactate_first"], [])
    pipelines = {
        "forest": models.build_random_forest(stage, target=target, n_estimators=3),
        "boosted": models.build_boosted_trees(stage, target=target, n_estimators=3, positive_weight=0.0),
    }
    found = models.fold_scores(pipelines, rows, target=target, n_folds=2).collect()
    assert sorted((r["model"], r["fold"]) for r in found) == [("boosted", 0), ("boosted", 1), ("forest", 0), ("forest", 1)]


def test_jobs_side_by_side_keep_their_order(spark):
    all_three = threading.Barrier(3, timeout=60)
    assert models.side_by_side(spark, lambda n: all_three.wait() and None or spark.range(n).count(), [3, 1, 2]) == [3, 1, 2]


def test_texts_are_counted_by_runs(spark):
    texts = [None, "", "abc", "A1 B22\n\U0001f600Z9", "Ä١ 7 ", "QX", "12"]
    documents = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    found = star.document_rows(SimpleNamespace(documents=documents, labels=labels))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "[^0-9]+" in plan and "[^A-Z]+" in plan
    got = [(r["n_digits"], r["n_upper"]) for r in found.orderBy("doc_id").collect()]
    assert got == [(None, None), (0, 0), (0, 0), (4, 3), (1, 0), (0, 2), (2, 0)]


def test_columns_of_few_bins_are_one_number():
    rng = np.random.default_rng(12)
    sizes = [256, 3, 2, 40, 5, 1, 256]
    x = np.stack([rng.integers(0, n, 500) for n in sizes]).astype(np.uint8)
    x[:, -1] = [n - 1 for n in sizes]
    for most in (0, 6, 300, 1 << 12, 1 << 20):
        codes, places = boost.joint_columns(x, most)
        assert sorted(c for _, columns in places for c in columns) == list(range(7))
        for code, (shape, columns) in zip(codes, places):
            assert [sizes[c] for c in columns] == list(shape) and (len(columns) == 1 or np.prod(shape) <= most)
            assert np.array(np.unravel_index(code, shape)).tolist() == x[list(columns)].tolist()
    assert len(boost.joint_columns(x, 0)[0]) == 7 and len(boost.joint_columns(x, 1 << 20)[0]) < 4


@pytest.mark.parametrize("s", [S(6, 0.3, 4, 0.5), S(5, 0.3, 3, 1.0, 1.0, 0.5), S(4, 0.3, 2, 5.0, 0.6, 1.0)])
def test_columns_summed_together_make_the_same_trees(s, monkeypatch):
    rng = np.random.default_rng(13)
    bins = np.stack([rng.integers(0, n, 600) for n in (200, 2, 3, 30, 2)], axis=1).astype(np.uint8)
    y, key = (rng.random(600) < 0.2 + 0.3 * bins[:, 1] + 0.002 * bins[:, 0]).astype(float), np.arange(600)
    apart = [t.lists() for t in boost.grow_in_task(bins, y, 1 + 0.3 * y, key, 200, s)]
    for name, value in {"JOINED": 0, "JOINT": 500}.items():
        monkeypatch.setattr(boost, name, value)
    joined = [t.lists() for t in boost.grow_in_task(bins, y, 1 + 0.3 * y, key, 200, s)]
    assert len(joined) == s.n_estimators and sum(len(t[0]) for t in joined) > 4 * s.n_estimators
    for a, b in zip(joined, apart):
        assert a[:4] == b[:4] and all(v == pytest.approx(u) for v, u in zip(a[4:], b[4:]))
