import itertools
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from stayledger.operators import calibrate, explain, models, prep
from tests.conftest import FEATURES

TARGET = "hospital_expire_flag"


def stage():
    return prep.build_preprocessor(FEATURES[:3], FEATURES[3:])


@pytest.fixture(scope="module")
def logistic(splits):
    return models.train_logistic_model(stage(), splits[0], target=TARGET)


@pytest.fixture(scope="module")
def forest(splits):
    return models.train_random_forest(
        stage(), splits[0], target=TARGET, n_estimators=6, max_depth=4, min_samples_leaf=2
    )


@pytest.fixture(scope="module")
def boosted(splits):
    return models.train_boosted_trees(
        stage(), splits[0], target=TARGET, n_estimators=3, max_depth=2
    )


@pytest.mark.parametrize("name", ["logistic", "forest", "boosted"])
def test_probabilities_are_probabilities(name, splits, request):
    model = request.getfixturevalue(name)
    assert [type(s).__name__ for s in model.stages[:2]] == [
        "TabularPreprocessorModel",
        "ClassWeightsModel",
    ]
    scored = models.predict_positive(model, splits[2].drop(TARGET), keep=["stay_id"])
    values = [r[models.SCORE] for r in scored.collect()]
    assert len(values) == 15
    assert all(math.isfinite(v) and 0 <= v <= 1 for v in values)


def test_logistic_is_at_the_summed_loss_optimum(logistic, splits):
    rows = logistic.stages[1].transform(logistic.stages[0].transform(splits[0])).select(
        vector_to_array("features").alias("x"), TARGET, models.WEIGHT
    ).collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r[TARGET] for r in rows])
    w = np.array([r[models.WEIGHT] for r in rows])
    assert w.sum() == pytest.approx(len(y))  # balanced weights sum to n
    beta, b = logistic.stages[2].coefficients.toArray(), logistic.stages[2].intercept
    p = 1 / (1 + np.exp(-(x @ beta + b)))
    gradient = x.T @ (w * (p - y)) + beta
    assert np.abs(gradient).max() < 1e-3 and abs((w * (p - y)).sum()) < 1e-3


def test_saved_pipeline_scores_alike(forest, splits, tmp_path):
    path = str(tmp_path / "model")
    forest.write().overwrite().save(path)
    again = PipelineModel.load(path)
    row = models.score_difference(
        models.predict_positive(forest, splits[2], keep=["stay_id"]),
        models.predict_positive(again, splits[2], keep=["stay_id"]),
        key="stay_id",
    ).first()
    assert (row["rows_compared"], row["max_difference"]) == (15, 0.0)


def test_prior_and_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert models.prior_scores(df, df, target="y", keep=["y"]).first()[models.SCORE] == 0.25
    assert models.scale_pos_weight(df, target="y") == 3.0
    weights = {r["y"]: r["class_weight"] for r in models.class_weights(df, target="y").collect()}
    assert weights == {0: pytest.approx(2 / 3), 1: 2.0}
    with pytest.raises(ValueError):
        models.scale_pos_weight(df.where("y = 0"), target="y")


def test_candidates_are_distinct_and_repeatable():
    one = models.draw_candidates(models.BOOSTED_GRID, 16)
    assert one == models.draw_candidates(models.BOOSTED_GRID, 16)
    assert len({str(c) for c in one}) == 16
    assert len(models.draw_candidates({"a": [1, 2]}, 10)) == 2


def test_random_search_and_summary(splits):
    train = splits[0].withColumn("fold", (F.col("stay_id") % 2).cast("int"))
    model, scores, best = models.random_search(
        models.build_random_forest,
        stage(),
        train,
        target=TARGET,
        grid={"n_estimators": [2], "max_depth": [1, None]},
        draws=2,
        n_folds=2,
        min_samples_leaf=2,
    )
    assert set(best) == {"n_estimators", "max_depth"} and len(model.stages) == 3
    table = models.search_results(scores).orderBy("rank_test_score").collect()
    assert [len(r["fold_scores"]) for r in table] == [2, 2] and table[0]["rank_test_score"] == 1
    for r in table:
        assert r["mean_test_score"] == pytest.approx(np.mean(r["fold_scores"]))
        assert r["std_test_score"] == pytest.approx(np.std(r["fold_scores"]))
    summary = models.cv_summary(scores).collect()
    assert len(summary) == 2


def test_evaluator_works_in_spark_tuning(splits):
    pipeline = models.build_logistic_model(stage(), target=TARGET)
    grid = ParamGridBuilder().addGrid(pipeline.getStages()[-1].C, [0.1, 1.0]).build()
    tuned = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=models.AveragePrecisionEvaluator(labelCol=TARGET),
        numFolds=2,
        seed=1,
    ).fit(splits[0])
    assert len(tuned.avgMetrics) == 2 and all(0 <= v <= 1 for v in tuned.avgMetrics)


def test_coefficients(logistic, splits):
    rows = models.logistic_coefficients(logistic, splits[0]).collect()
    assert len(rows) == len(logistic.stages[0].feature_names())
    assert all(r["odds_ratio"] == pytest.approx(math.exp(r["coefficient"])) for r in rows)


# --- calibration ---------------------------------------------------------------------------


def scores(spark):
    rows = [(i, int((i * 7) % 11 < i / 10), round(i / 100, 2)) for i in range(100)]
    return spark.createDataFrame(rows, "id bigint, y int, p double")


def test_sigmoid_of_odd_scores(spark):
    """No rows, one score, missing scores, perfectly separated and far-off scores."""
    fit = lambda rows: calibrate.fit_sigmoid(spark.createDataFrame(rows, "p double, y int"), score="p", target="y")
    assert fit([]) == calibrate.SigmoidCalibrator(0.0, 0.0)
    flat = fit([(0.3, 1), (0.3, 0), (0.3, 0), (None, 1)])
    assert flat.slope == 0.0 and 1 / (1 + math.exp(-flat.intercept)) == pytest.approx((2 / 3 + 2 / 4) / 3)
    for far in (0.0, 1e6):
        split_ = fit([(far + x, int(x > 5)) for x in range(11)])
        p = [1 / (1 + math.exp(-(split_.slope * (far + x) + split_.intercept))) for x in range(11)]
        # the optimum: successes and their scores are met on average
        want = [(5 + 1) / (5 + 2) if x > 5 else 1 / (6 + 2) for x in range(11)]
        assert sum(p) == pytest.approx(sum(want), abs=1e-6)
        assert sum(x * v for x, v in enumerate(p)) == pytest.approx(sum(x * v for x, v in enumerate(want)), abs=1e-5)


def test_sigmoid_solves_the_smoothed_problem(spark):
    df = scores(spark)
    fitted = calibrate.fit_calibrator(df, method="sigmoid", score="p", target="y")
    rows = df.collect()
    y = np.array([r["y"] for r in rows])
    s = np.array([r["p"] for r in rows])
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    q = 1 / (1 + np.exp(-(fitted.slope * s + fitted.intercept)))
    assert abs((q - target).sum()) < 1e-4 and abs(((q - target) * s).sum()) < 1e-4
    got = fitted.apply(df, score="p", out="q").orderBy("id").collect()
    assert np.allclose([r["q"] for r in got], q)


def test_isotonic_never_decreases(spark):
    df = scores(spark)
    fitted = calibrate.fit_calibrator(df, method="isotonic", score="p", target="y")
    got = [r["q"] for r in fitted.apply(df, score="p", out="q").orderBy("p").collect()]
    assert all(a <= b for a, b in zip(got, got[1:])) and 0 <= got[0] and got[-1] <= 1
    assert sum(got) == pytest.approx(sum(r["y"] for r in df.collect()))
    with pytest.raises(ValueError):
        calibrate.fit_calibrator(df, method="other", score="p", target="y")


# --- explanations ----------------------------------------------------------------------------


def conditional(tree, node_id, x, known):
    node = tree[node_id]
    if node["left"] < 0:
        return node["positive_share"]
    if node["feature"] in known:
        nxt = node["left"] if x[node["feature"]] <= node["threshold"] else node["right"]
        return conditional(tree, nxt, x, known)
    return sum(
        tree[c]["cover"] / node["cover"] * conditional(tree, c, x, known)
        for c in (node["left"], node["right"])
    )


def brute_shapley(trees, x):
    n = len(x)
    value = {
        frozenset(s): sum(conditional(t, 0, x, set(s)) for t in trees.values()) / len(trees)
        for k in range(n + 1)
        for s in itertools.combinations(range(n), k)
    }
    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        total = 0.0
        for k in range(n):
            weight = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
            for s in itertools.combinations(rest, k):
                total += weight * (value[frozenset((*s, i))] - value[frozenset(s)])
        out.append(total)
    return out


def test_contributions_equal_the_definition(spark, forest, splits):
    nodes = explain.node_table(spark, forest.stages[2])
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    names = forest.stages[0].feature_names()
    data = forest.stages[0].transform(splits[2])
    got = explain.tree_shap(
        forest.stages[2], data, row_id="stay_id", feature_names=names
    ).toPandas()
    for row in data.orderBy("stay_id").limit(4).collect():
        mine = got[got.stay_id == row["stay_id"]].set_index("feature")["shap_value"]
        want = brute_shapley(trees, row["features"].toArray())
        assert np.allclose([mine[n] for n in names], want, atol=1e-12)


def test_additivity_completeness_and_tables(spark, forest, splits):
    names = forest.stages[0].feature_names()
    data = forest.stages[0].transform(splits[2])
    contributions = explain.tree_shap(
        forest.stages[2], data, row_id="stay_id", feature_names=names
    )
    base = explain.base_value(explain.node_table(spark, forest.stages[2]))
    scored = models.predict_positive(forest, splits[2], keep=["stay_id", TARGET])
    row = explain.shap_additivity(
        contributions, scored, base, row_id="stay_id", score=models.SCORE
    ).first()
    assert row["rows_compared"] == 15 and row["max_additivity_error"] < 1e-12
    whole = explain.shap_completeness(contributions, row_id="stay_id", n_features=len(names)).first()
    assert tuple(whole) == (15, 0, 0)
    importance = explain.global_importance(contributions)
    ranks = [r["importance_rank"] for r in importance.orderBy("importance_rank").collect()]
    assert ranks == list(range(1, len(names) + 1))
    builtin = explain.builtin_importance(spark, forest.stages[2], names)
    compared = explain.compare_importance(importance, builtin)
    assert compared.count() == len(names)
    with pytest.raises(ValueError):
        explain.compare_importance(importance.drop("importance_rank"), builtin)
    with pytest.raises(TypeError):
        explain.builtin_importance(spark, object(), names)
    local = explain.local_explanations(contributions, scored.limit(2), row_id="stay_id", top=3)
    assert local.count() == 6
    points = explain.dependence_points(contributions, importance, top=2)
    assert points.select("feature").distinct().count() == 2 and points.count() == 30
    sparse = explain.tree_shap(
        forest.stages[2], data, row_id="stay_id", feature_names=names, nonzero_only=True
    )
    assert sparse.where("shap_value = 0").count() == 0
