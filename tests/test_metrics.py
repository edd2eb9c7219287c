import math
import random

import pytest
from pyspark.sql import functions as F

from stayledger.operators import ledger, metrics

ON = {"target": "y", "probability": "p"}


def frame(spark, y, p):
    rows = [(i, a, float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "id bigint, y int, p double")


def brute_areas(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    auroc = None
    if pos and neg:
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        auroc = wins / (len(pos) * len(neg))
    ap = None
    if pos:
        ap = sum(
            sum(y for y, p in rows if p >= s) / sum(1 for _, p in rows if p >= s)
            for s in pos
        ) / len(pos)
    return auroc, ap


def test_areas_match_pair_counting_with_heavy_ties_and_skew(spark):
    rng = random.Random(3)
    rows = [
        (rng.randint(0, 1), 0.5 if i % 3 == 0 else round(rng.random() ** 5, 3))
        for i in range(600)
    ]
    df = frame(spark, *zip(*rows)).repartition(5)
    for buckets in (2, 64):
        row = ledger.area_metrics(df, **ON, buckets=buckets).first()
        assert row["auroc"] == pytest.approx(brute_areas(rows)[0], abs=1e-12)
        assert row["auprc"] == pytest.approx(brute_areas(rows)[1], abs=1e-12)


def test_average_precision_is_stepwise(spark):
    df = frame(spark, [0, 1, 0, 1, 0], [0.1, 0.9, 0.95, 0.35, 0.4])
    assert metrics.discrimination_metrics(df, **ON).first()["auprc"] == pytest.approx(0.5)


def test_undefined_areas_are_null(spark):
    ones = metrics.discrimination_metrics(frame(spark, [1, 1], [0.2, 0.3]), **ON).first()
    assert ones["auroc"] is None and ones["auprc"] == 1.0
    zeros = metrics.discrimination_metrics(frame(spark, [0, 0], [0.2, 0.3]), **ON).first()
    assert zeros["auroc"] is None and zeros["auprc"] is None


def test_known_confusion(spark):
    # 0.5 itself is flagged
    df = frame(spark, [1, 0, 1, 0, 1, 0, 0], [0.52, 0.51, 0.49, 0.03, 0.88, 0.5, 0.44])
    r = metrics.classification_metrics(df, **ON, threshold=0.5).first()
    assert [r[c] for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")] == [2, 2, 1, 2]
    assert r["recall_sensitivity"] == pytest.approx(2 / 3) and r["specificity"] == 0.5
    assert r["patients_flagged"] == 4 and r["flagged_percentage"] == pytest.approx(4 / 7)
    cells = {(c["actual"], c["predicted"]): c["n"] for c in metrics.confusion_matrix(df, **ON).collect()}
    assert cells == {(0, 0): 2, (0, 1): 2, (1, 0): 1, (1, 1): 2}


def test_empty_denominators(spark):
    r = metrics.classification_metrics(frame(spark, [1, 1], [0.1, 0.2]), **ON).first()
    assert r["precision_ppv"] == 0 and r["recall_sensitivity"] == 0 and r["f1_score"] == 0
    assert r["specificity"] is None and r["negative_predictive_value"] == 0.0
    r = metrics.classification_metrics(frame(spark, [1, 1], [0.9, 0.8]), **ON).first()
    assert r["negative_predictive_value"] is None


def test_separable_scores(spark):
    df = frame(spark, [1, 1, 0, 0, 0], [0.41, 0.97, 0.4, 0.02, 0.4])
    r = metrics.discrimination_metrics(df, **ON).first()
    assert r["auroc"] == 1.0 and r["auprc"] == 1.0


def test_probability_quality(spark):
    df = frame(spark, [1, 0, 0], [0.6, 0.25, 0.5])
    r = metrics.probability_metrics(df, **ON).first()
    assert r["brier_score"] == pytest.approx((0.16 + 0.0625 + 0.25) / 3)
    want = -(math.log(0.6) + math.log(0.75) + math.log(0.5)) / 3
    assert r["log_loss"] == pytest.approx(want)
    assert r["observed_event_rate"] == pytest.approx(1 / 3) and r["mean_predicted_risk"] == pytest.approx(0.45)


def test_certain_and_wrong_is_clipped(spark):
    r = metrics.quality_metrics(frame(spark, [1, 0], [0.0, 1.0]), **ON).first()
    assert r["log_loss"] == pytest.approx(-math.log(1e-8), rel=1e-6)


def test_sweep_has_a_row_per_threshold(spark):
    df = frame(spark, [1, 0, 1, 1, 0], [0.15, 0.35, 0.45, 0.95, 0.65])
    rows = metrics.threshold_sweep(df, **ON, thresholds=[0.4, 0.65, 0.9]).orderBy("threshold").collect()
    assert [r["threshold"] for r in rows] == [0.4, 0.65, 0.9]
    assert [(r["true_positives"], r["false_positives"]) for r in rows] == [(2, 1), (1, 1), (1, 0)]
    with pytest.raises(ValueError):
        metrics.threshold_sweep(df, **ON, thresholds=[1.2])


def test_review_capacity(spark):
    df = frame(spark, [0, 1, 1, 0, 1, 0, 0, 1], [0.33, 0.66, 0.12, 0.77, 0.91, 0.05, 0.48, 0.59])
    rows = {
        r["review_capacity_percentage"]: r
        for r in metrics.review_capacity(df, **ON, row_id="id", capacities=[0.25, 0.6]).collect()
    }
    assert (rows[0.25]["patients_reviewed"], rows[0.25]["deaths_captured"]) == (2, 1)
    assert (rows[0.6]["patients_reviewed"], rows[0.6]["deaths_captured"]) == (5, 3)
    assert rows[0.6]["false_alerts_among_reviewed"] == 2
    with pytest.raises(ValueError):
        metrics.review_capacity(df, **ON, row_id="id", capacities=[0.0])


def test_subgroups_with_null_and_one_class(spark):
    rows = list(
        zip(
            ["F", "F", "M", "M", "M", "F", None, "X"],
            [0, 1, 0, 1, 0, 0, 1, 0],
            [0.1, 0.8, 0.2, 0.7, 0.3, 0.4, 0.9, 0.6],
        )
    )
    df = spark.createDataFrame(rows, "gender string, y int, p double")
    got = {
        r["subgroup_value"]: r
        for r in metrics.subgroup_metrics(
            df, subgroups=["gender"], **ON, minimum_sample_size=2, minimum_events=1
        ).collect()
    }
    assert set(got) == {"F", "M", None, "X"}
    assert got["F"]["sample_size"] == 3 and got["F"]["recall_sensitivity"] == 1.0
    assert got["M"]["auroc"] == 1.0 and not got["M"]["small_sample_warning"]
    assert got[None]["auroc"] is None and got[None]["small_sample_warning"]
    assert got["X"]["auprc"] is None and got["X"]["few_event_warning"]
    assert got["X"]["interpretation_note"].startswith("Exploratory only")
    with pytest.raises(ValueError):
        metrics.subgroup_metrics(df, subgroups=["absent"], **ON)


def test_calibration_bins_drop_empty_ones(spark):
    df = frame(spark, [0, 0, 1, 1], [0.05, 0.06, 0.95, 0.96])
    uniform = metrics.calibration_bins(df, **ON, n_bins=10, strategy="uniform").collect()
    assert {r["bin"]: r["n"] for r in uniform} == {0: 2, 9: 2}
    quantile = metrics.calibration_bins(df, **ON, n_bins=2).collect()
    assert sorted((r["bin"], r["n"], r["observed_rate"]) for r in quantile) == [(0, 2, 0.0), (1, 2, 1.0)]
    with pytest.raises(ValueError):
        metrics.calibration_bins(df, **ON, strategy="other")


def test_histogram_top_edge_stays_in_the_last_bin(spark):
    df = frame(spark, [0] * 16, [i / 15 for i in range(16)])
    rows = metrics.score_histogram(df, **ON).collect()
    assert max(r["bin"] for r in rows) == 15 and sum(r["n"] for r in rows) == 16


def test_categories_and_representatives(spark):
    df = frame(spark, [1, 1, 0, 0, 1, 0], [0.9, 0.6, 0.7, 0.2, 0.1, 0.4])
    labelled = metrics.error_categories(df, **ON)
    counts = {r["prediction_category"]: r["count"] for r in labelled.groupBy("prediction_category").count().collect()}
    assert counts == {"true_positive": 2, "false_positive": 1, "true_negative": 2, "false_negative": 1}
    chosen = metrics.representative_cases(labelled, probability="p", row_id="id")
    assert {r["prediction_category"]: r["id"] for r in chosen.collect()} == {
        "true_positive": 0, "false_positive": 2, "true_negative": 3, "false_negative": 4,
    }
    summary = {r["prediction_category"]: r for r in metrics.error_category_summary(labelled, probability="p").collect()}
    assert summary["true_positive"]["median_predicted_probability"] == pytest.approx(0.75)


def test_context_skips_absent_columns(spark):
    cases = frame(spark, [1], [0.5])
    context = spark.createDataFrame([(0, 3.0)], "id bigint, spo2_mean double")
    got = metrics.with_context(cases, context, key="id", columns=["spo2_mean", "oxygen_saturation_mean"])
    assert got.columns == ["id", "y", "p", "spo2_mean"]


def test_picks(spark):
    sweep = metrics.threshold_sweep(frame(spark, [0, 0, 1, 1], [0.12, 0.33, 0.58, 0.83]), **ON)
    assert metrics.best_f1(sweep).first()["threshold"] == 0.4
    assert metrics.high_sensitivity(sweep).first()["threshold"] == 0.4
    labels = metrics.operational_thresholds(sweep).where(F.col("threshold") == 0.2).first()
    assert labels["interpretation"].startswith("High-sensitivity")
    assert labels["use_case_interpretation"] == "Higher-sensitivity screening"


def test_models_are_ordered_by_average_precision(spark):
    rows = [("good", 0, 0.1), ("good", 1, 0.9), ("bad", 0, 0.9), ("bad", 1, 0.1)]
    df = spark.createDataFrame(rows, "model string, y int, p double")
    table = metrics.compare_models(df, model="model", **ON)
    assert [r["model"] for r in table.collect()] == ["good", "bad"]
    assert metrics.select_model(table).first()["model"] == "good"
    calibrated = metrics.compare_calibrations(df.withColumnRenamed("model", "method"), method="method", **ON)
    assert metrics.select_calibration(calibrated).first()["method"] == "good"


def test_curves_end_at_one(spark):
    df = frame(spark, [0, 1, 0, 1], [0.2, 0.6, 0.7, 0.9])
    roc = ledger.roc_points(df, **ON).orderBy("fpr", "tpr").collect()
    assert roc[-1]["fpr"] == roc[-1]["tpr"] == 1.0
    pr = ledger.pr_points(df, **ON).orderBy("threshold").collect()
    assert pr[0]["recall"] == 1.0 and pr[-1]["precision"] == 1.0
