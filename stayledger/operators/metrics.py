"""Metric tables over scored rows.

Labels and scores are two columns of one DataFrame.  ``by`` columns turn every
metric into one row per group in the same single pass: per model, per
calibration method, per subgroup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayledger.config import (
    DEFAULT_THRESHOLDS,
    MINIMUM_SUBGROUP_EVENTS,
    MINIMUM_SUBGROUP_SIZE,
    REVIEW_CAPACITIES,
)
from stayledger.functions import (
    clip_probability,
    hard_label,
    interpretation_note,
    operating_point_label,
    outcome_category,
    ratio_or_null,
    ratio_or_zero,
    use_case_label,
)
from stayledger.operators.ledger import area_metrics
from stayledger.operators.scale import exact_quantiles, join_small, top_k_sums

RECORD_FIELDS = (
    "auroc",
    "auprc",
    "threshold",
    "accuracy",
    "precision_ppv",
    "recall_sensitivity",
    "specificity",
    "negative_predictive_value",
    "f1_score",
    "true_negatives",
    "false_positives",
    "false_negatives",
    "true_positives",
    "patients_flagged",
    "flagged_percentage",
)


def _check_threshold(threshold: float) -> float:
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be between 0 and 1")
    return float(threshold)


def discrimination_metrics(
    df: DataFrame, *, target: str, probability: str, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., auroc, auprc)."""
    return area_metrics(df, target=target, probability=probability, by=by)


def quality_metrics(
    df: DataFrame, *, target: str, probability: str, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., brier_score, log_loss, mean_predicted_risk, observed_event_rate)."""
    p = clip_probability(F.col(probability).cast("double"))
    y = F.col(target).cast("double")
    return df.groupBy(*by).agg(
        F.avg((p - y) * (p - y)).alias("brier_score"),
        F.avg(-(y * F.ln(p) + (1.0 - y) * F.ln(1.0 - p))).alias("log_loss"),
        F.avg(p).alias("mean_predicted_risk"),
        F.avg(y).alias("observed_event_rate"),
    )


def _attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two per-group tables; without groups both are a single row."""
    key = [*by, "_all"]
    joined = join_small(
        left.withColumn("_all", F.lit(0)),
        right.withColumn("_all", F.lit(0)),
        key,
        bounded=not by,
    )
    return joined.drop("_all")


def probability_metrics(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    by: Sequence[str] = (),
    clip_before_ranking: bool = False,
) -> DataFrame:
    """Discrimination plus probability quality, one row per group.

    ``clip_before_ranking`` also ranks on the clipped scores, as the
    calibration comparison does.
    """
    ranked = df
    if clip_before_ranking:
        ranked = df.withColumn(
            probability, clip_probability(F.col(probability).cast("double"))
        )
    areas = area_metrics(ranked, target=target, probability=probability, by=by)
    quality = quality_metrics(df, target=target, probability=probability, by=by)
    return _attach(areas, quality, by)


def _confusion_counts(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    thresholds: Sequence[float],
    by: Sequence[str],
) -> DataFrame:
    """One scan for all thresholds: counts flagged and hit, then one row each."""
    p, y = F.col(probability).cast("double"), F.col(target)
    sums: list[Column] = [
        F.count("*").alias("_n"),
        F.count_if(y == 1).alias("_p"),
    ]
    for i, t in enumerate(thresholds):
        flagged = p >= F.lit(t)
        sums.append(F.count_if(flagged).alias(f"_f{i}"))
        sums.append(F.count_if(flagged & (y == 1)).alias(f"_h{i}"))
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"),
                F.col(f"_f{i}").alias("_flagged"),
                F.col(f"_h{i}").alias("_hits"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return (
        df.groupBy(*by)
        .agg(*sums)
        .select(*by, "_n", "_p", F.explode(cells).alias("_c"))
        .select(*by, "_n", "_p", "_c.*")
    )


def _record_columns() -> dict[str, Column]:
    n, positives = F.col("_n"), F.col("_p")
    flagged, tp = F.col("_flagged"), F.col("_hits")
    fp = flagged - tp
    fn = positives - tp
    tn = n - positives - fp
    return {
        "threshold": F.col("threshold"),
        "accuracy": ratio_or_null(tp + tn, n),
        "precision_ppv": ratio_or_zero(tp, flagged),
        "recall_sensitivity": ratio_or_zero(tp, positives),
        "specificity": ratio_or_null(tn, tn + fp),
        "negative_predictive_value": ratio_or_null(tn, tn + fn),
        "f1_score": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "true_negatives": tn,
        "false_positives": fp,
        "false_negatives": fn,
        "true_positives": tp,
        "patients_flagged": flagged,
        "flagged_percentage": ratio_or_null(flagged, n),
    }


def threshold_sweep(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """The 15-field classification record for every threshold and group."""
    points = [_check_threshold(t) for t in thresholds]
    counts = _confusion_counts(
        df, target=target, probability=probability, thresholds=points, by=by
    )
    records = counts.select(
        *by, *[c.alias(name) for name, c in _record_columns().items()]
    )
    areas = area_metrics(df, target=target, probability=probability, by=by)
    return _attach(records, areas, by).select(*by, *RECORD_FIELDS)


def classification_metrics(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    threshold: float = 0.50,
    by: Sequence[str] = (),
) -> DataFrame:
    """The 15-field record at one threshold."""
    return threshold_sweep(
        df, target=target, probability=probability, thresholds=[threshold], by=by
    )


def confusion_matrix(
    df: DataFrame, *, target: str, probability: str, threshold: float = 0.50
) -> DataFrame:
    """Four rows (actual, predicted, n), zero cells included."""
    t = _check_threshold(threshold)
    counts = _confusion_counts(
        df, target=target, probability=probability, thresholds=[t], by=()
    )
    tp, fp = F.col("_hits"), F.col("_flagged") - F.col("_hits")
    fn = F.col("_p") - tp
    tn = F.col("_n") - F.col("_p") - fp
    cells = [(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)]
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(actual).alias("actual"),
                        F.lit(predicted).alias("predicted"),
                        n.alias("n"),
                    )
                    for actual, predicted, n in cells
                ]
            )
        )
    )


def review_capacity(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    row_id: str,
    capacities: Sequence[float] = REVIEW_CAPACITIES,
) -> DataFrame:
    """Events caught when only the top share of rows by score is reviewed."""
    for capacity in capacities:
        if not 0 < capacity <= 1:
            raise ValueError("review capacities must be in (0, 1]")
    cuts = top_k_sums(
        df, score=probability, tie=row_id, flag=target, fractions=capacities
    )
    return cuts.select(
        F.col("fraction").alias("review_capacity_percentage"),
        F.col("k").alias("patients_reviewed"),
        F.col("captured").alias("deaths_captured"),
        F.col("total").alias("total_deaths"),
        ratio_or_null(F.col("captured"), F.col("total")).alias("death_capture_rate"),
        ratio_or_null(F.col("captured"), F.col("k")).alias("precision_among_reviewed"),
        (F.col("k") - F.col("captured")).alias("false_alerts_among_reviewed"),
        (F.col("fraction") * 100).alias("capacity_percent"),
        (ratio_or_null(F.col("captured"), F.col("total")) * 100).alias("capture_percent"),
    )


def subgroup_metrics(
    df: DataFrame,
    *,
    subgroups: Sequence[str],
    target: str,
    probability: str,
    threshold: float = 0.50,
    minimum_sample_size: int = MINIMUM_SUBGROUP_SIZE,
    minimum_events: int = MINIMUM_SUBGROUP_EVENTS,
) -> DataFrame:
    """Classification record per value of each subgroup variable.

    All variables are unpivoted and measured in one pass; a NULL value is a
    subgroup of its own.
    """
    absent = sorted({*subgroups, target, probability} - set(df.columns))
    if absent:
        raise ValueError(f"missing subgroup-analysis columns: {absent}")
    long = df.select(
        F.col(target),
        F.col(probability),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("subgroup_variable"),
                        F.col(c).cast("string").alias("subgroup_value"),
                    )
                    for c in subgroups
                ]
            )
        ).alias("_g"),
    ).select(target, probability, "_g.*")
    by = ["subgroup_variable", "subgroup_value"]
    counts = _confusion_counts(
        long,
        target=target,
        probability=probability,
        thresholds=[_check_threshold(threshold)],
        by=by,
    )
    records = counts.select(
        *by,
        F.col("_n").alias("sample_size"),
        F.col("_p").alias("deaths"),
        ratio_or_null(F.col("_p"), F.col("_n")).alias("event_rate"),
        *[c.alias(name) for name, c in _record_columns().items()],
    )
    areas = area_metrics(long, target=target, probability=probability, by=by)
    small = F.col("sample_size") < minimum_sample_size
    few = F.col("deaths") < minimum_events
    return _attach(records, areas, by).select(
        *by,
        "sample_size",
        "deaths",
        "event_rate",
        *RECORD_FIELDS,
        small.alias("small_sample_warning"),
        few.alias("few_event_warning"),
        interpretation_note(small, few).alias("interpretation_note"),
    )


def subgroup_event_rates(df: DataFrame, *, subgroups: Sequence[str], target: str) -> DataFrame:
    """(label 'variable: value', event_rate) for the event-rate chart."""
    cells = F.array(
        *[
            F.concat_ws(
                ": ", F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("nan"))
            )
            for c in subgroups
        ]
    )
    return (
        df.select(target, F.explode(cells).alias("label"))
        .groupBy("label")
        .agg(F.avg(F.col(target).cast("double")).alias("event_rate"))
    )


def compare_models(
    long_scores: DataFrame,
    *,
    model: str | Sequence[str],
    target: str,
    probability: str,
    threshold: float = 0.50,
) -> DataFrame:
    """One record per model, best average precision first, then AUROC."""
    by = [model] if isinstance(model, str) else list(model)
    return classification_metrics(
        long_scores, target=target, probability=probability, threshold=threshold, by=by
    ).orderBy(F.col("auprc").desc(), F.col("auroc").desc(), *by)


def compare_calibrations(
    long_scores: DataFrame, *, method: str, target: str, probability: str
) -> DataFrame:
    """One row per method, lowest Brier score first, then log loss."""
    return probability_metrics(
        long_scores,
        target=target,
        probability=probability,
        by=[method],
        clip_before_ranking=True,
    ).orderBy("brier_score", "log_loss", method)


def final_record(
    long_scores: DataFrame,
    *,
    by: Sequence[str],
    target: str,
    probability: str,
    threshold: float = 0.50,
) -> DataFrame:
    """Probability and classification fields side by side, per group."""
    quality = quality_metrics(
        long_scores, target=target, probability=probability, by=by
    )
    records = threshold_sweep(
        long_scores,
        target=target,
        probability=probability,
        thresholds=[threshold],
        by=by,
    )
    return _attach(records, quality, by)


# --- picking a row -----------------------------------------------------------------


def best_by(table: DataFrame, *order: Column) -> DataFrame:
    """First row in the given order (a top-1, not a full sort)."""
    return table.orderBy(*order).limit(1)


def best_f1(sweep: DataFrame) -> DataFrame:
    return best_by(
        sweep,
        F.col("f1_score").desc(),
        F.col("recall_sensitivity").desc(),
        F.col("specificity").desc_nulls_last(),
        F.col("threshold").asc(),
    )


def high_sensitivity(sweep: DataFrame, *, minimum_recall: float = 0.80) -> DataFrame:
    return best_by(
        sweep.where(F.col("recall_sensitivity") >= F.lit(float(minimum_recall))),
        F.col("specificity").desc_nulls_last(),
        F.col("precision_ppv").desc(),
        F.col("threshold").asc(),
    )


def select_model(comparison: DataFrame, *, name: str = "model") -> DataFrame:
    return best_by(
        comparison,
        F.col("auprc").desc_nulls_last(),
        F.col("auroc").desc_nulls_last(),
        F.col(name).asc(),
    )


def select_calibration(comparison: DataFrame, *, name: str = "method") -> DataFrame:
    return best_by(
        comparison, F.col("brier_score").asc(), F.col("log_loss").asc(), F.col(name).asc()
    )


def operational_thresholds(sweep: DataFrame) -> DataFrame:
    return sweep.select(
        "threshold",
        "recall_sensitivity",
        "specificity",
        "precision_ppv",
        "negative_predictive_value",
        "f1_score",
        "patients_flagged",
        "flagged_percentage",
        "false_positives",
        "false_negatives",
        "true_positives",
        "true_negatives",
        operating_point_label(F.col("threshold")).alias("interpretation"),
        use_case_label(F.col("threshold")).alias("use_case_interpretation"),
    )


# --- calibration and score shape ------------------------------------------------------


def calibration_bins(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    n_bins: int = 10,
    strategy: str = "quantile",
) -> DataFrame:
    """(bin, n, mean_predicted, observed_rate); empty bins do not appear.

    A row's bin is the number of inner edges strictly below its score; edges are
    exact percentiles or equal steps on [0, 1].
    """
    inner = [i / n_bins for i in range(1, n_bins)]
    p = F.col(probability).cast("double")
    if strategy == "uniform":
        edges = F.array(*[F.lit(e) for e in inner])
    elif strategy == "quantile":
        edges = (
            exact_quantiles(df, [probability], inner)
            .agg(F.sort_array(F.collect_list("value")))
            .scalar()
        )
    else:
        raise ValueError("strategy must be 'quantile' or 'uniform'")
    below = F.size(F.filter(F.col("_edges"), lambda e: e < F.col("_p")))
    return (
        df.select(F.col(target).alias("_y"), p.alias("_p"), edges.alias("_edges"))
        .withColumn("bin", below.cast("int"))
        .groupBy("bin")
        .agg(
            F.count("*").alias("n"),
            F.avg("_p").alias("mean_predicted"),
            F.avg(F.col("_y").cast("double")).alias("observed_rate"),
        )
    )


def score_histogram(
    df: DataFrame, *, target: str, probability: str, bins: int = 15
) -> DataFrame:
    """(outcome, bin 1..bins, n): equal-width bins over each outcome's own range."""
    p = F.col(probability).cast("double")
    ranges = df.groupBy(target).agg(F.min(p).alias("_low"), F.max(p).alias("_high"))
    # a binary target has at most three values, so the broadcast is bounded
    placed = join_small(
        df.select(target, p.alias("_p")), ranges, [target], bounded=True
    )
    step = (F.col("_high") - F.col("_low")) / bins
    cell = F.when(F.col("_high") == F.col("_low"), F.lit(bins // 2 + 1)).otherwise(
        F.least(F.floor((F.col("_p") - F.col("_low")) / step) + 1, F.lit(bins))
    )
    return (
        placed.withColumn("bin", cell.cast("int"))
        .groupBy(F.col(target).alias("outcome"), "bin")
        .agg(F.count("*").alias("n"))
    )


# --- errors ------------------------------------------------------------------------


def error_categories(
    df: DataFrame, *, target: str, probability: str, threshold: float = 0.50
) -> DataFrame:
    """Adds predicted_label and prediction_category."""
    labelled = df.withColumn(
        "predicted_label", hard_label(F.col(probability), threshold)
    )
    return labelled.withColumn(
        "prediction_category",
        outcome_category(F.col(target), F.col("predicted_label")),
    )


def error_category_summary(
    df: DataFrame, *, probability: str, category: str = "prediction_category"
) -> DataFrame:
    """Count and mean / exact median / range of the score per category."""
    medians = exact_quantiles(df, [probability], [0.5], by=[category]).select(
        category, F.col("value").alias("median_predicted_probability")
    )
    summary = df.groupBy(category).agg(
        F.count("*").alias("patients"),
        F.avg(probability).alias("mean_predicted_probability"),
        F.min(probability).alias("minimum_predicted_probability"),
        F.max(probability).alias("maximum_predicted_probability"),
    )
    return join_small(summary, medians, [category], how="left")


def error_feature_summary(
    df: DataFrame, *, features: Sequence[str], category: str = "prediction_category"
) -> DataFrame:
    """(category, feature, count, mean, median) of several numeric columns."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
            for c in features
        ]
    )
    base = (
        df.select(category, F.explode(cells).alias("_c"))
        .select(category, "_c.*")
        .groupBy(category, "feature")
        .agg(F.count("v").alias("n"), F.avg("v").alias("mean"))
    )
    medians = exact_quantiles(df, list(features), [0.5], by=[category]).select(
        category, "feature", F.col("value").alias("median")
    )
    return join_small(base, medians, [category, "feature"], how="left")


def representative_cases(
    df: DataFrame,
    *,
    probability: str,
    row_id: str,
    category: str = "prediction_category",
) -> DataFrame:
    """One case per category: highest score for positives, lowest for negatives."""
    lowest_first = F.col(category).isin("false_negative", "true_negative")
    signed = F.when(lowest_first, F.col(probability)).otherwise(-F.col(probability))
    place = F.row_number().over(
        Window.partitionBy(category).orderBy(signed.asc(), F.col(row_id).asc())
    )
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def with_context(
    cases: DataFrame, context: DataFrame, *, key: str, columns: Sequence[str]
) -> DataFrame:
    """Left-join those context columns that exist; absent names are skipped."""
    present = [c for c in columns if c in context.columns and c != key]
    return cases.join(context.select(key, *present), key, "left")


def final_predictions(
    df: DataFrame,
    *,
    ids: Sequence[str],
    target: str,
    uncalibrated: str,
    final: str,
    threshold: float = 0.50,
) -> DataFrame:
    label = hard_label(F.col(final), threshold)
    return df.select(
        *ids,
        target,
        F.col(uncalibrated).alias("uncalibrated_probability"),
        F.col(final).alias("final_probability"),
        label.alias("final_prediction_0_50"),
        (label == F.col(target)).cast("int").alias("prediction_correct_at_0_50"),
    )
