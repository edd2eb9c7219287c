"""Sigmoid and isotonic calibration of a fitted model's scores.

Both fits first collapse rows to one per distinct score, so their input shrinks
with ties and a hot score is a single weighted row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from stayledger.session import stable

NEWTON_STEPS = 100

@dataclass(frozen=True)
class SigmoidCalibrator:
    """p = 1 / (1 + exp(-(slope * score + intercept)))."""

    slope: float
    intercept: float

    def column(self, score: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(score * F.lit(self.slope) + F.lit(self.intercept))))

    def apply(self, df: DataFrame, *, score: str, out: str) -> DataFrame:
        return df.withColumn(out, self.column(F.col(score)))


@dataclass(frozen=True)
class IsotonicCalibrator:
    """Non-decreasing step fit; linear between knots, flat outside them."""

    model: IsotonicRegressionModel

    def apply(self, df: DataFrame, *, score: str, out: str) -> DataFrame:
        scored = df.withColumn("_iso_in", F.col(score).cast("double"))
        return (
            self.model.transform(scored)
            .withColumnRenamed("_iso_out", out)
            .drop("_iso_in")
        )


def _by_score(df: DataFrame, score: str, target: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(target) == 1).cast("double").alias("_pos"),
        F.count_if(F.col(target) == 0).cast("double").alias("_neg"),
    )


def _newton_sums(rows: DataFrame, slope: float, intercept: float) -> tuple[float, ...]:
    """Loss, gradient and curvature of a logistic fit at one point, in one aggregate.

    ``rows`` has the score ``_s``, its weight ``_w`` and the weight of successes ``_t``.
    """
    margin = F.col("_s") * F.lit(slope) + F.lit(intercept)
    # log(1 + exp(margin)) without overflow
    soft = F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
    p = 1.0 / (1.0 + F.exp(-margin))
    gap, bend = F.col("_t") - F.col("_w") * p, F.col("_w") * p * (1.0 - p)
    row = rows.agg(
        F.sum(F.col("_w") * soft - F.col("_t") * margin),
        F.sum(gap * F.col("_s")),
        F.sum(gap),
        F.sum(bend * F.col("_s") * F.col("_s")),
        F.sum(bend * F.col("_s")),
        F.sum(bend),
    ).first()
    return tuple(row)


def fit_sigmoid(df: DataFrame, *, score: str, target: str) -> SigmoidCalibrator:
    """Platt scaling with the usual smoothed targets, by Newton steps.

    A positive counts as (P+1)/(P+2) of a success and a negative as 1/(N+2).
    Each step is one aggregate over the distinct scores; a step that does not
    lower the loss is halved.  A score that is the same everywhere has slope 0;
    without any row both are 0.
    """
    grouped = stable(_by_score(df.where(F.col(score).isNotNull()), score, target))
    n_pos, n_neg, mean = grouped.agg(
        F.sum("_pos"), F.sum("_neg"), F.sum(F.col("_s") * (F.col("_pos") + F.col("_neg")))
    ).first()
    if not (n_pos or 0.0) + (n_neg or 0.0):
        return SigmoidCalibrator(0.0, 0.0)
    high, low = (n_pos + 1.0) / (n_pos + 2.0), 1.0 / (n_neg + 2.0)
    mean /= n_pos + n_neg
    # about the mean, so that slope and intercept are nearly independent
    rows = grouped.select(
        (F.col("_s") - F.lit(mean)).alias("_s"),
        (F.col("_pos") + F.col("_neg")).alias("_w"),
        (F.col("_pos") * high + F.col("_neg") * low).alias("_t"),
    )
    successes = n_pos * high + n_neg * low
    slope, intercept = 0.0, math.log(successes / (n_pos + n_neg - successes))
    now = _newton_sums(rows, slope, intercept)
    for _ in range(NEWTON_STEPS):
        loss, g_slope, g_level, h_slope, h_cross, h_level = now
        det = h_slope * h_level - h_cross * h_cross
        if det <= 1e-14 * h_slope * h_level or not h_level:
            break
        d_slope = (h_level * g_slope - h_cross * g_level) / det
        d_level = (h_slope * g_level - h_cross * g_slope) / det
        step = 1.0
        found = _newton_sums(rows, slope + d_slope, intercept + d_level)
        while found[0] > loss + 1e-12 * abs(loss) and step > 1e-6:
            step /= 2
            found = _newton_sums(rows, slope + step * d_slope, intercept + step * d_level)
        slope, intercept, now = slope + step * d_slope, intercept + step * d_level, found
        if max(abs(d_slope) / (1 + abs(slope)), abs(d_level) / (1 + abs(intercept))) < 1e-10:
            break
    return SigmoidCalibrator(slope, intercept - slope * mean)


def fit_isotonic(df: DataFrame, *, score: str, target: str) -> IsotonicCalibrator:
    rows = _by_score(df, score, target).select(
        F.col("_s").alias("_iso_in"),
        (F.col("_pos") / (F.col("_pos") + F.col("_neg"))).alias("label"),
        (F.col("_pos") + F.col("_neg")).alias("w"),
    )
    model = IsotonicRegression(
        featuresCol="_iso_in", labelCol="label", weightCol="w", predictionCol="_iso_out"
    ).fit(rows)
    return IsotonicCalibrator(model)


def fit_calibrator(df: DataFrame, *, method: str, score: str, target: str):
    if method == "sigmoid":
        return fit_sigmoid(df, score=score, target=target)
    if method == "isotonic":
        return fit_isotonic(df, score=score, target=target)
    raise ValueError("method must be 'sigmoid' or 'isotonic'")
