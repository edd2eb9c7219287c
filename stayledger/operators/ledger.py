"""Score ledger: positives and negatives per distinct score, with running totals.

Grouping by score first collapses ties map-side, so a score shared by a third of
all rows is one ledger row.  Running totals in descending score order follow from
range buckets (see ``scale``); AUROC, average precision and both curves are plain
aggregates or projections of the ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stayledger.functions import ratio_or_null
from stayledger.operators.scale import (
    cut_points,
    join_small,
    running_totals,
    with_buckets,
)


def _without_nulls(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Group keys as text that is never NULL ('' for NULL, '=x' for x).

    Plain equality on such keys lets the offset join keep the window's
    partitioning; an equality that also matches NULLs would move the ledger again.
    """
    keys = {
        c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
        for c in by
        if df.schema[c].nullable
    }
    return df.withColumns(keys) if keys else df


def _with_nulls(df: DataFrame, by: Sequence[str], like: DataFrame) -> DataFrame:
    decoded = {
        c: F.when(F.col(c) != "", F.substring(F.col(c), 2, 2**31 - 1)).cast(
            like.schema[c].dataType
        )
        for c in by
        if like.schema[c].nullable
    }
    return df.withColumns(decoded) if decoded else df


def score_ledger(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """(by..., score, n_pos, n_neg, cum_tp, cum_fp), cumulated from the top score."""
    scored = df.select(
        *by, F.col(probability).cast("double").alias("score"), F.col(target).alias("_y")
    )
    edges = cut_points(scored, ["score"], buckets=buckets)
    group = [*by, "_all"]
    ledger = (
        with_buckets(_without_nulls(scored, by), edges)
        .withColumn("_all", F.lit(0))
        .groupBy(*group, "score_bucket", "score")
        .agg(
            F.count_if(F.col("_y") == 1).alias("n_pos"),
            F.count_if(F.col("_y") == 0).alias("n_neg"),
        )
    )
    running = running_totals(
        ledger,
        by=group,
        buckets=["score_bucket"],
        order=[F.col("score").desc()],
        bucket_order=[F.col("score_bucket").desc()],
        sums={"cum_tp": "n_pos", "cum_fp": "n_neg"},
    ).drop("_all", "score_bucket")
    return _with_nulls(running, by, scored)


def area_metrics(
    df: DataFrame,
    *,
    target: str,
    probability: str,
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """(by..., auroc, auprc): exact, tie-aware, NULL where undefined.

    AUROC needs both classes; average precision (the step-wise sum of precision
    over recall gains, not a trapezoid) needs at least one positive.
    """
    ledger = score_ledger(
        df, target=target, probability=probability, by=by, buckets=buckets
    )
    pos, neg = F.sum("n_pos"), F.sum("n_neg")
    # share of pairs ordered wrongly: negatives at or above each positive, ties by half
    wrong = F.sum(F.col("n_pos") * (F.col("cum_fp") - 0.5 * F.col("n_neg")))
    steps = F.sum(
        # doubles: counts of a very large table overflow when multiplied as integers
        F.col("n_pos").cast("double") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    )
    return ledger.groupBy(*by).agg(
        (F.lit(1.0) - ratio_or_null(wrong, pos.cast("double") * neg)).alias("auroc"),
        ratio_or_null(steps, pos).alias("auprc"),
    )


def _with_totals(ledger: DataFrame) -> DataFrame:
    """Class totals are the last running totals: one row, attached to all."""
    totals = ledger.agg(
        F.max("cum_tp").alias("total_pos"), F.max("cum_fp").alias("total_neg")
    ).withColumn("_all", F.lit(0))
    return join_small(
        ledger.withColumn("_all", F.lit(0)), totals, ["_all"], bounded=True
    ).drop("_all")


def roc_points(df: DataFrame, *, target: str, probability: str) -> DataFrame:
    """(score, fpr, tpr) at every distinct score used as a threshold."""
    ledger = _with_totals(score_ledger(df, target=target, probability=probability))
    return ledger.select(
        F.col("score").alias("threshold"),
        ratio_or_null(F.col("cum_fp"), F.col("total_neg")).alias("fpr"),
        ratio_or_null(F.col("cum_tp"), F.col("total_pos")).alias("tpr"),
    )


def pr_points(df: DataFrame, *, target: str, probability: str) -> DataFrame:
    """(threshold, recall, precision) at every distinct score."""
    ledger = _with_totals(score_ledger(df, target=target, probability=probability))
    return ledger.select(
        F.col("score").alias("threshold"),
        ratio_or_null(F.col("cum_tp"), F.col("total_pos")).alias("recall"),
        ratio_or_null(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")).alias(
            "precision"
        ),
    )
