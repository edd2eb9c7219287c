"""Cohort selection: first stay per admission, joins, inclusion, window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayledger.config import (
    BASE_COHORT_COLUMNS,
    LEAKAGE_COLUMNS,
    MINIMUM_AGE,
    PREDICTION_HOURS,
    ROLES,
)
from stayledger.functions import plus_hours
from stayledger.operators.checks import require_columns, validate_unique
from stayledger.operators.scale import spread_join


def first_child(
    df: DataFrame, *, parent: str | Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """First row per parent in the given order.

    ``row_number() = 1`` is planned with a per-task pre-limit before the shuffle,
    so a parent with very many rows sends one row per input task.
    """
    keys = [parent] if isinstance(parent, str) else list(parent)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def first_stay(
    stays: DataFrame,
    *,
    admission: str = ROLES.admission,
    start: str = ROLES.start,
    tie: Sequence[str] = (ROLES.stay,),
) -> DataFrame:
    """Earliest stay per admission: total order, unknown start times last."""
    return first_child(
        stays,
        parent=admission,
        order=[F.col(start).asc_nulls_last(), *[F.col(c).asc() for c in tie]],
    )


def join_one_to_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], *, checked: bool = False
) -> DataFrame:
    """Inner join whose keys must be unique on both sides.

    ``checked`` skips the uniqueness jobs when the caller has run them.
    Columns present on both sides beyond the keys get _icu / _admission suffixes.
    """
    if not checked:
        for name, side in (("left", left), ("right", right)):
            _require_unique(side, keys, name)
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    left = left.withColumnsRenamed({c: f"{c}_icu" for c in shared})
    right = right.withColumnsRenamed({c: f"{c}_admission" for c in shared})
    return left.join(right, list(keys), "inner")


def join_many_to_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], *, checked: bool = False
) -> DataFrame:
    """Left join whose keys must be unique on the right; hot left keys are salted."""
    if not checked:
        _require_unique(right, keys, "right")
    return spread_join(left, right, keys, how="left")


def _require_unique(df: DataFrame, keys: Sequence[str], side: str) -> None:
    if len(keys) == 1:
        validate_unique(df, keys[0], name=side)
        return
    repeated = df.groupBy(*keys).count().where(F.col("count") > 1).take(1)
    if repeated:
        raise ValueError(f"{side} keys {list(keys)} are not unique")


def inclusion_mask(
    *,
    required: Sequence[str] = (*ROLES.ids, ROLES.start, ROLES.target),
    age: str = "anchor_age",
    minimum_age: float = MINIMUM_AGE,
) -> Column:
    """Complete keys, known start and outcome, and old enough."""
    mask = F.col(age) >= minimum_age
    for name in required:
        mask = mask & F.col(name).isNotNull()
    return mask


def with_prediction_time(
    df: DataFrame,
    *,
    start: str = ROLES.start,
    cutoff: str = ROLES.cutoff,
    hours: int = PREDICTION_HOURS,
) -> DataFrame:
    return df.withColumn(cutoff, plus_hours(F.col(start), hours))


def base_cohort(df: DataFrame, columns: Sequence[str] = BASE_COHORT_COLUMNS) -> DataFrame:
    require_columns(df, columns, name="cohort")
    return df.select(*columns)


def predictor_columns(
    df: DataFrame, *, also_exclude: Sequence[str] = (), deny: Sequence[str] = LEAKAGE_COLUMNS
) -> DataFrame:
    """Drop ids, target, times and after-outcome columns; absent names are fine."""
    banned = {*deny, *also_exclude}
    return df.select(*[c for c in df.columns if c not in banned])


def build_cohort(
    patients: DataFrame,
    admissions: DataFrame,
    stays: DataFrame,
    *,
    hours: int = PREDICTION_HOURS,
    minimum_age: float = MINIMUM_AGE,
    checked: bool = False,
) -> DataFrame:
    """First stay -> admission -> patient -> inclusion -> prediction window."""
    first = first_stay(stays)
    with_admission = join_one_to_one(
        first, admissions, [ROLES.patient, ROLES.admission], checked=checked
    )
    with_patient = join_many_to_one(
        with_admission, patients, [ROLES.patient], checked=checked
    )
    kept = with_patient.where(inclusion_mask(minimum_age=minimum_age))
    return with_prediction_time(kept, hours=hours)
