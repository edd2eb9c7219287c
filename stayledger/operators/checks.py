"""Validation: tables of violations, and strict forms that raise ``ValueError``.

Violation tables are lazy and distributed.  Strict forms run one small aggregate
and bring back a single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stayledger.config import ROLES


def require_columns(
    df: DataFrame, columns: Sequence[str], *, name: str = "dataframe"
) -> None:
    """Raise when columns are absent; reads the schema only."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{name} is missing required columns: {absent}")


def require_features(
    df: DataFrame, columns: Sequence[str], *, name: str = "dataframe"
) -> None:
    require_columns(df, columns, name=name)


# --- violation tables ---------------------------------------------------------------------


def _as_rows(row: DataFrame, name: str = "rule", value: str = "violations") -> DataFrame:
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias(name), F.col(c).cast("bigint").alias(value)
                    )
                    for c in row.columns
                ]
            )
        )
    )


def target_violations(df: DataFrame, *, target: str = ROLES.target) -> DataFrame:
    """(target value, n) of every value that is NULL or not 0/1."""
    return (
        df.where(F.col(target).isNull() | ~F.col(target).isin(0, 1))
        .groupBy(F.col(target).alias("bad_value"))
        .agg(F.count("*").alias("n"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n) of keys that are NULL or occur more than once."""
    gone = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .where((F.col("n") > 1) | gone)
    )


def cohort_violations(
    df: DataFrame,
    *,
    target: str = ROLES.target,
    ids: Sequence[str] = ROLES.ids,
    unique: str = ROLES.stay,
) -> DataFrame:
    """(rule, violations): missing ids, repeated key rows, bad targets; one scan."""
    require_columns(df, [*ids, target], name="cohort")
    bad = F.col(target).isNotNull() & ~F.col(target).isin(0, 1)
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in ids],
        (F.count(unique) - F.count_distinct(F.col(unique))).alias(f"{unique}_repeated"),
        F.count_if(F.col(target).isNull()).alias(f"{target}_missing"),
        F.count_if(bad).alias(f"{target}_not_binary"),
    )
    return _as_rows(row)


def split_leakage(assigned: DataFrame, *, entity: str, split: str = "split") -> DataFrame:
    """(split pair, n): entities found in both splits of each pair."""
    seen = assigned.groupBy(entity).agg(
        *[
            F.max(F.when(F.col(split) == s, 1).otherwise(0)).alias(s)
            for s in ("train", "validation", "test")
        ]
    )
    pairs = (("train", "validation"), ("train", "test"), ("validation", "test"))
    row = seen.agg(
        *[
            F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}-{b}")
            for a, b in pairs
        ]
    )
    return _as_rows(row, "split_pair", "shared_entities")


def probability_violations(df: DataFrame, *, probability: str) -> DataFrame:
    """(rule, violations): missing, not finite, outside [0, 1]."""
    p = F.col(probability).cast("double")
    finite = ~F.isnan(p) & (F.abs(p) < float("inf"))
    row = df.agg(
        F.count_if(p.isNull()).alias("missing"),
        F.count_if(p.isNotNull() & ~finite).alias("not_finite"),
        F.count_if(finite & ((p < 0) | (p > 1))).alias("outside_unit_interval"),
    )
    return _as_rows(row)


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) of any set of row predicates; NULL is not a violation."""
    row = df.agg(
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]
    )
    return _as_rows(row)


def temporal_violations(
    df: DataFrame,
    *,
    start: str = ROLES.start,
    end: str = ROLES.end,
    admitted: str = "admittime",
    discharged: str = "dischtime",
) -> DataFrame:
    """Counts of the four impossible time orders; missing times never count."""
    return rule_counts(
        df,
        {
            "icu_out_before_icu_in": F.col(end) < F.col(start),
            "hospital_discharge_before_admission": F.col(discharged) < F.col(admitted),
            "icu_in_before_hospital_admission": F.col(start) < F.col(admitted),
            "icu_in_after_hospital_discharge": F.col(start) > F.col(discharged),
        },
    )


def window_validation(
    df: DataFrame, *, start: str = ROLES.start, cutoff: str = ROLES.cutoff
) -> DataFrame:
    """Rows, windows that do not move forward, shortest and longest in seconds."""
    length = F.timestamp_diff("SECOND", F.col(start), F.col(cutoff))
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(cutoff) <= F.col(start)).alias("invalid_windows"),
        F.min(length).alias("minimum_window_seconds"),
        F.max(length).alias("maximum_window_seconds"),
    )


def join_integrity(base: DataFrame, joined: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Rows before and after a join, and repeated values of each key after it."""
    after = joined.agg(
        F.count("*").alias("rows_after"),
        *[
            (F.count(k) - F.count_distinct(F.col(k))).alias(f"{k}_repeated")
            for k in keys
        ],
    )
    before = base.agg(F.count("*").alias("rows_before"))
    return after.select(
        before.scalar().alias("rows_before"), *[F.col(c) for c in after.columns]
    )


# --- strict forms --------------------------------------------------------------------------


def _raise_on(table: DataFrame, what: str) -> None:
    found = {r[0]: r[1] for r in table.where(F.col(table.columns[1]) > 0).collect()}
    if found:
        raise ValueError(f"{what}: {found}")


def validate_binary_target(
    df: DataFrame, *, target: str = ROLES.target, name: str = "dataframe"
) -> None:
    require_columns(df, [target], name=name)
    found = target_violations(df, target=target)
    value = F.col(found.columns[0])
    missing, bad, least, most = found.agg(
        F.count_if(value.isNull()), F.count(value), F.min(value), F.max(value)
    ).first()
    if missing:
        raise ValueError(f"{name}.{target} contains missing values")
    if bad:
        raise ValueError(
            f"{name}.{target} contains non-binary values: {bad} different, from {least} to {most}"
        )


def validate_unique(df: DataFrame, key: str = ROLES.stay, *, name: str = "dataframe") -> None:
    require_columns(df, [key], name=name)
    worst = duplicate_keys(df, [key]).take(1)
    if worst and worst[0][key] is None:
        raise ValueError(f"{name}.{key} contains missing values")
    if worst:
        raise ValueError(f"{name}.{key} is not unique")


def validate_cohort(
    df: DataFrame,
    *,
    target: str = ROLES.target,
    ids: Sequence[str] = ROLES.ids,
    unique: str = ROLES.stay,
    name: str = "cohort",
) -> None:
    _raise_on(
        cohort_violations(df, target=target, ids=ids, unique=unique),
        f"{name} is not a valid cohort",
    )


def validate_patient_split(
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    *,
    entity: str = ROLES.patient,
) -> None:
    parts = {"train": train, "validation": validation, "test": test}
    for name, df in parts.items():
        require_columns(df, [entity], name=name)
    assigned = reduce(
        DataFrame.unionByName,
        [df.select(entity, F.lit(n).alias("split")) for n, df in parts.items()],
    )
    _raise_on(split_leakage(assigned, entity=entity), "patient leakage detected")


def validate_split_totals(
    assigned: DataFrame, original: DataFrame, *, entity: str = ROLES.patient
) -> None:
    """Every original row is in exactly one split and the entity sets agree."""
    left = assigned.agg(F.count("*"), F.count_distinct(F.col(entity))).first()
    right = original.agg(F.count("*"), F.count_distinct(F.col(entity))).first()
    if tuple(left) != tuple(right):
        raise ValueError(
            f"split rows/entities {tuple(left)} differ from the original {tuple(right)}"
        )


def validate_probabilities(
    df: DataFrame, *, probability: str, name: str = "probabilities"
) -> None:
    _raise_on(
        probability_violations(df, probability=probability),
        f"{name} must be finite and lie in [0, 1]",
    )


def validate_window_start(df: DataFrame, *, start: str = ROLES.start) -> None:
    """Raise when a selected stay has no start: its window cannot be defined."""
    if df.where(F.col(start).isNull()).take(1):
        raise ValueError(f"selected stays contain missing {start} values")


def validate_temporal(df: DataFrame, **roles: str) -> None:
    _raise_on(temporal_violations(df, **roles), "impossible time order")
