"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from stayledger.config import PROBABILITY_FLOOR, LabelRule

# --- time -----------------------------------------------------------------------


def plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def admission_hour(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def is_weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday (Spark numbers the week Sunday=1 .. Saturday=7)."""
    return F.when(F.dayofweek(ts).isin(1, 7), 1).otherwise(0)


# --- text -----------------------------------------------------------------------


def contains_flag(text: Column, fragment: str) -> Column:
    """1 when the text contains the fragment, ignoring case; NULL counts as ''."""
    return F.when(
        F.upper(F.coalesce(text, F.lit(""))).contains(fragment.upper()), 1
    ).otherwise(0)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _rule_matches(label: Column, rule: LabelRule) -> Column:
    tests = []
    if rule.exact:
        tests.append(label.isin(*rule.exact))
    tests += [label.contains(part) for part in rule.contains]
    tests += [label.startswith(part) for part in rule.prefix]
    return _any(tests)


def first_matching_rule(label: Column, rules: Sequence[LabelRule]) -> Column:
    """Standard name of the first rule the label satisfies, else NULL."""
    lowered = F.lower(label)
    head, *tail = rules
    chain = F.when(_rule_matches(lowered, head), head.name)
    for rule in tail:
        chain = chain.when(_rule_matches(lowered, rule), rule.name)
    return chain


def snake_name(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), " ", "_")


# --- values ---------------------------------------------------------------------


def is_missing(column: Column, dtype: T.DataType) -> Column:
    """NULL, and NaN for floating columns (files from pandas may carry NaN)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def fahrenheit_to_celsius(value: Column) -> Column:
    return (value - 32.0) * 5.0 / 9.0


def plausible(
    name: Column, value: Column, bounds: Mapping[str, tuple[float, float]]
) -> Column:
    """The value when it lies within its measurement's inclusive bounds."""
    inside = _any(
        [
            (name == key) & value.between(float(low), float(high))
            for key, (low, high) in bounds.items()
        ]
    )
    return F.when(inside, value)


def clip_probability(p: Column, floor: float = PROBABILITY_FLOOR) -> Column:
    return F.least(F.greatest(p, F.lit(floor)), F.lit(1.0 - floor))


def ratio_or_null(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio_or_null(top, bottom), F.lit(0.0))


# --- labels and bands -------------------------------------------------------------


def survival_label(target: Column) -> Column:
    return F.when(target == 0, "Survived").when(target == 1, "Died")


def hard_label(p: Column, threshold: float) -> Column:
    return (p >= F.lit(float(threshold))).cast("int")


def outcome_category(target: Column, predicted: Column) -> Column:
    return (
        F.when((target == 1) & (predicted == 1), "true_positive")
        .when((target == 0) & (predicted == 1), "false_positive")
        .when((target == 1) & (predicted == 0), "false_negative")
        .when((target == 0) & (predicted == 0), "true_negative")
        .otherwise("unknown")
    )


def age_band(
    age: Column,
    upper: Sequence[float] = (49, 69),
    labels: Sequence[str] = ("18-49", "50-69", "70+"),
) -> Column:
    """Right-closed bands; a NULL age stays NULL."""
    chain = F.when(age <= upper[0], labels[0])
    for edge, label in zip(upper[1:], labels[1:-1]):
        chain = chain.when(age <= edge, label)
    return chain.when(age.isNotNull(), labels[-1])


def operating_point_label(threshold: Column) -> Column:
    return (
        F.when(threshold <= 0.20, "High-sensitivity / high-alert operating point")
        .when(threshold <= 0.40, "Intermediate operating point")
        .otherwise("Lower-alert / higher-miss operating point")
    )


def use_case_label(threshold: Column) -> Column:
    return (
        F.when(threshold <= 0.20, "Higher-sensitivity screening")
        .when(threshold <= 0.40, "Balanced exploratory threshold")
        .otherwise("Lower-alert threshold")
    )


def interpretation_note(small: Column, few: Column) -> Column:
    return F.when(
        small | few, "Exploratory only: small sample or few events."
    ).otherwise("Interpret with caution.")


# --- hashing ----------------------------------------------------------------------


def knuth_hash(key: Column) -> Column:
    """Multiplicative hash of an integer key into [0, 2**32).

    Plain arithmetic, so any SQL engine reproduces it; the key is folded to 31
    bits first so the product stays inside a signed 64-bit integer.
    """
    folded = F.pmod(key.cast("bigint"), F.lit(2147483648))
    return F.pmod(folded * F.lit(2654435761), F.lit(4294967296))
