"""Column expressions: no jobs, no shuffles, all built-in functions."""

from stayledger.functions.scalars import (
    admission_hour,
    age_band,
    clip_probability,
    contains_flag,
    fahrenheit_to_celsius,
    first_matching_rule,
    hard_label,
    interpretation_note,
    is_missing,
    is_weekend,
    knuth_hash,
    operating_point_label,
    outcome_category,
    plausible,
    plus_hours,
    ratio_or_null,
    ratio_or_zero,
    snake_name,
    survival_label,
    use_case_label,
)

__all__ = [
    "admission_hour",
    "age_band",
    "clip_probability",
    "contains_flag",
    "fahrenheit_to_celsius",
    "first_matching_rule",
    "hard_label",
    "interpretation_note",
    "is_missing",
    "is_weekend",
    "knuth_hash",
    "operating_point_label",
    "outcome_category",
    "plausible",
    "plus_hours",
    "ratio_or_null",
    "ratio_or_zero",
    "snake_name",
    "survival_label",
    "use_case_label",
]
