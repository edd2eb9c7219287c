"""Wide features per stay from long events, and the modelling table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayledger.config import (
    LAB_RULES,
    LAB_STATS,
    PLAUSIBLE_BOUNDS,
    ROLES,
    TEMPERATURE_UNITS,
    VITAL_RULES,
    VITAL_STATS,
    LabelRule,
)
from stayledger.functions import admission_hour, contains_flag, is_weekend
from stayledger.operators.events import (
    events_in_window,
    mapped_dictionary,
    standardize,
    within_bounds,
)
from stayledger.operators.scale import fits_broadcast
from stayledger.session import stable


def item_window_stats(
    cohort: DataFrame,
    events: DataFrame,
    *,
    item_value: int,
    prefix: str,
    key: str = ROLES.stay,
    entity: str = ROLES.stay,
    item: str = "itemid",
    value: str = "valuenum",
    time: str = "charttime",
    start: str = ROLES.start,
    cutoff: str = ROLES.cutoff,
) -> DataFrame:
    """min / max / mean of one item code per stay inside its window."""
    chosen = events.where(F.col(item) == item_value)
    inside = events_in_window(
        cohort, chosen, key=key, start=start, cutoff=cutoff, time=time, carry=[entity]
    )
    return inside.groupBy(entity).agg(
        F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
        F.avg(value).alias(f"{prefix}_mean"),
    )


def _stat(kind: str, value: Column, time: Column) -> Column:
    if kind == "min":
        return F.min(value)
    if kind == "max":
        return F.max(value)
    if kind == "mean":
        return F.avg(value)
    if kind == "first":
        # earliest reading; equal times resolve to the smallest value
        return F.min(F.struct(time, value))
    raise ValueError(f"unknown statistic {kind!r}")


def wide_features(
    events: DataFrame,
    *,
    entity: str,
    names: Sequence[str],
    stats: Sequence[str],
    name: str = "name",
    value: str = "value",
    time: str = "charttime",
) -> DataFrame:
    """One row per entity with ``<name>_<stat>`` columns.

    Two aggregations: per (entity, name) over the events, partial on the map
    side, then a small one that lays the names side by side.  An entity whose
    values are all NULL does not appear.
    """
    per_name = (
        events.where(F.col(value).isNotNull())
        .groupBy(entity, name)
        .agg(*[_stat(s, F.col(value), F.col(time)).alias(f"_{s}") for s in stats])
    )
    readable = {s: f"_{s}.`{value}`" if s == "first" else f"_{s}" for s in stats}
    return per_name.groupBy(entity).agg(
        *[
            F.expr(f"max({readable[s]}) FILTER (WHERE `{name}` = '{n}') AS `{n}_{s}`")
            for n in names
            for s in stats
        ]
    )


def admission_features(
    cohort: DataFrame,
    *,
    start: str = ROLES.start,
    admission_type: str = "admission_type",
    location: str = "admission_location",
    emergency_fragment: str = "EMER",
    transfer_fragment: str = "TRANSFER",
) -> DataFrame:
    """Adds hour, weekend, emergency and transfer columns known at admission."""
    return cohort.withColumns(
        {
            "icu_admission_hour": admission_hour(F.col(start)),
            "weekend_admission": is_weekend(F.col(start)),
            "emergency_admission": contains_flag(
                F.col(admission_type), emergency_fragment
            ),
            "transfer_admission": contains_flag(F.col(location), transfer_fragment),
        }
    )


def rule_names(rules: Sequence[LabelRule]) -> list[str]:
    return [r.name for r in rules]


def _mapped_vitals(
    cohort: DataFrame,
    chartevents: DataFrame,
    items: DataFrame,
    rules: Sequence[LabelRule],
    bounds: Mapping[str, tuple[float, float]],
    unit: str | None,
    small: bool | None,
) -> DataFrame:
    dictionary = mapped_dictionary(
        items, rules, unit=unit, units=TEMPERATURE_UNITS, bounds=bounds
    )
    inside = events_in_window(cohort, chartevents, carry=[ROLES.stay], small=small)
    return standardize(
        inside,
        dictionary,
        name="vital_name",
        units=TEMPERATURE_UNITS,
        small=fits_broadcast(dictionary),
    )


def standardized_vitals(
    cohort: DataFrame,
    chartevents: DataFrame,
    items: DataFrame,
    *,
    rules: Sequence[LabelRule] = VITAL_RULES,
    unit: str | None = "unitname",
    small: bool | None = None,
) -> DataFrame:
    """(stay, charttime, vital_name, standardized_value) inside the window."""
    return _mapped_vitals(
        cohort, chartevents, items, rules, PLAUSIBLE_BOUNDS, unit, small
    ).select(ROLES.stay, "charttime", "vital_name", "standardized_value")


def cleaned_vitals(
    cohort: DataFrame,
    chartevents: DataFrame,
    items: DataFrame,
    *,
    rules: Sequence[LabelRule] = VITAL_RULES,
    bounds: Mapping[str, tuple[float, float]] = PLAUSIBLE_BOUNDS,
    unit: str | None = "unitname",
    small: bool | None = None,
) -> DataFrame:
    """The same with implausible values as NULL; rows are kept."""
    mapped = _mapped_vitals(cohort, chartevents, items, rules, bounds, unit, small)
    return within_bounds(mapped).select(ROLES.stay, "charttime", "vital_name", "value")


def standardized_labs(
    cohort: DataFrame,
    labevents: DataFrame,
    items: DataFrame,
    *,
    rules: Sequence[LabelRule] = LAB_RULES,
    small: bool | None = None,
) -> DataFrame:
    """(stay, charttime, lab_name, value): joined by admission, windowed by stay."""
    dictionary = mapped_dictionary(items, rules)
    inside = events_in_window(
        cohort, labevents, key=ROLES.admission, carry=[ROLES.stay], small=small
    )
    return standardize(
        inside,
        dictionary,
        name="lab_name",
        out="value",
        small=fits_broadcast(dictionary),
    ).select(
        ROLES.stay, "charttime", "lab_name", "value"
    )


def vital_features(cleaned: DataFrame, rules: Sequence[LabelRule] = VITAL_RULES) -> DataFrame:
    return wide_features(
        cleaned,
        entity=ROLES.stay,
        names=rule_names(rules),
        stats=VITAL_STATS,
        name="vital_name",
    )


def lab_features(labs: DataFrame, rules: Sequence[LabelRule] = LAB_RULES) -> DataFrame:
    return wide_features(
        labs,
        entity=ROLES.stay,
        names=rule_names(rules),
        stats=LAB_STATS,
        name="lab_name",
    )


def modeling_table(
    base: DataFrame, *feature_tables: DataFrame, key: str = ROLES.stay
) -> DataFrame:
    """Left-join feature tables to the base; every base row stays.

    The feature tables are already partitioned by ``key``, so each join reuses
    that partitioning.
    """
    table = base
    for features in feature_tables:
        table = table.join(features, key, "left")
    return table


def build_modeling_cohort(
    cohort: DataFrame,
    chartevents: DataFrame,
    d_items: DataFrame,
    labevents: DataFrame,
    d_labitems: DataFrame,
    **admission_options: str,
) -> DataFrame:
    """Base cohort -> admission features -> vitals -> labs -> one wide table.

    The cohort feeds three joins, so it is written once and measured; the event
    tables are then read once each, and only moved when the cohort is too large
    to send to them.
    """
    cohort = stable(cohort)
    small = fits_broadcast(cohort.select(*ROLES.ids, ROLES.start, ROLES.cutoff))
    vitals = vital_features(cleaned_vitals(cohort, chartevents, d_items, small=small))
    labs = lab_features(standardized_labs(cohort, labevents, d_labitems, small=small))
    return modeling_table(
        admission_features(cohort, **admission_options), vitals, labs
    )
