"""Long event tables: dictionary search, window join, names, units, bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stayledger.config import (
    PLAUSIBLE_BOUNDS,
    ROLES,
    TEMPERATURE_UNITS,
    LabelRule,
    UnitRule,
)
from stayledger.functions import fahrenheit_to_celsius, first_matching_rule, plausible
from stayledger.operators.scale import spread_join


def search_dictionary(
    items: DataFrame, fragments: Sequence[str], *, label: str = "label"
) -> DataFrame:
    """Items whose label contains any fragment, ignoring case."""
    lowered = F.lower(F.col(label))
    hit = reduce(lambda a, b: a | b, [lowered.contains(f) for f in fragments])
    return items.where(hit)


def lookup_dictionary(
    items: DataFrame, rules: Sequence[LabelRule], *, label: str = "label"
) -> DataFrame:
    """Items that any rule would map."""
    return items.where(first_matching_rule(F.col(label), rules).isNotNull())


def mapped_dictionary(
    items: DataFrame,
    rules: Sequence[LabelRule],
    *,
    item: str = "itemid",
    label: str = "label",
    unit: str | None = None,
    units: UnitRule | None = None,
    bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """(item, name, convertible, always_convert[, low, high]) of the mapped items.

    Labels are matched and bounds looked up once per dictionary row, not once per
    event, and unmapped items are gone before the event join.
    """
    lowered = F.lower(F.col(label))
    if units is None:
        convertible = always = F.lit(False)
    else:
        convertible = lowered.contains(units.label_contains_any)
        by_label = lowered.contains(units.label_contains)
        by_unit = (
            F.lower(F.coalesce(F.col(unit), F.lit(""))).contains(units.unit_contains)
            if unit
            else F.lit(False)
        )
        always = convertible & (by_label | by_unit)
    mapped = items.select(
        F.col(item),
        first_matching_rule(F.col(label), rules).alias("name"),
        convertible.alias("convertible"),
        always.alias("always_convert"),
    ).where(F.col("name").isNotNull())
    if bounds is None:
        return mapped
    limits = mapped
    for out, side in (("low", 0), ("high", 1)):
        chain = F.when(F.lit(False), F.lit(0.0))
        for name, pair in bounds.items():
            chain = chain.when(F.col("name") == name, F.lit(float(pair[side])))
        limits = limits.withColumn(out, chain)
    return limits


def events_in_window(
    cohort: DataFrame,
    events: DataFrame,
    *,
    key: str = ROLES.stay,
    start: str = ROLES.start,
    cutoff: str = ROLES.cutoff,
    time: str = "charttime",
    carry: Sequence[str] = (ROLES.stay,),
    time_bounds: tuple[str, str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Events of cohort members inside [start, cutoff], both ends included.

    ``carry`` names cohort columns to keep beside the event columns.  A known
    outer time range in ``time_bounds`` lets the scan skip files and row groups;
    ``small`` says the cohort was measured to fit a broadcast.
    """
    if time_bounds is not None:
        low, high = (F.lit(b).cast("timestamp_ntz") for b in time_bounds)
        events = events.where(F.col(time).between(low, high))
    members = cohort.select(
        F.col(key),
        F.col(start).alias("_start"),
        F.col(cutoff).alias("_cutoff"),
        *[F.col(c) for c in carry if c != key],
    )
    inside = (F.col(f"fact.{time}") >= F.col("dimension._start")) & (
        F.col(f"fact.{time}") <= F.col("dimension._cutoff")
    )
    return spread_join(events, members, [key], condition=inside, small=small).drop(
        "_start", "_cutoff"
    )


def standardize(
    events: DataFrame,
    dictionary: DataFrame,
    *,
    item: str = "itemid",
    value: str = "valuenum",
    name: str = "name",
    out: str = "standardized_value",
    units: UnitRule | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Give each event its standard name and unit; unmapped or NULL values drop.

    A dictionary with ``low`` and ``high`` passes them on for ``within_bounds``.
    """
    threshold = (units or TEMPERATURE_UNITS).above
    joined = spread_join(
        events.where(F.col(value).isNotNull()), dictionary, [item], small=small
    )
    convert = F.col("always_convert") | (
        F.col("convertible") & (F.col(value) > F.lit(threshold))
    )
    number: Column = F.when(
        convert, fahrenheit_to_celsius(F.col(value))
    ).otherwise(F.col(value))
    return joined.withColumn(out, number).withColumnRenamed("name", name).drop(
        "convertible", "always_convert"
    )


def within_bounds(
    events: DataFrame, *, value: str = "standardized_value", out: str = "value"
) -> DataFrame:
    """Values outside the row's own ``low``..``high`` become NULL."""
    inside = F.col(value).between(F.col("low"), F.col("high"))
    return events.withColumn(out, F.when(inside, F.col(value))).drop("low", "high")


def clean(
    events: DataFrame,
    *,
    name: str = "name",
    value: str = "standardized_value",
    out: str = "value",
    bounds: Mapping[str, tuple[float, float]] = PLAUSIBLE_BOUNDS,
) -> DataFrame:
    """Values outside their measurement's bounds become NULL, by name."""
    return events.withColumn(out, plausible(F.col(name), F.col(value), bounds))
