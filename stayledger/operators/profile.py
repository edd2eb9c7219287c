"""Table profiles.  Each is one scan: wide aggregates, then turned long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stayledger.functions import is_missing, survival_label
from stayledger.operators.scale import exact_quantiles, join_small, most_frequent


def _long(row: DataFrame, cells: Sequence[tuple[str, dict[str, Column]]], name: str) -> DataFrame:
    """Turn one wide row into one row per (name, values...)."""
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias(name),
                        *[c.alias(k) for k, c in values.items()],
                    )
                    for label, values in cells
                ]
            )
        )
    )


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    types = _types(df)
    return [
        c
        for c in (columns or df.columns)
        if isinstance(types[c], (T.NumericType, T.BooleanType))
    ]


# --- shape and types ------------------------------------------------------------------


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample sd, min, quartiles and max of each numeric column."""
    names = numeric_columns(df, columns)
    row = df.agg(
        *[
            agg(F.col(c).cast("double")).alias(f"_{k}{i}")
            for i, c in enumerate(names)
            for k, agg in (
                ("n", F.count),
                ("m", F.avg),
                ("s", F.stddev_samp),
                ("lo", F.min),
                ("hi", F.max),
            )
        ]
    )
    basics = _long(
        row,
        [
            (
                c,
                {
                    "n": F.col(f"_n{i}"),
                    "mean": F.col(f"_m{i}"),
                    "sd": F.col(f"_s{i}"),
                    "minimum": F.col(f"_lo{i}"),
                    "maximum": F.col(f"_hi{i}"),
                },
            )
            for i, c in enumerate(names)
        ],
        "feature",
    )
    quartiles = (
        exact_quantiles(df, names, [0.25, 0.5, 0.75])
        .groupBy("feature")
        .agg(
            *[
                F.max(F.when(F.col("q") == q, F.col("value"))).alias(label)
                for q, label in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            ]
        )
    )
    return join_small(basics, quartiles, ["feature"], how="left", bounded=True)


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value and its count."""
    row = df.agg(
        *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)],
        *[F.count_distinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(columns)],
    )
    basics = _long(
        row,
        [
            (c, {"n": F.col(f"_n{i}"), "n_unique": F.col(f"_d{i}")})
            for i, c in enumerate(columns)
        ],
        "feature",
    )
    top = most_frequent(df, columns).select(
        "feature", F.col("value").alias("top"), F.col("n").alias("top_count")
    )
    return join_small(basics, top, ["feature"], how="left", bounded=True)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def source_summary(
    tables: Mapping[str, tuple[DataFrame, Mapping[str, str | None]]]
) -> DataFrame:
    """Rows and distinct keys per table.

    ``tables`` maps a table name to (table, {output column: key column or None}).
    """
    parts = []
    for name, (df, keys) in tables.items():
        distinct = [
            (F.count_distinct(F.col(k)) if k else F.lit(None).cast("bigint")).alias(out)
            for out, k in keys.items()
        ]
        parts.append(
            df.agg(F.count("*").alias("row_count"), *distinct).select(
                F.lit(name).alias("table_name"), "row_count", *keys
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- missing values --------------------------------------------------------------------


def missing_summary(
    df: DataFrame, columns: Sequence[str] | None = None, *, distinct: bool = False
) -> DataFrame:
    """(feature, missing_count, missing_percentage, data_type) of each column.

    Percentages are rounded to two places.  ``distinct`` adds the number of
    distinct non-missing values.
    """
    types = _types(df)
    names = list(columns or df.columns)
    sums = [F.count("*").alias("_rows")]
    for i, c in enumerate(names):
        gone = is_missing(F.col(c), types[c])
        sums.append(F.count_if(gone).alias(f"_m{i}"))
        if distinct:
            sums.append(F.count_distinct(F.when(~gone, F.col(c))).alias(f"_d{i}"))
    cells = []
    for i, c in enumerate(names):
        share = F.try_divide(F.col(f"_m{i}") * F.lit(100.0), F.col("_rows"))
        values = {
            "missing_count": F.col(f"_m{i}"),
            "missing_percentage": F.round(share, 2),
            "data_type": F.lit(types[c].simpleString()),
        }
        if distinct:
            values["unique_non_missing_values"] = F.col(f"_d{i}")
        cells.append((c, values))
    return _long(df.agg(*sums), cells, "feature")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return missing_summary(df, columns).select("feature", "missing_count")


def columns_with_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return missing_summary(df, columns).where(F.col("missing_count") > 0)


def missing_by_outcome(df: DataFrame, columns: Sequence[str], *, target: str) -> DataFrame:
    """Share missing among survivors and deaths, and their absolute difference."""
    types = _types(df)
    died, survived = F.col(target) == 1, F.col(target) == 0
    sums = [F.count_if(died).alias("_nd"), F.count_if(survived).alias("_ns")]
    for i, c in enumerate(columns):
        gone = is_missing(F.col(c), types[c])
        sums.append(F.count_if(gone & died).alias(f"_d{i}"))
        sums.append(F.count_if(gone & survived).alias(f"_s{i}"))
    cells = []
    for i, c in enumerate(columns):
        of_dead = F.round(F.try_divide(F.col(f"_d{i}") * F.lit(100.0), F.col("_nd")), 2)
        of_alive = F.round(F.try_divide(F.col(f"_s{i}") * F.lit(100.0), F.col("_ns")), 2)
        cells.append(
            (
                c,
                {
                    "survivor_missing_pct": of_alive,
                    "death_missing_pct": of_dead,
                    "absolute_difference_pct": F.round(F.abs(of_dead - of_alive), 2),
                },
            )
        )
    return _long(df.agg(*sums), cells, "feature")


def timestamp_missing(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(column_name, missing_count) of the time columns of several tables."""
    parts = [
        missing_summary(df, columns).select(
            F.concat(F.col("feature"), F.lit("_missing")).alias("column_name"),
            "missing_count",
        )
        for df, columns in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one distinct non-missing value (min equals max)."""
    row = df.agg(
        *[F.min(c).alias(f"_a{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"_b{i}") for i, c in enumerate(columns)],
    )
    cells = [
        (c, {"_same": F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}"))})
        for i, c in enumerate(columns)
    ]
    return _long(row, cells, "feature").where("_same").select("feature")


# --- distributions ---------------------------------------------------------------------


def target_summary(df: DataFrame, *, target: str) -> DataFrame:
    """Count, label and percentage (two places) of each target value, NULL too."""
    counts = df.groupBy(target).agg(F.count("*").alias("count"))
    # one row per target value: a window over this table is tiny
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        target,
        survival_label(F.col(target)).alias("label"),
        "count",
        F.round(F.col("count") * F.lit(100.0) / total, 2).alias("percentage"),
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) of every category, one shuffle for all columns."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.explode(cells).alias("_c"))
        .groupBy("_c.column_name", "_c.value")
        .agg(F.count("*").alias("n"))
    )


def children_per_parent(df: DataFrame, *, parent: str, child: str) -> DataFrame:
    """Distinct children of each parent."""
    return df.groupBy(parent).agg(F.count_distinct(F.col(child)).alias("n_children"))


def repeat_summary(df: DataFrame, *, parent: str, child: str) -> DataFrame:
    """Largest number of children and how many parents have more than one."""
    return children_per_parent(df, parent=parent, child=child).agg(
        F.max("n_children").alias("max_children"),
        F.count_if(F.col("n_children") > 1).alias("parents_with_several"),
    )


def cohort_summary(
    df: DataFrame,
    *,
    patient: str,
    admission: str,
    stay: str,
    target: str,
    age: str | None = None,
) -> DataFrame:
    """(metric, value): rows, distinct ids, deaths, rate, and the age range."""
    sums = [
        F.count("*").alias("rows"),
        F.count_distinct(F.col(patient)).alias("unique_patients"),
        F.count_distinct(F.col(admission)).alias("unique_admissions"),
        F.count_distinct(F.col(stay)).alias("unique_icu_stays"),
        F.sum(target).alias("deaths"),
        F.avg(target).alias("mortality_rate"),
    ]
    if age:
        sums += [F.min(age).alias("minimum_age"), F.max(age).alias("maximum_age")]
    row = df.agg(*sums)
    return _long(
        row, [(c, {"value": F.col(c).cast("double")}) for c in row.columns], "metric"
    )


def compact_summary(df: DataFrame, *, patient: str, stay: str, target: str) -> DataFrame:
    """(metric, value): rows, patients, stays, deaths, survivors, mortality rate."""
    row = df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.col(patient)).alias("unique_patients"),
        F.count_distinct(F.col(stay)).alias("unique_stays"),
        F.sum(target).alias("deaths"),
        F.count_if(F.col(target) == 0).alias("survivors"),
        F.avg(target).alias("mortality_rate"),
    )
    return _long(
        row, [(c, {"value": F.col(c).cast("double")}) for c in row.columns], "metric"
    )


def inclusion_report(
    df: DataFrame, mask: Column, *, patient: str, admission: str, stay: str
) -> DataFrame:
    """(metric, value) rows before and after a filter, from one scan."""
    kept = F.coalesce(mask, F.lit(False))
    row = df.agg(
        F.count("*").alias("rows_before_filtering"),
        F.count_if(kept).alias("rows_after_filtering"),
        F.count_if(~kept).alias("rows_removed"),
        F.count_distinct(F.when(kept, F.col(patient))).alias("patients_after_filtering"),
        F.count_distinct(F.when(kept, F.col(admission))).alias(
            "admissions_after_filtering"
        ),
        F.count_distinct(F.when(kept, F.col(stay))).alias("icu_stays_after_filtering"),
    )
    return _long(row, [(c, {"value": F.col(c)}) for c in row.columns], "metric")


# --- event tables -----------------------------------------------------------------------


def event_coverage(events: DataFrame, *, name: str, entity: str) -> DataFrame:
    """(name, measurement_count, stays_with_measurement)."""
    return (
        events.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(
            F.count("*").alias("measurement_count"),
            F.count_distinct(F.col(entity)).alias("stays_with_measurement"),
        )
    )


def cleaning_summary(events: DataFrame, *, name: str, value: str) -> DataFrame:
    """(name, total, excluded, retained) after the plausibility check."""
    return events.groupBy(name).agg(
        F.count("*").alias("total_mapped_measurements"),
        F.count_if(F.col(value).isNull()).alias("excluded_measurements"),
        F.count(value).alias("retained_measurements"),
    )


def feature_group_counts(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """(feature_group, number_of_features) by name prefix, and rows of the table.

    The names come from the schema; the row count makes the table's size visible
    beside them.
    """
    sized = df.agg(F.count("*").alias("table_rows"))
    cells = [
        (
            label,
            {
                "number_of_features": F.lit(
                    sum(c.startswith(tuple(f"{p}_" for p in prefixes)) for c in df.columns)
                ),
                "table_rows": F.col("table_rows"),
            },
        )
        for label, prefixes in groups.items()
    ]
    return _long(sized, cells, "feature_group")
