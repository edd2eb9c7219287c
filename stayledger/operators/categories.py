"""Category dictionaries: numbered values as a table, codes by join, sparse one-hot vectors.

A dictionary is a table (column_name, value, idx): the distinct values of each
column in code-point order, numbered from 0.  It never passes through the driver
or one task, so the number of categories has no limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window, functions as F

from stayledger.operators.checks import require_columns
from stayledger.operators.profile import category_counts
from stayledger.operators.scale import fits_broadcast, spread_join
from stayledger.session import stable


def category_summary(counts: DataFrame) -> DataFrame:
    """(column_name, size, missing, top) of category counts; ties take the smaller value."""
    known = F.col("value").isNotNull()
    order = F.when(known, F.struct(-F.col("n"), F.col("value").alias("value")))
    return counts.groupBy("column_name").agg(
        F.count("value").alias("size"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("missing"),
        F.min(order).getField("value").alias("top"),
    )


def number_categories(counts: DataFrame) -> DataFrame:
    """(column_name, value, idx) of category counts, values in code-point order.

    Values are ranged over all tasks and numbered inside a range; the ranges'
    first numbers are one row per range and column.
    """
    values = counts.where(F.col("value").isNotNull()).select("column_name", "value")
    # the range is written with the value, so a task that runs again can't change it
    ranged = stable(
        values.repartitionByRange("column_name", "value").withColumn(
            "_part", F.spark_partition_id()
        )
    )
    sizes = ranged.groupBy("column_name", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("column_name").orderBy("_part")
    firsts = sizes.select(
        "column_name", "_part", (F.sum("_n").over(before) - F.col("_n")).alias("_first")
    )
    inside = Window.partitionBy("column_name", "_part").orderBy("value")
    return (
        ranged.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(F.broadcast(firsts), ["column_name", "_part"])
        .select("column_name", "value", (F.col("_first") + F.col("_rank")).alias("idx"))
    )


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, idx) of the columns' values, NULL left out."""
    require_columns(df, columns)
    return number_categories(stable(category_counts(df, columns)))


def category_codes(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Mapping[str, str],
    *,
    fills: Mapping[str, str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """``df`` with each column's code under the given name, NULL for an unknown value.

    ``small`` is the outcome of ``fits_broadcast`` on the dictionary, measured
    here where it is not given.  Beyond it rows are shuffled by value, and
    values of millions of rows are joined apart.
    """
    require_columns(df, list(columns))
    if small is None:
        small = fits_broadcast(dictionary)
    taken = set(df.columns)
    key = next(k for k in ("_value" + "_" * i for i in range(len(taken) + 1)) if k not in taken)
    for column, code in columns.items():
        value = F.col(f"`{column}`").cast("string")
        if fills and column in fills:
            value = F.coalesce(value, F.lit(fills[column]))
        own = dictionary.where(F.col("column_name") == column).select(
            F.col("value").alias(key), F.col("idx").alias(code)
        )
        df = spread_join(df.withColumn(key, value), own, [key], how="left", small=small)
        df = df.drop(key)
    return df


def _nominal(code: str, size: int) -> Column:
    """A code as an index of ``size`` values; unknown ones are one past the last."""
    index = F.coalesce(F.col(code), F.lit(size)).cast("double")
    meta = {"ml_attr": {"type": "nominal", "num_vals": size}}
    return index.alias(code, metadata=meta)


def one_hot_codes(df: DataFrame, sizes: Mapping[str, int], outputs: Mapping[str, str]) -> DataFrame:
    """Sparse one-hot vectors of code columns, all zeros for unknown values.

    The sizes are given, so nothing is scanned; the code columns are dropped.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in sizes]
    ready = df.select(*rest, *[_nominal(c, n) for c, n in sizes.items()])
    # the last category of "keep" is the unknown value, and dropLast drops it
    encoder = OneHotEncoder(
        inputCols=list(sizes),
        outputCols=[outputs[c] for c in sizes],
        handleInvalid="keep",
        dropLast=True,
    )
    return encoder.fit(ready).transform(ready).drop(*sizes)
