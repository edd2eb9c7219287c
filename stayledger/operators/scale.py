"""Building blocks that keep joins, ranks and running totals parallel.

The hazards they answer:

* one key holding a large share of the rows  -> ``spread_join``
* a running total or rank over a whole table -> range buckets cut at the data's
  own quantiles, a small table of bucket totals, and a window per bucket
* exact percentiles                          -> only the bucket that contains
  the wanted position is looked at row by row

Bucket edges come from approximate percentiles and only balance the work; the
results are exact whatever the edges are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stayledger.session import stable

BUCKETS = 256
MOST_BUCKETS = 4096
SKETCH_MERGERS = 64
SALTS = 8
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 5_000_000
FIXED_BYTES = 16  # of one fixed-width value with its row overhead


# --- joins ------------------------------------------------------------------------


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a table (rows, and the bytes of its strings) against the limit.

    One small aggregate; meant for tables that are already written or cheap.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    sizes = [F.sum(F.coalesce(F.octet_length(c), F.lit(0))).alias(f"s{i}") for i, c in enumerate(text)]
    row = df.agg(F.count("*").alias("n"), *sizes).first()
    fixed = row["n"] * FIXED_BYTES * (len(df.columns) + 1)
    return fixed + sum(row[f"s{i}"] or 0 for i in range(len(text))) <= limit


def spread_join(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    condition: Column | None = None,
    small: bool | None = None,
    salts: int = SALTS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join a large table to one with few rows per key, whatever the skew.

    ``small`` is the outcome of ``fits_broadcast``:

    * True: the dimension goes to every task and the fact side is not moved.
    * False: keys with more than ``hot_rows`` fact rows are joined the same way,
      against their own dimension rows; all other rows are shuffled by key.
    * None, not measured: the dimension is measured here.  If it does not fit, a
      key's fact rows spread over ``salts`` tasks by their input split, the
      dimension repeats once per salt, and both sides are shuffled: repeated
      rows must not be broadcast.

    ``condition`` refers to the sides as ``fact`` and ``dimension``.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join repeats the right side: inner or left only")
    if how == "inner":
        for key in keys:
            fact = fact.where(F.col(key).isNotNull())
    unmeasured = small is None
    if small or (unmeasured and fits_broadcast(dimension)):
        return _matched(fact, F.broadcast(dimension), keys, how, condition)
    if unmeasured:
        left = fact.withColumn(
            "_salt", F.pmod(F.spark_partition_id(), F.lit(salts)).cast("int")
        )
        right = dimension.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        )
        shuffled = right.hint("merge")
        return _matched(left, shuffled, [*keys, "_salt"], how, condition).drop("_salt")
    # a table of N rows has fewer than N / hot_rows such keys
    hot = stable(
        fact.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .dropna(subset=list(keys))
        .select(*keys)
    )
    hot_side = F.broadcast(dimension.join(F.broadcast(hot), list(keys), "left_semi"))
    hot_fact = fact.join(F.broadcast(hot), list(keys), "left_semi")
    cold_fact = fact.join(F.broadcast(hot), list(keys), "left_anti")
    return _matched(hot_fact, hot_side, keys, how, condition).unionByName(
        _matched(cold_fact, dimension, keys, how, condition)
    )


def _matched(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str,
    condition: Column | None,
) -> DataFrame:
    on = F.lit(True) if condition is None else condition
    for key in keys:
        on = on & (F.col(f"fact.{key}") == F.col(f"dimension.{key}"))
    kept = [F.col(f"fact.{c}") for c in fact.columns] + [
        F.col(f"dimension.{c}") for c in dimension.columns if c not in keys
    ]
    return fact.alias("fact").join(dimension.alias("dimension"), on, how).select(*kept)


def same_group(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of aliases ``t`` and ``s``; two NULLs count as equal.

    Columns that cannot be NULL compare plainly, which lets the join use a
    partitioning that is already there.
    """
    condition = F.lit(True)
    for name in columns:
        a, b = F.col(f"t.{name}"), F.col(f"s.{name}")
        nullable = left.schema[name].nullable or right.schema[name].nullable
        condition = condition & (a.eqNullSafe(b) if nullable else a == b)
    return condition


def join_small(
    table: DataFrame,
    small: DataFrame,
    by: Sequence[str],
    *,
    how: str = "inner",
    bounded: bool = False,
) -> DataFrame:
    """Attach a small per-group table, matching NULL groups too.

    ``bounded`` says the caller knows a fixed limit on its rows, which makes the
    broadcast safe; otherwise Catalyst and AQE choose by size.
    """
    extra = [F.col(f"s.{c}") for c in small.columns if c not in by]
    if bounded:
        small = F.broadcast(small)
    joined = table.alias("t").join(
        small.alias("s"), same_group(table, small, by), how
    )
    return joined.select("t.*", *extra)


# --- range buckets ----------------------------------------------------------------


@dataclass(frozen=True)
class Edges:
    """Bucket edges of one column, and the buckets that hold a single value."""

    splits: tuple[float, ...]

    @property
    def single_value_buckets(self) -> list[int]:
        return [
            i
            for i, (low, high) in enumerate(zip(self.splits, self.splits[1:]))
            if math.isfinite(low) and high == math.nextafter(low, math.inf)
        ]

    @classmethod
    def from_quantiles(cls, values: Sequence[float] | None) -> Edges:
        """A value that fills whole quantiles gets a bucket to itself."""
        finite = [v for v in values or () if v is not None and math.isfinite(v)]
        edges = set(finite)
        for before, after in zip(finite, finite[1:]):
            if before == after:
                edges.add(math.nextafter(after, math.inf))
        if not edges:
            edges = {0.0}
        return cls((-math.inf, *sorted(edges), math.inf))


def bucket_count(df: DataFrame) -> int:
    """As many range buckets as the session shuffles into, within 256..4096."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(BUCKETS, min(MOST_BUCKETS, partitions))


def cut_points(
    df: DataFrame, columns: Sequence[str], *, buckets: int | None = None
) -> dict[str, Edges]:
    """Approximate quantiles of several columns: one scan, one row back.

    Quantile sketches merge in two levels, so one task never receives the
    sketches of every input task.
    """
    buckets = buckets or bucket_count(df)
    size = min(4 * buckets, 65535)
    listed = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    ranks = F.expr(f"array({listed})")
    names = [f"q{i}" for i in range(len(columns))]
    by_share = df.groupBy(
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_MERGERS)).alias("_share")
    ).agg(
        *[
            F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(q)
            for q, c in zip(names, columns)
        ]
    )
    merged = by_share.agg(*[F.kll_merge_agg_double(q, size).alias(q) for q in names])
    row = merged.select(
        *[
            F.when(
                F.kll_sketch_get_n_double(q) > 0,
                F.kll_sketch_get_quantile_double(q, ranks),
            ).alias(q)
            for q in names
        ]
    ).first()
    return {c: Edges.from_quantiles(row[q]) for q, c in zip(names, columns)}


def with_buckets(
    df: DataFrame, edges: Mapping[str, Edges], *, suffix: str = "_bucket"
) -> DataFrame:
    """Add ``<column>_bucket`` by binary search in the edges (JVM-side)."""
    doubled = df.select(
        "*", *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(edges)]
    )
    bucketed = Bucketizer(
        splitsArray=[list(e.splits) for e in edges.values()],
        inputCols=[f"_x{i}" for i in range(len(edges))],
        outputCols=[f"_b{i}" for i in range(len(edges))],
        handleInvalid="keep",
    ).transform(doubled)
    return bucketed.select(
        *df.columns,
        *[
            F.coalesce(F.col(f"_b{i}").cast("int"), F.lit(-1)).alias(f"{c}{suffix}")
            for i, c in enumerate(edges)
        ],
    )


# --- running totals -----------------------------------------------------------------


def running_totals(
    table: DataFrame,
    *,
    by: Sequence[str],
    buckets: Sequence[str],
    order: Sequence[Column],
    bucket_order: Sequence[Column],
    sums: Mapping[str, str],
) -> DataFrame:
    """Inclusive running totals per group in a global order.

    ``sums`` maps an output name to the summed column.  Bucket totals form a
    small table (groups x buckets); its prefix sums are added to the running
    totals inside each bucket.
    """
    bucket_key = [*by, *buckets]
    totals = table.groupBy(*bucket_key).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy(*bucket_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *bucket_key,
        *[
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}")
            for name in sums
        ],
    )
    inside = (
        Window.partitionBy(*bucket_key)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = table.select(
        "*", *[F.sum(column).over(inside).alias(f"_in_{name}") for name, column in sums.items()]
    )
    joined = join_small(running, offsets, bucket_key)
    return joined.select(
        *table.columns,
        *[(F.col(f"_before_{name}") + F.col(f"_in_{name}")).alias(name) for name in sums],
    )


# --- ranks ----------------------------------------------------------------------------


def _rank_groups(
    df: DataFrame, score: str, tie: str, buckets: int | None
) -> DataFrame:
    """Tag rows with contiguous slices (``_hi`` descending, ``_lo`` ascending).

    A score shared by more rows than a bucket should hold has its own bucket,
    which is sliced further along the tie-break, so no slice exceeds about
    1/buckets of the rows.
    """
    edges = cut_points(df, [score, tie], buckets=buckets)
    tagged = with_buckets(df, edges)
    high, low = F.col(f"{score}_bucket"), F.col(f"{tie}_bucket")
    hot = edges[score].single_value_buckets
    sliced = F.when(high.isin(hot), low).otherwise(0) if hot else F.lit(0)
    return tagged.select(*df.columns, high.alias("_hi"), sliced.alias("_lo"))


def rank_rows(
    df: DataFrame, *, score: str, tie: str, rank: str = "risk_rank", buckets: int | None = None
) -> DataFrame:
    """Rank 1..n by score descending, ties by ``tie`` ascending; all rows kept."""
    tagged = _rank_groups(df, score, tie, buckets).withColumns(
        {"_all": F.lit(0), "_one": F.lit(1)}
    )
    ranked = running_totals(
        tagged,
        by=["_all"],
        buckets=["_hi", "_lo"],
        order=[F.col(score).desc(), F.col(tie).asc()],
        bucket_order=[F.col("_hi").desc(), F.col("_lo").asc()],
        sums={rank: "_one"},
    )
    return ranked.select(*df.columns, F.col(rank).cast("bigint").alias(rank))


def top_k_sums(
    df: DataFrame,
    *,
    score: str,
    tie: str,
    flag: str,
    fractions: Sequence[float],
    buckets: int | None = None,
) -> DataFrame:
    """For each fraction c: k = max(1, ceil(c n)) and the flags among the top k.

    Slices wholly above the cut are summed from the slice totals; rows are
    ordered only inside the one slice each cut falls into.
    """
    tagged = _rank_groups(
        df.select(score, tie, flag), score, tie, buckets
    ).withColumn("_all", F.lit(0))
    slices = tagged.groupBy("_all", "_hi", "_lo").agg(
        F.count("*").alias("_rows"), F.sum(flag).alias("_flags")
    )
    whole = Window.partitionBy("_all")
    ordered = whole.orderBy(F.col("_hi").desc(), F.col("_lo").asc())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    placed = slices.select(
        "*",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_flags").over(before), F.lit(0)).alias("_flags_before"),
        F.sum("_rows").over(whole).alias("_n"),
        F.sum("_flags").over(whole).alias("_total_flags"),
    )
    cuts = (
        placed.withColumn(
            "_fraction", F.explode(F.array(*[F.lit(float(c)) for c in fractions]))
        )
        .withColumn(
            "_k", F.greatest(F.lit(1), F.ceil(F.col("_fraction") * F.col("_n"))).cast("bigint")
        )
        .where(
            (F.col("_rows_before") < F.col("_k"))
            & (F.col("_k") <= F.col("_rows_before") + F.col("_rows"))
        )
        .select(
            "_hi", "_lo", "_fraction", "_k", "_rows_before", "_flags_before", "_total_flags"
        )
    )
    inside = Window.partitionBy("_fraction").orderBy(F.col(score).desc(), F.col(tie).asc())
    # one row per fraction, so the broadcast is bounded
    edge_rows = (
        tagged.join(F.broadcast(cuts), ["_hi", "_lo"])
        .withColumn("_place", F.row_number().over(inside))
        .where(F.col("_place") <= F.col("_k") - F.col("_rows_before"))
    )
    return edge_rows.groupBy("_fraction", "_k", "_flags_before", "_total_flags").agg(
        F.sum(flag).alias("_flags_inside")
    ).select(
        F.col("_fraction").alias("fraction"),
        F.col("_k").alias("k"),
        (F.col("_flags_before") + F.col("_flags_inside")).cast("bigint").alias("captured"),
        F.col("_total_flags").cast("bigint").alias("total"),
    )


# --- exact percentiles ------------------------------------------------------------------


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Linearly interpolated percentiles: (by..., feature, q, value).

    Bucket counts locate the two order statistics each percentile needs; only
    rows of those buckets are grouped by value and put in order.  NULLs are
    left out; a group without values has no rows.
    """
    edges = cut_points(df, columns, buckets=buckets)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(c).cast("double").alias("_v"),
                F.col(f"{c}_bucket").alias("_b"),
            )
            for c in columns
        ]
    )
    long = (
        with_buckets(df.select(*by, *columns), edges)
        .select(*by, F.explode(cells).alias("_c"))
        .select(*by, "_c.feature", "_c._v", "_c._b")
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    )
    group = [*by, "feature"]
    counts = stable(long.groupBy(*group, "_b").agg(F.count("*").alias("_rows")))
    ordered = Window.partitionBy(*group).orderBy("_b")
    placed = counts.select(
        "*",
        F.coalesce(
            F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("_n"),
    )
    position = F.col("q") * (F.col("_n") - 1)
    targets = (
        placed.withColumn(
            "q", F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
        )
        .withColumn("_place", F.explode(F.array(F.floor(position), F.ceil(position))))
        .where(
            (F.col("_before") <= F.col("_place"))
            & (F.col("_place") < F.col("_before") + F.col("_rows"))
        )
        .withColumn("_weight", F.lit(1.0) - F.abs(position - F.col("_place")))
        # both order statistics of a whole position coincide: count it once
        .dropDuplicates([*group, "q", "_place"])
    )
    touched = targets.select(*group, "_b", "_before").distinct()
    # without groups: at most two rows per column and probability
    values = (
        join_small(
            long, touched, [*group, "_b"], bounded=not by or fits_broadcast(touched)
        )
        .groupBy(*group, "_b", "_before", "_v")
        .agg(F.count("*").alias("_k"))
        .withColumn(
            "_end",
            F.col("_before")
            + F.sum("_k").over(
                Window.partitionBy(*group, "_b")
                .orderBy("_v")
                .rowsBetween(Window.unboundedPreceding, 0)
            ),
        )
        .select(*group, "_b", "_v", "_end", (F.col("_end") - F.col("_k")).alias("_start"))
    )
    hit = (
        same_group(values, targets, [*group, "_b"])
        & (F.col("t._start") <= F.col("s._place"))
        & (F.col("s._place") < F.col("t._end"))
    )
    return (
        values.alias("t")
        .join(targets.alias("s"), hit)
        .groupBy(*[F.col(f"s.{g}").alias(g) for g in group], F.col("s.q").alias("q"))
        .agg(F.sum(F.col("t._v") * F.col("s._weight")).alias("value"))
    )


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) of each column's most common value, ties to the smallest."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    counted = (
        df.select(F.explode(cells).alias("_c"))
        .select("_c.feature", "_c.value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    first = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("value").asc())
    return (
        counted.withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") == 1)
        .drop("_place")
    )
