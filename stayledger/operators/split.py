"""Entity-level splits and folds: no entity on two sides, same class shares.

Entities are put in a hash order.  The hash is uniform, so equal-width slices of
its range are balanced, and a rank is the slice's offset plus a window inside the
slice; no stratum passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayledger.config import SEED
from stayledger.operators.scale import fits_broadcast, running_totals, spread_join
from stayledger.session import stable

HASH_RANGE = 1 << 32
SLICES = 1024
LARGEST = 4096  # entities dealt one by one; they alone pass through the driver


def seeded_hash(entity: str, seed: int = SEED) -> Column:
    """Uniform in [0, 2**32), fixed by the entity and the seed."""
    return F.pmod(F.xxhash64(F.col(entity), F.lit(seed)), F.lit(HASH_RANGE))


def entity_outcomes(df: DataFrame, *, entity: str, admission: str, target: str) -> DataFrame:
    """(entity, entity_outcome = worst outcome, n_admissions)."""
    return df.groupBy(entity).agg(
        F.max(target).alias("entity_outcome"),
        F.count_distinct(F.col(admission)).alias("n_admissions"),
    )


def outcome_proportions(outcomes: DataFrame, *, outcome: str = "entity_outcome") -> DataFrame:
    counts = outcomes.groupBy(outcome).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(outcome, "n", (F.col("n") / total).alias("proportion"))


def can_stratify(outcomes: DataFrame, *, outcome: str, minimum: int = 2) -> DataFrame:
    """One row: more than one class, and every class has ``minimum`` members."""
    counts = outcomes.where(F.col(outcome).isNotNull()).groupBy(outcome).count()
    return counts.agg(
        F.count("*").alias("n_classes"),
        F.min("count").alias("smallest_class"),
        F.coalesce(
            (F.count("*") > 1) & (F.min("count") >= minimum), F.lit(False)
        ).alias("can_stratify"),
    )


def rank_in_stratum(
    df: DataFrame, *, stratum: str, order_hash: str, entity: str
) -> DataFrame:
    """Adds ``_rank`` 1..n within each stratum in hash order."""
    sliced = df.withColumns(
        {
            "_slice": F.floor(F.col(order_hash) / F.lit(HASH_RANGE // SLICES)).cast("int"),
            "_one": F.lit(1),
        }
    )
    return running_totals(
        sliced,
        by=[stratum],
        buckets=["_slice"],
        order=[F.col(order_hash).asc(), F.col(entity).asc()],
        bucket_order=[F.col("_slice").asc()],
        sums={"_rank": "_one"},
    ).drop("_slice", "_one")


def _held_out(
    df: DataFrame, *, stratum: str, order_hash: str, entity: str, fraction: float, flag: str
) -> DataFrame:
    """Mark ceil(fraction n) entities, shared over the strata in proportion.

    Whole shares go to each stratum first, what is left to the largest
    remainders.  Too few members in any class means no stratification.
    """
    ok = can_stratify(df, outcome=stratum).select("can_stratify").scalar()
    layered = df.withColumn(
        "_stratum", F.when(ok, F.col(stratum)).otherwise(F.lit(0)).cast("int")
    )
    ranked = rank_in_stratum(
        layered, stratum="_stratum", order_hash=order_hash, entity=entity
    )
    # one row per class of a binary outcome
    everyone = Window.partitionBy(F.lit(0))
    quota = (
        layered.groupBy("_stratum")
        .agg(F.count("*").alias("_n"))
        .withColumn("_total", F.sum("_n").over(everyone))
        .withColumn("_wanted", F.ceil(F.lit(float(fraction)) * F.col("_total")))
        .withColumn("_share", F.col("_wanted").cast("double") * F.col("_n") / F.col("_total"))
        .withColumn("_whole", F.floor("_share"))
        .withColumn(
            "_order",
            F.row_number().over(
                everyone.orderBy(
                    (F.col("_share") - F.col("_whole")).desc(), F.col("_stratum").asc()
                )
            ),
        )
        .withColumn("_left", F.col("_wanted") - F.sum("_whole").over(everyone))
        .select(
            "_stratum",
            (F.col("_whole") + (F.col("_order") <= F.col("_left")).cast("bigint")).alias(
                "_quota"
            ),
        )
    )
    return (
        ranked.join(F.broadcast(quota), "_stratum")
        .withColumn(flag, F.col("_rank") <= F.col("_quota"))
        .drop("_stratum", "_rank", "_quota")
    )


def assign_splits(
    outcomes: DataFrame,
    *,
    entity: str,
    outcome: str = "entity_outcome",
    held_out: float = 0.30,
    test_share: float = 0.50,
    order_hash: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(entity, outcome, split) with split in train / validation / test.

    ``held_out`` of the entities leave training; ``test_share`` of those are the
    test set.  Both cuts are stratified by the entity's outcome where possible.
    """
    key = seeded_hash(entity, seed) if order_hash is None else order_hash
    hashed = stable(outcomes.select(entity, outcome, key.cast("bigint").alias("_hash")))
    first = stable(
        _held_out(
            hashed,
            stratum=outcome,
            order_hash="_hash",
            entity=entity,
            fraction=held_out,
            flag="_held",
        )
    )
    second = _held_out(
        first.where("_held").drop("_held"),
        stratum=outcome,
        order_hash="_hash",
        entity=entity,
        fraction=test_share,
        flag="_test",
    ).select(
        entity,
        outcome,
        F.when(F.col("_test"), "test").otherwise("validation").alias("split"),
    )
    train = first.where(~F.col("_held")).select(entity, outcome, F.lit("train").alias("split"))
    return train.unionByName(second)


def split_rows(df: DataFrame, assignment: DataFrame, *, entity: str) -> DataFrame:
    """Rows with their entity's split (entities are unique in the assignment)."""
    table = stable(assignment.select(entity, "split"))
    return spread_join(df, table, [entity], small=fits_broadcast(table))


def split_summary(
    assigned: DataFrame, *, entity: str, admission: str, target: str, split: str = "split"
) -> DataFrame:
    return assigned.groupBy(split).agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.col(entity)).alias("unique_patients"),
        F.count_distinct(F.col(admission)).alias("unique_admissions"),
        F.count_if(F.col(target) == 1).alias("deaths"),
        F.count_if(F.col(target) == 0).alias("survivors"),
        F.round(F.avg(target), 4).alias("mortality_rate"),
    )


def split_crosstab(assigned: DataFrame, *, target: str, split: str = "split") -> DataFrame:
    return assigned.groupBy(split).agg(
        F.count_if(F.col(target) == 0).alias("survived"),
        F.count_if(F.col(target) == 1).alias("died"),
    )


def fold_count(df: DataFrame, *, target: str, maximum: int = 5) -> int:
    """min(maximum, rows in the rarer class); fewer than two is an error."""
    counts = df.groupBy(target).count().agg(F.min("count"), F.count("*")).first()
    n = min(maximum, counts[0] or 0) if counts[1] > 1 else 0
    if n < 2:
        raise ValueError("not enough observations in both classes for grouped folds")
    return n


def group_folds(
    df: DataFrame,
    *,
    entity: str,
    target: str,
    n_folds: int,
    order_hash: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(entity, entity_outcome, fold): whole entities dealt round-robin per outcome."""
    key = seeded_hash(entity, seed) if order_hash is None else order_hash
    entities = (
        df.groupBy(entity)
        .agg(F.max(target).cast("int").alias("entity_outcome"))
        .withColumn("_hash", key.cast("bigint"))
    )
    ranked = rank_in_stratum(
        entities, stratum="entity_outcome", order_hash="_hash", entity=entity
    )
    return ranked.select(
        entity,
        "entity_outcome",
        F.pmod(F.col("_rank") - 1, F.lit(n_folds)).cast("int").alias("fold"),
    )


def _deal_largest(entities, load: list[list[int]], by_positives: bool) -> list[int]:
    """Each entity in turn goes to the fold that is shortest; ``load`` is [positives, rows] per fold."""
    folds = []
    for e in entities:
        if by_positives:
            k = min(range(len(load)), key=lambda i: (load[i][0], load[i][1], i))
        else:
            k = min(range(len(load)), key=lambda i: (load[i][1], i))
        load[k][0] += e["positives"]
        load[k][1] += e["rows"]
        folds.append(k)
    return folds


def _room(load: list[int], total: int) -> list[float]:
    """How much of ``total`` each fold takes so that all that take any end level."""
    order = sorted(load)
    for n in range(len(order), 0, -1):
        level = (total + sum(order[:n])) / n
        if level >= order[n - 1]:
            break
    return [max(0.0, level - v) for v in load]


def balanced_folds(
    df: DataFrame,
    *,
    entity: str,
    target: str,
    n_folds: int,
    order_hash: Column | None = None,
    seed: int = SEED,
    largest: int = LARGEST,
) -> DataFrame:
    """(entity, entity_outcome, rows, positives, fold): folds even in rows and in positives.

    Entities with positives come first and go, most positives first, to the fold with
    the fewest positives (then rows); the others go, most rows first, to the fold with
    the fewest rows.  The ``largest`` of either kind are dealt one by one; the small
    ones that follow fill the room that is left in hash order by their running total,
    so a fold ends at most two of them away from its share.
    """
    key = seeded_hash(entity, seed) if order_hash is None else order_hash
    entities = stable(
        df.groupBy(entity)
        .agg(
            F.max(target).cast("int").alias("entity_outcome"),
            F.count("*").alias("rows"),
            F.count_if(F.col(target) == 1).alias("positives"),
        )
        .withColumn("_hash", key.cast("bigint"))
    )
    load = [[0, 0] for _ in range(n_folds)]
    parts = []
    for by_positives in (True, False):
        kind = entities.where(F.col("positives") > 0 if by_positives else F.col("positives") == 0)
        weight = "positives" if by_positives else "rows"
        order = [F.col("positives").desc(), F.col("rows").desc(), F.col("_hash").asc(), F.col(entity).asc()]
        first = kind.orderBy(*order).limit(largest).collect()
        if not first:
            continue
        dealt = [(*r, k) for r, k in zip(first, _deal_largest(first, load, by_positives))]
        schema = f"{kind.schema.simpleString()[7:-1]},fold:int"
        parts.append(df.sparkSession.createDataFrame(dealt, schema))
        if len(first) == largest:
            last = first[-1]
            rest = kind.where(_comes_after(last, entity))
            total = rest.agg(F.sum(weight)).first()[0]
            if total is None:
                continue
            room = _room([v[0 if by_positives else 1] for v in load], total)
            tail = stable(_fill(rest, room, weight, entity))
            for r in tail.groupBy("fold").agg(F.sum("positives").alias("p"), F.sum("rows").alias("n")).collect():
                load[r["fold"]][0] += r["p"]
                load[r["fold"]][1] += r["n"]
            parts.append(tail)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(entity, "entity_outcome", "rows", "positives", "fold")


def _comes_after(last, entity: str) -> Column:
    """Behind ``last`` in the order of balanced_folds (a NULL entity stands first)."""
    out = F.col(entity) > F.lit(last[entity]) if last[entity] is not None else F.col(entity).isNotNull()
    for column, down in (("_hash", False), ("rows", True), ("positives", True)):
        value = F.lit(last[column])
        beyond = F.col(column) < value if down else F.col(column) > value
        out = beyond | ((F.col(column) == value) & out)
    return out


def _fill(rest: DataFrame, room: list[float], weight: str, entity: str) -> DataFrame:
    """Adds ``fold``: entities in hash order fill one fold's room after the other."""
    sliced = rest.withColumn(
        "_slice", F.floor(F.col("_hash") / F.lit(HASH_RANGE // SLICES)).cast("int")
    ).withColumn("_all", F.lit(0))
    run = running_totals(
        sliced,
        by=["_all"],
        buckets=["_slice"],
        order=[F.col("_hash").asc(), F.col(entity).asc()],
        bucket_order=[F.col("_slice").asc()],
        sums={"_run": weight},
    )
    middle = F.col("_run") - F.col(weight) / 2.0
    ends, at = [], 0.0
    for k, r in enumerate(room):
        at += r
        if r > 0:
            ends.append((k, at))
    fold = F.lit(ends[-1][0])
    for k, end in reversed(ends[:-1]):
        fold = F.when(middle < end, k).otherwise(fold)
    return run.withColumn("fold", fold.cast("int")).drop("_slice", "_all", "_run")
