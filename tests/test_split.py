import math

import pytest
from pyspark.sql import functions as F

from stayledger.operators import checks, split


def outcomes(spark, n, every):
    return spark.range(n).select(
        F.col("id").alias("subject_id"),
        (F.col("id") % every == 0).cast("int").alias("entity_outcome"),
    )


def test_shares_are_exact_and_stratified(spark):
    assigned = split.assign_splits(outcomes(spark, 1003, 10), entity="subject_id")
    counts = {r["split"]: r["count"] for r in assigned.groupBy("split").count().collect()}
    held = math.ceil(0.30 * 1003)
    test = math.ceil(0.50 * held)
    assert counts == {"train": 1003 - held, "validation": held - test, "test": test}
    positives = {
        r["split"]: r["n"]
        for r in assigned.groupBy("split").agg(F.sum("entity_outcome").alias("n")).collect()
    }
    assert abs(positives["test"] - 0.15 * 101) <= 1
    assert abs(positives["validation"] - 0.15 * 101) <= 1
    assert assigned.select("subject_id").distinct().count() == 1003


def test_same_seed_same_split(spark):
    one = split.assign_splits(outcomes(spark, 200, 4), entity="subject_id", seed=1)
    two = split.assign_splits(
        outcomes(spark, 200, 4).repartition(7), entity="subject_id", seed=1
    )
    other = split.assign_splits(outcomes(spark, 200, 4), entity="subject_id", seed=2)
    assert one.exceptAll(two).count() == 0
    assert one.exceptAll(other).count() > 0


def test_demo_size(spark):
    assigned = split.assign_splits(outcomes(spark, 100, 7), entity="subject_id")
    counts = {r["split"]: r["count"] for r in assigned.groupBy("split").count().collect()}
    assert counts == {"train": 70, "validation": 15, "test": 15}


def test_too_few_cases_fall_back_to_no_strata(spark):
    single = outcomes(spark, 40, 1000)  # one positive
    assert not split.can_stratify(single, outcome="entity_outcome").first()["can_stratify"]
    assigned = split.assign_splits(single, entity="subject_id")
    counts = {r["split"]: r["count"] for r in assigned.groupBy("split").count().collect()}
    assert counts == {"train": 28, "validation": 6, "test": 6}


def test_rows_follow_their_patient(spark):
    rows = spark.range(300).select((F.col("id") % 60).alias("subject_id"), "id")
    assignment = split.assign_splits(outcomes(spark, 60, 3), entity="subject_id")
    assigned = split.split_rows(rows, assignment, entity="subject_id")
    assert assigned.count() == 300
    parts = [assigned.where(F.col("split") == s) for s in ("train", "validation", "test")]
    checks.validate_patient_split(*parts)
    checks.validate_split_totals(assigned, rows)
    with pytest.raises(ValueError):
        checks.validate_split_totals(assigned.where("id > 5"), rows)


def test_folds_keep_groups_whole(spark):
    rows = spark.range(400).select(
        (F.col("id") % 50).alias("g"), ((F.col("id") % 50) % 5 == 0).cast("int").alias("y")
    )
    n = split.fold_count(rows, target="y")
    folds = split.group_folds(rows, entity="g", target="y", n_folds=n)
    assert n == 5 and folds.count() == 50
    per_fold = folds.groupBy("fold").agg(F.sum("entity_outcome").alias("p"), F.count("*").alias("n"))
    assert {(r["p"], r["n"]) for r in per_fold.collect()} == {(2, 10)}


def test_fold_count_needs_both_classes(spark):
    few = spark.createDataFrame([(0,), (0,), (1,)], "y int")
    with pytest.raises(ValueError):
        split.fold_count(few, target="y")
    with pytest.raises(ValueError):
        split.fold_count(few.where("y = 0"), target="y")


def slow_balanced(entities, n_folds):
    """entities: (id, rows, positives), dealt one by one."""
    load, out = [[0, 0] for _ in range(n_folds)], {}
    for i, rows, positives in sorted(entities, key=lambda e: (-e[2], -e[1], e[0])):
        k = min(range(n_folds), key=lambda f: ((load[f][0], load[f][1], f) if positives else (load[f][1], f)))
        load[k][0] += positives
        load[k][1] += rows
        out[i] = k
    return out, load


def test_balanced_folds_match_plain_loops(spark):
    sizes = [(i, 1 + (i * i * 7) % 41, (i % 4 == 0) * (1 + i % 3)) for i in range(60)]
    rows = spark.createDataFrame([(i, int(j < p)) for i, n, p in sizes for j in range(max(n, p))], "g long, y int")
    sizes = [(i, max(n, p), p) for i, n, p in sizes]
    got = split.balanced_folds(rows, entity="g", target="y", n_folds=4, order_hash=F.col("g"))
    want, load = slow_balanced(sizes, 4)
    assert {r["g"]: r["fold"] for r in got.collect()} == want
    assert {(r["g"], r["rows"], r["positives"]) for r in got.collect()} == set(sizes)
    assert max(v[1] for v in load) - min(v[1] for v in load) <= max(s[1] for s in sizes)


def test_balanced_folds_fill_the_tail_by_running_totals(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") < 900, -1).when(F.col("id") < 1700, -2).when(F.col("id") < 5980, F.floor(F.col("id") / 7)).alias("g"),
        (F.col("id") % 11 == 0).cast("int").alias("y"),
    )
    got = split.balanced_folds(rows, entity="g", target="y", n_folds=3, largest=20)
    assert got.count() == rows.select("g").distinct().count()
    folds = got.groupBy("fold").agg(F.sum("rows").alias("n"), F.sum("positives").alias("p")).collect()
    assert len(folds) == 3 and sum(r["n"] for r in folds) == 6000
    assert max(r["n"] for r in folds) - min(r["n"] for r in folds) <= 4 * 7
    assert max(r["p"] for r in folds) - min(r["p"] for r in folds) <= 4
