import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.operators import scale
from stayledger.operators.scale import Edges


def skewed(n=3000, seed=5):
    """A third of the rows share one score; the rest crowd near zero."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = 0.25 if i % 3 == 0 else rng.random() ** 6 / 1000
        rows.append((i, rng.randint(0, 1), p))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(skewed(), "id bigint, y int, p double").repartition(6)


def test_edges_isolate_a_repeated_value():
    edges = Edges.from_quantiles([0.1, 0.5, 0.5, 0.9])
    assert edges.splits[0] == -math.inf and edges.splits[-1] == math.inf
    hot = edges.single_value_buckets
    assert [edges.splits[i] for i in hot] == [0.5]
    assert Edges.from_quantiles(None).splits == (-math.inf, 0.0, math.inf)


def test_buckets_are_balanced_and_the_hot_score_is_alone(scored):
    edges = scale.cut_points(scored, ["p"], buckets=32)
    counts = scale.with_buckets(scored, edges).groupBy("p_bucket").count().collect()
    hot = edges["p"].single_value_buckets
    assert len(hot) == 1
    cold = [r["count"] for r in counts if r["p_bucket"] not in hot]
    assert max(cold) < 3 * 3000 / 32


@pytest.mark.parametrize("buckets", [4, 64])
def test_rank_is_a_total_order(scored, buckets):
    got = {
        r["id"]: r["rank"]
        for r in scale.rank_rows(
            scored, score="p", tie="id", rank="rank", buckets=buckets
        ).collect()
    }
    order = sorted(skewed(), key=lambda r: (-r[2], r[0]))
    assert got == {row[0]: i + 1 for i, row in enumerate(order)}


def test_hot_ties_are_sliced(scored):
    tagged = scale._rank_groups(scored, "p", "id", 32)
    largest = tagged.groupBy("_hi", "_lo").count().agg(F.max("count")).first()[0]
    assert largest < 3 * 3000 / 32


def test_top_k_sums_match_a_sort(scored):
    fractions = [0.001, 0.05, 0.2, 0.5, 1.0]
    got = {
        r["fraction"]: (r["k"], r["captured"], r["total"])
        for r in scale.top_k_sums(
            scored, score="p", tie="id", flag="y", fractions=fractions, buckets=16
        ).collect()
    }
    order = sorted(skewed(), key=lambda r: (-r[2], r[0]))
    total = sum(r[1] for r in order)
    for c in fractions:
        k = max(1, math.ceil(c * len(order)))
        assert got[c] == (k, sum(r[1] for r in order[:k]), total)


@pytest.mark.parametrize("buckets", [3, 50])
def test_quantiles_match_linear_interpolation(scored, buckets):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {
        r["q"]: r["value"]
        for r in scale.exact_quantiles(
            scored, ["p"], probabilities, buckets=buckets
        ).collect()
    }
    want = np.percentile([r[2] for r in skewed()], [100 * q for q in probabilities])
    assert np.allclose([got[q] for q in probabilities], want, atol=1e-15)


def test_quantiles_by_group_with_nulls_and_null_group(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 10.0), ("a", 11.0), ("b", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {
        r["g"]: r["value"]
        for r in scale.exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()
    }
    assert got == {"a": 6.0, None: 3.0}  # M4: the true median, not an order statistic


def test_quantiles_of_one_repeated_value(spark):
    df = spark.range(500).select(F.lit(7.0).alias("x"))
    assert scale.exact_quantiles(df, ["x"], [0.25, 0.5]).select("value").distinct().count() == 1


def test_most_frequent_prefers_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    row = scale.most_frequent(df, ["c"]).first()
    assert (row["value"], row["n"]) == ("a", 2)


@pytest.mark.parametrize("small, hot_rows", [(None, 1), (True, 1), (False, 10), (False, 10**6)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_keeps_every_match_of_a_hot_key(spark, how, small, hot_rows):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(900)] + [(None, -1)]
    fact = spark.createDataFrame(rows, "k int, v int").repartition(7)
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 900, 2)] + [(1, 10)], "k int, w int")
    got = Counter(
        (r["k"], r["v"], r["w"])
        for r in scale.spread_join(
            fact, dim, ["k"], how=how, small=small, hot_rows=hot_rows
        ).collect()
    )
    looked_up = {k: k * 10 for k in range(0, 900, 2)} | {1: 10}
    want = Counter(
        (k, v, looked_up.get(k))
        for k, v in rows
        if how == "left" or k in looked_up
    )
    assert got == want


@pytest.mark.parametrize("fits", [True, False])
def test_spread_join_never_broadcasts_repeated_rows(spark, monkeypatch, capsys, fits):
    monkeypatch.setattr(scale, "fits_broadcast", lambda df, limit=0: fits)
    fact = spark.createDataFrame([(i % 5, i) for i in range(40)], "k int, v int")
    dim = spark.createDataFrame([(k, k * 10) for k in range(5)], "k int, w int")
    joined = scale.spread_join(fact, dim, ["k"])
    joined.explain()
    plan = capsys.readouterr().out
    assert ("BroadcastHashJoin" in plan, "explode" in plan) == (fits, not fits)
    assert sorted(r["w"] for r in joined.collect()) == sorted(i % 5 * 10 for i in range(40))


def test_spread_join_refuses_other_joins(spark):
    df = spark.range(2)
    with pytest.raises(ValueError):
        scale.spread_join(df, df, ["id"], how="right")


def test_fits_broadcast_measures_text(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "c string")
    assert scale.fits_broadcast(df)
    assert not scale.fits_broadcast(df, limit=5000)


def test_running_totals_across_buckets(spark):
    df = spark.range(100).select(
        (F.col("id") % 2).alias("g"), "id", (F.col("id") / 13).cast("int").alias("b"), F.lit(1).alias("n")
    )
    got = scale.running_totals(
        df,
        by=["g"],
        buckets=["b"],
        order=[F.col("id").asc()],
        bucket_order=[F.col("b").asc()],
        sums={"cum": "n"},
    ).collect()
    assert all(r["cum"] == r["id"] // 2 + 1 for r in got)
