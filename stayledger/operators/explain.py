"""Per-row and global explanations of a random forest.

Exact path-dependent Shapley values of the forest's positive-class probability.
The forest's node table gives thresholds, children, covers and shares of positives.
Each leaf is reduced to one interval and one cover share per feature on its path.  What
it adds to a row depends only on which intervals the row meets, so a leaf's contributions
are tabled once per pattern and rows look theirs up; that goes on in Arrow batches on the
executors, and leaves a long table (row id, feature, value, contribution).
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from stayledger.operators.forest import BinnedForestModel
from stayledger.operators.scale import join_small
from stayledger.session import shared_folder

# executors need not have this package installed: its kernel travels with the plan
cloudpickle.register_pickle_by_value(sys.modules[__name__])


Forest = BinnedForestModel | RandomForestClassificationModel

#: Leaves with more features on their path have too many patterns to table.
TABLED = 12
TABLE_CELLS = 1 << 20

# --- the fitted forest as a table ------------------------------------------------------


def node_table(spark: SparkSession, forest: Forest) -> DataFrame:
    """(tree, node, left, right, feature, threshold, cover, positive_share)."""
    if isinstance(forest, BinnedForestModel):
        rows = [
            (tree, node, left if column >= 0 else -1, right if column >= 0 else -1, column, cut, cover, value)
            for tree, node, column, cut, left, right, value, _, cover in forest.nodes()
        ]
        return spark.createDataFrame(
            rows,
            "tree int, node int, left int, right int, feature int, threshold double, "
            "cover double, positive_share double",
        )
    folder = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    forest.write().save(folder)
    stats = F.col("nodeData.impurityStats")
    cover = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    return spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        cover.alias("cover"),
        (stats[1] / cover).alias("positive_share"),
    )


def base_value(nodes: DataFrame) -> DataFrame:
    """One row: the forest's cover-weighted mean leaf probability, over all trees."""
    per_tree = (
        nodes.where(F.col("left") < 0)
        .groupBy("tree")
        .agg(
            (F.sum(F.col("cover") * F.col("positive_share")) / F.sum("cover")).alias("v")
        )
    )
    return per_tree.agg(F.avg("v").alias("base_value"), F.count("*").alias("n_trees"))


def leaf_paths(nodes: DataFrame) -> list[dict]:
    """Every leaf as value, and per feature on its path: interval and cover share.

    The node table is as large as the model, which Spark ML keeps on the driver.
    """
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    leaves = []
    for tree in trees.values():
        pending = [(0, {})]
        while pending:
            node_id, path = pending.pop()
            node = tree[node_id]
            if node["left"] < 0:
                leaves.append(
                    {
                        "value": node["positive_share"] / len(trees),
                        "features": np.array(list(path), dtype=int),
                        "low": np.array([p[0] for p in path.values()]),
                        "high": np.array([p[1] for p in path.values()]),
                        "share": np.array([p[2] for p in path.values()]),
                    }
                )
                continue
            f, t = node["feature"], node["threshold"]
            low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
            for child, interval in (
                (node["left"], (low, min(high, t))),
                (node["right"], (max(low, t), high)),
            ):
                kept = share * tree[child]["cover"] / node["cover"]
                pending.append((child, {**path, f: (*interval, kept)}))
    return leaves


def pattern_values(value: np.ndarray, z: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Contributions (leaves, patterns, features) of leaves with d features on their path.

    ``z`` (leaves, d) are cover shares, ``o`` (patterns, d) tells which intervals are met.
    Feature i earns value * (o_i - z_i) * sum_k w_k q_k, where q are the coefficients of
    the product of (z_j + o_j t) over the other features.
    """
    d = z.shape[1]
    met_by = o[None, :, :]
    poly = np.zeros((len(z), len(o), d + 1))
    poly[:, :, 0] = 1.0
    for j in range(d):
        grown = poly * z[:, None, [j]]
        grown[:, :, 1:] += poly[:, :, :-1] * met_by[:, :, [j]]
        poly = grown
    weight = [
        math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)
    ]
    shares = z[:, None, :]
    met = np.zeros((len(z), len(o), d))
    carry = np.zeros((len(z), len(o), d))
    for k in range(d - 1, -1, -1):
        carry = poly[:, :, [k + 1]] - shares * carry
        met += weight[k] * carry
    unmet = (poly[:, :, :d] @ np.array(weight))[:, :, None] / shares
    return value[:, None, None] * (met_by - shares) * np.where(met_by > 0, met, unmet)


def shapley_batch(x: np.ndarray, leaves: list[dict]) -> np.ndarray:
    """Contributions (rows x features) of a batch, summed over all leaves."""
    out = np.zeros((x.shape[1], len(x)))
    columns = np.ascontiguousarray(x.T)
    by_size: dict[int, list[dict]] = {}
    for leaf in leaves:
        by_size.setdefault(len(leaf["features"]), []).append(leaf)
    for d, alike in by_size.items():
        if d == 0:
            continue
        tabled = d <= TABLED
        bits = 1 << np.arange(d)
        patterns = (np.arange(1 << d)[:, None] & bits > 0).astype(float) if tabled else None
        step = max(1, TABLE_CELLS // (d << d)) if tabled else 1
        for at in range(0, len(alike), step):
            some = alike[at : at + step]
            value = np.array([leaf["value"] for leaf in some])
            z = np.array([leaf["share"] for leaf in some])
            table = pattern_values(value, z, patterns) if tabled else None
            for i, leaf in enumerate(some):
                features = leaf["features"]
                chosen = columns[features]
                o = (chosen > leaf["low"][:, None]) & (chosen <= leaf["high"][:, None])
                if tabled:
                    out[features] += table[i].T[:, bits @ o]
                else:
                    out[features] += pattern_values(value, z, o.T.astype(float))[0].T
    return out.T


def tree_shap(
    forest: Forest,
    df: DataFrame,
    *,
    row_id: str,
    feature_names: Sequence[str],
    features: str = "features",
    nonzero_only: bool = False,
) -> DataFrame:
    """(row_id, feature, feature_value, shap_value) for every row and feature."""
    spark = df.sparkSession
    leaves = spark.sparkContext.broadcast(leaf_paths(node_table(spark, forest)))
    names = np.array(list(feature_names), dtype=object)
    id_type = df.schema[row_id].dataType

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["_x"].to_numpy())
            phi = shapley_batch(x, leaves.value)
            long = pd.DataFrame(
                {
                    row_id: np.repeat(batch[row_id].to_numpy(), x.shape[1]),
                    "feature": np.tile(names, len(batch)),
                    "feature_value": x.ravel(),
                    "shap_value": phi.ravel(),
                }
            )
            yield long[long["shap_value"] != 0] if nonzero_only else long

    schema = T.StructType(
        [
            T.StructField(row_id, id_type),
            T.StructField("feature", T.StringType()),
            T.StructField("feature_value", T.DoubleType()),
            T.StructField("shap_value", T.DoubleType()),
        ]
    )
    vectors = df.select(row_id, vector_to_array(features).alias("_x"))
    # explaining costs far more than moving a row: no core is left idle
    cores = spark.sparkContext.defaultParallelism
    if vectors.rdd.getNumPartitions() < cores:
        vectors = vectors.repartition(cores)
    return vectors.mapInPandas(explain, schema)


# --- checks -------------------------------------------------------------------------------


def shap_completeness(contributions: DataFrame, *, row_id: str, n_features: int) -> DataFrame:
    """One row: rows explained, rows with a wrong feature count, missing values."""
    per_row = contributions.groupBy(row_id).agg(
        F.count("*").alias("_n"), F.count_if(F.col("shap_value").isNull()).alias("_gone")
    )
    return per_row.agg(
        F.count("*").alias("rows_explained"),
        F.count_if(F.col("_n") != n_features).alias("rows_incomplete"),
        F.sum("_gone").alias("missing_values"),
    )


def shap_additivity(
    contributions: DataFrame, scores: DataFrame, base: DataFrame, *, row_id: str, score: str
) -> DataFrame:
    """One row: the largest gap between base + contributions and the score."""
    summed = contributions.groupBy(row_id).agg(F.sum("shap_value").alias("_sum"))
    gap = F.abs(
        F.col("_sum") + base.select("base_value").scalar() - F.col(score)
    )
    return summed.join(scores.select(row_id, score), row_id).agg(
        F.count("*").alias("rows_compared"), F.max(gap).alias("max_additivity_error")
    )


# --- importance ----------------------------------------------------------------------------


def global_importance(contributions: DataFrame, *, rows: int | None = None) -> DataFrame:
    """(feature, mean_absolute_shap, importance_rank 1..n).

    ``rows``: the number of explained rows, needed where only non-zero contributions
    were kept, as those left out count in the mean.
    """
    size = F.abs("shap_value")
    mean = F.avg(size) if rows is None else F.sum(size) / F.lit(float(rows))
    means = contributions.groupBy("feature").agg(mean.alias("mean_absolute_shap"))
    # one row per model feature
    order = Window.partitionBy(F.lit(0)).orderBy(
        F.col("mean_absolute_shap").desc(), F.col("feature").asc()
    )
    return means.withColumn("importance_rank", F.row_number().over(order))


def builtin_importance(spark: SparkSession, classifier, names: Sequence[str]) -> DataFrame:
    """(feature, random_forest_builtin_importance, rf_builtin_rank), ties share a rank."""
    if not hasattr(classifier, "featureImportances"):
        raise TypeError("classifier does not expose feature importances")
    values = classifier.featureImportances.toArray().tolist()
    if len(values) != len(names):
        raise ValueError("importance length does not match the feature names")
    table = spark.createDataFrame(
        list(zip(names, values)), "feature string, random_forest_builtin_importance double"
    )
    order = Window.partitionBy(F.lit(0)).orderBy(
        F.col("random_forest_builtin_importance").desc()
    )
    return table.withColumn("rf_builtin_rank", F.rank().over(order))


def compare_importance(shap: DataFrame, builtin: DataFrame) -> DataFrame:
    needed = (
        (shap, {"feature", "mean_absolute_shap", "importance_rank"}),
        (builtin, {"feature", "random_forest_builtin_importance", "rf_builtin_rank"}),
    )
    for table, columns in needed:
        absent = sorted(columns - set(table.columns))
        if absent:
            raise ValueError(f"importance table is missing: {absent}")
    return shap.join(builtin, "feature", "left").withColumn(
        "rank_difference", F.col("importance_rank") - F.col("rf_builtin_rank")
    )


# --- local views ------------------------------------------------------------------------------


def local_explanations(
    contributions: DataFrame,
    cases: DataFrame,
    *,
    row_id: str,
    keep: Sequence[str] = (),
    top: int | None = None,
) -> DataFrame:
    """Contributions of chosen cases, ranked by size, with their direction."""
    chosen = join_small(contributions, cases.select(row_id, *keep), [row_id])
    order = Window.partitionBy(row_id).orderBy(
        F.abs("shap_value").desc(), F.col("feature").asc()
    )
    ranked = chosen.select(
        "*",
        F.abs("shap_value").alias("absolute_shap_value"),
        F.when(F.col("shap_value") > 0, "increased predicted risk")
        .when(F.col("shap_value") < 0, "decreased predicted risk")
        .otherwise("no effect")
        .alias("direction"),
        F.row_number().over(order).alias("contribution_rank"),
    )
    return ranked if top is None else ranked.where(F.col("contribution_rank") <= top)


def _of_features(contributions: DataFrame, features: DataFrame) -> DataFrame:
    # at most one row per model feature
    return contributions.join(F.broadcast(features.select("feature")), "feature")


def dependence_points(
    contributions: DataFrame, importance: DataFrame, *, top: int = 4
) -> DataFrame:
    """(feature, row, value, contribution) of the leading numeric features."""
    numeric = importance.where(
        F.col("feature").startswith("numeric__")
        & ~F.lower("feature").contains("missingindicator")
    )
    leading = numeric.orderBy("importance_rank").limit(top)
    return _of_features(contributions, leading)


def summary_points(
    contributions: DataFrame, importance: DataFrame, *, top: int = 20
) -> DataFrame:
    return _of_features(contributions, importance.where(F.col("importance_rank") <= top))
