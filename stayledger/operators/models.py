"""Models on Spark ML: pipelines of preprocessing, class weights and classifier."""

from __future__ import annotations

import itertools
import json
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window, functions as F

from stayledger.config import SEED
from stayledger.operators import boost, forest
from stayledger.operators.metrics import discrimination_metrics
from stayledger.operators.prep import TabularPreprocessor
from stayledger.session import stable

SCORE = "predicted_probability"
WEIGHT = "_class_weight"


# --- class weights ----------------------------------------------------------------------


def class_ratio(df: DataFrame, *, target: str) -> DataFrame:
    """One row: negatives, positives and their ratio (NULL without positives)."""
    return df.agg(
        F.count_if(F.col(target) == 0).alias("n_neg"),
        F.count_if(F.col(target) == 1).alias("n_pos"),
    ).withColumn(
        "scale_pos_weight", F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos"))
    )


def scale_pos_weight(df: DataFrame, *, target: str) -> float:
    ratio = class_ratio(df, target=target).first()["scale_pos_weight"]
    if ratio is None:
        raise ValueError("training target contains zero positive cases")
    return ratio


def class_weights(df: DataFrame, *, target: str) -> DataFrame:
    """(class, n, balanced weight = total / (classes x n))."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    everyone = Window.partitionBy(F.lit(0))  # one row per class
    return counts.select(
        target,
        "n",
        (
            F.sum("n").over(everyone) / (F.count("*").over(everyone) * F.col("n"))
        ).alias("class_weight"),
    )


class ClassWeights(
    Estimator, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Learns one weight per class from the rows it is fitted on.

    ``mode``: balanced, none, or positive (positives weigh ``positiveWeight``, or
    negatives / positives when that is 0).
    """

    mode = Param(Params._dummy(), "mode", "weighting", TypeConverters.toString)
    positiveWeight = Param(
        Params._dummy(), "positiveWeight", "fixed weight", TypeConverters.toFloat
    )

    @keyword_only
    def __init__(
        self, *, labelCol="label", weightCol=WEIGHT, mode="balanced", positiveWeight=0.0
    ):
        super().__init__()
        self._setDefault(
            labelCol="label", weightCol=WEIGHT, mode="balanced", positiveWeight=0.0
        )
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ClassWeightsModel:
        label, mode = self.getOrDefault("labelCol"), self.getOrDefault("mode")
        weights = {"0": 1.0, "1": 1.0}
        if mode == "balanced":
            rows = class_weights(df, target=label).collect()
            weights = {str(int(r[label])): r["class_weight"] for r in rows}
        elif mode == "positive":
            fixed = self.getOrDefault("positiveWeight")
            weights["1"] = fixed or scale_pos_weight(df, target=label)
        elif mode != "none":
            raise ValueError("mode must be balanced, positive or none")
        return ClassWeightsModel(
            labelCol=label,
            weightCol=self.getOrDefault("weightCol"),
            weights=json.dumps(weights),
        )


class ClassWeightsModel(
    Model, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable
):
    weights = Param(Params._dummy(), "weights", "weights as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol="label", weightCol=WEIGHT, weights="{}"):
        super().__init__()
        self._setDefault(labelCol="label", weightCol=WEIGHT, weights="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        label = self.getOrDefault("labelCol")
        if label not in df.columns:  # rows to score carry no outcome
            return df
        learned = json.loads(self.getOrDefault("weights"))
        weight = F.when(F.col(label) == 1, learned.get("1", 1.0)).otherwise(
            learned.get("0", 1.0)
        )
        return df.withColumn(self.getOrDefault("weightCol"), weight)


class SummedLossLogistic(
    Estimator,
    HasLabelCol,
    HasFeaturesCol,
    HasWeightCol,
    DefaultParamsReadable,
    DefaultParamsWritable,
):
    """L2 logistic regression with objective C * (summed weighted loss) + |b|^2 / 2.

    Spark minimises the mean weighted loss, so the equal penalty is
    1 / (C * sum of weights), known only once the training rows are.
    """

    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        labelCol="label",
        featuresCol="features",
        weightCol=WEIGHT,
        C=1.0,
        maxIter=2000,
    ):
        super().__init__()
        self._setDefault(
            labelCol="label",
            featuresCol="features",
            weightCol=WEIGHT,
            C=1.0,
            maxIter=2000,
        )
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        weight = self.getOrDefault("weightCol")
        total = df.agg(F.sum(weight)).first()[0]
        return LogisticRegression(
            labelCol=self.getOrDefault("labelCol"),
            featuresCol=self.getOrDefault("featuresCol"),
            weightCol=weight,
            maxIter=self.getOrDefault("maxIter"),
            regParam=1.0 / (self.getOrDefault("C") * total),
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-8,
        ).fit(df)


# --- pipelines ------------------------------------------------------------------------------


def build_logistic_model(
    preprocessor: TabularPreprocessor,
    *,
    target: str,
    max_iter: int = 2000,
    class_weight: str | None = "balanced",
    C: float = 1.0,
) -> Pipeline:
    return Pipeline(
        stages=[
            preprocessor.copy(),
            ClassWeights(labelCol=target, mode=class_weight or "none"),
            SummedLossLogistic(labelCol=target, C=C, maxIter=max_iter),
        ]
    )


def build_random_forest(
    preprocessor: TabularPreprocessor,
    *,
    target: str,
    n_estimators: int = 500,
    max_depth: int | None = 8,
    min_samples_leaf: int = 5,
    max_features: str | float = "sqrt",
    class_weight: str | None = "balanced",
    max_bins: int = forest.MAX_BINS,
    seed: int = SEED,
) -> Pipeline:
    """Random forest; a number is split at one of at most ``max_bins - 1`` of its values."""
    settings = forest.Settings(
        n_estimators=n_estimators,
        max_depth=max_depth,
        min_samples_leaf=min_samples_leaf,
        max_features=max_features,
        seed=seed,
    )
    trees = forest.BinnedForest(
        labelCol=target,
        weightCol=WEIGHT,
        settings=json.dumps(settings._asdict()),
        maxBins=max_bins,
    )
    weights = ClassWeights(labelCol=target, mode=class_weight or "none")
    return Pipeline(stages=[preprocessor.copy(), weights, trees])


def build_boosted_trees(
    preprocessor: TabularPreprocessor,
    *,
    target: str,
    positive_weight: float = 1.0,
    n_estimators: int = 500,
    learning_rate: float = 0.03,
    max_depth: int = 4,
    min_child_weight: float = 5,
    subsample: float = 0.8,
    colsample_bytree: float = 0.8,
    reg_lambda: float = 1.0,
    max_bins: int = boost.MAX_BINS,
    seed: int = SEED,
) -> Pipeline:
    """Second-order boosted trees with logistic loss (see ``boost``).

    ``positive_weight`` 0 means negatives / positives of the rows fitted on.
    """
    settings = boost.Settings(
        n_estimators=n_estimators,
        learning_rate=learning_rate,
        max_depth=max_depth,
        min_child_weight=min_child_weight,
        subsample=subsample,
        colsample_bytree=colsample_bytree,
        reg_lambda=reg_lambda,
        seed=seed,
    )
    boosted = boost.BoostedTrees(
        labelCol=target,
        weightCol=WEIGHT,
        settings=json.dumps(settings._asdict()),
        maxBins=max_bins,
    )
    weights = ClassWeights(
        labelCol=target, mode="positive", positiveWeight=float(positive_weight)
    )
    return Pipeline(stages=[preprocessor.copy(), weights, boosted])


def train_logistic_model(preprocessor, train: DataFrame, *, target: str, **options):
    return build_logistic_model(preprocessor, target=target, **options).fit(train)


def train_random_forest(preprocessor, train: DataFrame, *, target: str, **options):
    return build_random_forest(preprocessor, target=target, **options).fit(train)


def train_boosted_trees(
    preprocessor,
    train: DataFrame,
    *,
    target: str,
    positive_weight: float | None = None,
    **options,
):
    if positive_weight is None:
        positive_weight = scale_pos_weight(train, target=target)
    return build_boosted_trees(
        preprocessor, target=target, positive_weight=positive_weight, **options
    ).fit(train)


# --- scoring ---------------------------------------------------------------------------------


def predict_positive(
    model: PipelineModel, df: DataFrame, *, keep: Sequence[str], score: str = SCORE
) -> DataFrame:
    """Kept columns and the positive-class probability."""
    return model.transform(df).select(
        *keep, vector_to_array("probability")[1].alias(score)
    )


def prior_scores(
    train: DataFrame, df: DataFrame, *, target: str, keep: Sequence[str], score: str = SCORE
) -> DataFrame:
    """Everyone gets the training event rate (computed once, as a scalar)."""
    rate = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    return df.select(*keep, rate.alias(score))


def long_scores(
    df: DataFrame, columns: Mapping[str, str], *, keep: Sequence[str], score: str = SCORE
) -> DataFrame:
    """(keep..., model, score) from one score column per model."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(c).alias(score))
            for name, c in columns.items()
        ]
    )
    return df.select(*keep, F.inline(cells))


def wide_scores(
    long: DataFrame, models: Sequence[str], *, keep: Sequence[str], score: str = SCORE
) -> DataFrame:
    """One ``<model>_probability`` column per named model, names in snake case."""
    return long.groupBy(*keep).agg(
        *[
            F.max(F.when(F.col("model") == m, F.col(score))).alias(
                f"{m.lower().replace(' ', '_')}_probability"
            )
            for m in models
        ]
    )


def score_difference(left: DataFrame, right: DataFrame, *, key: str, score: str = SCORE) -> DataFrame:
    """One row: rows compared and the largest absolute score difference."""
    joined = left.select(key, F.col(score).alias("_a")).join(
        right.select(key, F.col(score).alias("_b")), key
    )
    return joined.agg(
        F.count("*").alias("rows_compared"),
        F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_difference"),
    )


# --- validation over grouped folds --------------------------------------------------------------


class AveragePrecisionEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Exact step-wise average precision for Spark's own tuning classes."""

    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    probabilityCol = Param(
        Params._dummy(), "probabilityCol", "probability vector", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, labelCol="label", probabilityCol="probability"):
        super().__init__()
        self._setDefault(labelCol="label", probabilityCol="probability")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(
            F.col(self.getOrDefault("labelCol")).alias("y"),
            vector_to_array(self.getOrDefault("probabilityCol"))[1].alias("p"),
        )
        row = discrimination_metrics(scored, target="y", probability="p").first()
        return float("nan") if row["auprc"] is None else row["auprc"]

    def isLargerBetter(self) -> bool:
        return True


def _settings_key(stage) -> str:
    """Stages with equal settings have equal keys."""
    return json.dumps(
        {p.name: v for p, v in stage.extractParamMap().items()}, sort_keys=True, default=str
    )


def _fold_table(preprocessor, df: DataFrame, target: str, fold: str, k: int) -> DataFrame:
    """All rows as features of a preprocessor fitted outside fold ``k``, written once."""
    fitted = preprocessor.copy().fit(df.where(F.col(fold) != k))
    output = preprocessor.getOrDefault("outputCol")
    rows = fitted.transform(df).where(F.col(fold).isNotNull())
    return stable(rows.select(F.lit(k).alias("_part"), F.col(target), (F.col(fold) == k).alias("_held"), output))


def _class_weights(stage: ClassWeights, negatives: int, positives: int) -> tuple[float, float]:
    """The weights the stage would learn from these counts."""
    mode, fixed = stage.getOrDefault("mode"), stage.getOrDefault("positiveWeight")
    total = negatives + positives
    if mode == "balanced":
        classes = (negatives > 0) + (positives > 0)
        return tuple(total / (classes * n) if n else 1.0 for n in (negatives, positives))
    if mode == "positive" and not fixed:
        if not positives:
            raise ValueError("training target contains zero positive cases")
        return 1.0, negatives / positives
    return 1.0, fixed if mode == "positive" else 1.0


def _tree_scores(stages: Mapping[str, tuple], rows: DataFrame, target: str) -> DataFrame:
    """(model, fold, y, p) of candidates of one kind, all fits as tasks of one job.

    ``rows`` are the fold tables one below the other.
    """
    _, trees = next(iter(stages.values()))
    kind, fitted = (boost, boost.BoostedTreesModel) if isinstance(trees, boost.BoostedTrees) else (forest, forest.BinnedForestModel)
    features, bins = trees.getOrDefault("featuresCol"), trees.getOrDefault("maxBins")
    # every step takes all folds in one job
    train = rows.where("not _held")
    edges = boost.part_edges(train, features, F.col("_part"), max_bins=bins)
    widths = {k: len(e) for k, e in edges.items()}
    counts = {
        r["_part"]: (r["n_neg"], r["n_pos"])
        for r in train.groupBy("_part").agg(F.count_if(F.col(target) == 0).alias("n_neg"), F.count_if(F.col(target) == 1).alias("n_pos")).collect()
    }
    key = F.monotonically_increasing_id().alias("key")
    every = stable(
        boost.binned(
            rows, features, edges, F.col("_part").alias("part"), F.col("_held").alias("held"), key, F.col(target).cast("double").alias("y")
        )
    )
    # candidates that weigh the classes alike share a job
    scored = None
    alike: dict[str, list[str]] = {}
    for name, (weights, _) in stages.items():
        alike.setdefault(_settings_key(weights), []).append(name)
    for names in alike.values():
        weights = {k: _class_weights(stages[names[0]][0], *c) for k, c in counts.items()}
        found = boost.fit_side_by_side(
            every, [stages[n][1].options() for n in names], widths, weights, kind.grow_in_task, fitted._chance, kind.effort,
            getattr(kind, "alike", None),
        )
        label = F.element_at(F.array(*map(F.lit, names)), F.col("candidate") + 1)
        found = found.select(label.alias("model"), F.col("part").alias("fold"), F.col("y").alias(target), F.col("score").alias(SCORE))
        scored = found if scored is None else scored.unionByName(found)
    return stable(scored)


def side_by_side(spark, fn, items: Sequence, parallelism: int = 4) -> list:
    """``fn`` of every item, whose Spark jobs are submitted from a few threads."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fn), items))


def fold_scores(
    pipelines: Mapping[str, Pipeline],
    df: DataFrame,
    *,
    target: str,
    n_folds: int,
    fold: str = "fold",
    parallelism: int = 4,
) -> DataFrame:
    """(model, fold, auroc, auprc); everything is refitted inside each fold.

    Preprocessing is fitted once per fold, and its output is written for all
    candidates that share it.  Tree candidates over a matrix that fits a task are
    tasks of one job.  Other fits are Spark jobs, submitted from a few threads as
    Spark's own tuning classes do.
    """
    spark = df.sparkSession
    groups: dict[str, dict[str, list]] = {}
    for name, pipeline in pipelines.items():
        first, *rest = pipeline.getStages()
        groups.setdefault(_settings_key(first), {})[name] = rest
    records = []

    def on_pool(fn, items):
        return side_by_side(spark, fn, items, parallelism)

    for names in groups.values():
        first = pipelines[next(iter(names))].getStages()[0]
        tables = on_pool(lambda k: _fold_table(first, df, target, fold, k), range(n_folds))
        output = first.getOrDefault("outputCol")
        # folds differ in width where their rows differ in categories
        wide = [t.select(F.size(vector_to_array(output)).alias("n")).first() for t in tables]
        alike_wide: dict[int, list[DataFrame]] = {}
        for table, row in zip(tables, wide):
            if row is not None:
                alike_wide.setdefault(row["n"], []).append(table)
        alike: dict[tuple, dict[str, tuple]] = {}
        for n, r in names.items():
            if isinstance(r[-1], (boost.BoostedTrees, forest.BinnedForest)):
                room = r[-1].getOrDefault("taskBytes")
                alike.setdefault((type(r[-1]), r[-1].getOrDefault("maxBins"), room), {})[n] = tuple(r)

        def together(task: tuple[dict, list[DataFrame]]) -> list[tuple]:
            stages, some = task
            scored = _tree_scores(stages, reduce(DataFrame.unionByName, some), target)
            areas = discrimination_metrics(scored, target=target, probability=SCORE, by=["model", "fold"])
            return [(r["model"], r["fold"], r["auroc"], r["auprc"]) for r in areas.collect()]

        # a kind has few fits where it has few candidates: the kinds run side by side
        jobs = [
            (stages, some)
            for (*_, room), stages in alike.items()
            if alike_wide and boost.fits_task(tables[0], max(alike_wide), room)
            for some in alike_wide.values()
        ]
        records += [r for found in on_pool(together, jobs) for r in found]
        done = {r[0] for r in records}

        def one(task: tuple[str, int]) -> tuple:
            name, k = task
            fitted = Pipeline(stages=[s.copy() for s in names[name]]).fit(tables[k].where("not _held"))
            held = predict_positive(fitted, tables[k].where("_held"), keep=[target])
            row = discrimination_metrics(held, target=target, probability=SCORE).first()
            return name, k, row["auroc"], row["auprc"]

        records += on_pool(one, [(n, k) for n in names if n not in done for k in range(n_folds)])
    return spark.createDataFrame(records, "model string, fold int, auroc double, auprc double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and sample sd over the folds of each model."""
    return scores.groupBy("model").agg(
        F.avg("auroc").alias("mean_cv_auroc"),
        F.stddev_samp("auroc").alias("sd_cv_auroc"),
        F.avg("auprc").alias("mean_cv_auprc"),
        F.stddev_samp("auprc").alias("sd_cv_auprc"),
    )


# The tuning grids.
FOREST_GRID = {
    "n_estimators": [300, 500, 800],
    "max_depth": [5, 8, 12, None],
    "min_samples_leaf": [2, 5, 10],
    "max_features": ["sqrt", "log2", 0.7],
}
BOOSTED_GRID = {
    "n_estimators": [300, 500, 800],
    "learning_rate": [0.02, 0.03, 0.05, 0.08],
    "max_depth": [2, 3, 4, 5],
    "min_child_weight": [1, 3, 5, 8],
    "subsample": [0.7, 0.8, 1.0],
    "colsample_bytree": [0.7, 0.8, 1.0],
}


def draw_candidates(grid: Mapping[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """``n`` different points of the grid, drawn without replacement."""
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(points, min(n, len(points)))


def random_search(
    build,
    preprocessor: TabularPreprocessor,
    df: DataFrame,
    *,
    target: str,
    grid: Mapping[str, Sequence],
    draws: int,
    n_folds: int,
    seed: int = SEED,
    refit: bool = True,
    **fixed,
) -> tuple[PipelineModel | None, DataFrame, dict]:
    """Draw, score every candidate over the folds by average precision, refit the best.

    Returns the refitted model, the per-fold score table and the best options.
    """
    candidates = draw_candidates(grid, draws, seed)
    pipelines = {
        json.dumps(c): build(preprocessor, target=target, **c, **fixed)
        for c in candidates
    }
    scores = fold_scores(pipelines, df, target=target, n_folds=n_folds)
    best = json.loads(search_results(scores).orderBy("rank_test_score", "params").first()["params"])
    model = build(preprocessor, target=target, **best, **fixed).fit(df) if refit else None
    return model, scores, best


def search_results(scores: DataFrame) -> DataFrame:
    """(params, per-fold scores, mean, population sd, rank) of every candidate."""
    summary = scores.groupBy(F.col("model").alias("params")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("fold", "auprc"))), lambda s: s["auprc"]
        ).alias("fold_scores"),
        F.avg("auprc").alias("mean_test_score"),
        F.stddev_pop("auprc").alias("std_test_score"),
    )
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.col("mean_test_score").desc_nulls_last())
    return summary.withColumn("rank_test_score", F.rank().over(best_first))


def logistic_coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, coefficient, odds_ratio, absolute_coefficient)."""
    names = model.stages[0].feature_names()
    values = model.stages[-1].coefficients.toArray().tolist()
    return (
        df.sparkSession.createDataFrame(
            list(zip(names, values)), "feature string, coefficient double"
        )
        .withColumn("odds_ratio", F.exp("coefficient"))
        .withColumn("absolute_coefficient", F.abs("coefficient"))
    )
