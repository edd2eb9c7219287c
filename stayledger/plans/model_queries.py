"""Models, calibration and explanations on labelled documents.

Models run with the operators' own settings, searches over the whole grids; only the
forest whose rows are explained has fewer trees.  A query fits what it needs itself; a
fit named twice inside one query is made once.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from stayledger.operators import calibrate, explain, metrics, models, prep, split
from stayledger.operators.cohort import first_child
from stayledger.plans import star
from stayledger.plans.registry import Tables, query, rounded
from stayledger.session import shared_folder, stable

TARGET = "toxic"
NUMERIC = ["n_chars", "n_words", "n_digits", "n_upper", "quality"]
CATEGORICAL = ["lang"]
FOREST_DRAWS, BOOSTED_DRAWS = 12, 16
EXPLAINED_TREES = 100


def kept(fn):
    """Remember a fit for the run of one query, which has its own ``Tables``."""

    @wraps(fn)
    def run(t: Tables):
        made = vars(t).setdefault("_made", {})
        if fn.__name__ not in made:
            made[fn.__name__] = fn(t)
        return made[fn.__name__]

    return run


@kept
def _rows(t: Tables) -> DataFrame:
    """Modelling rows with their split, assigned by source."""
    rows = star.document_rows(t)
    sources = rows.groupBy("source").agg(F.max(TARGET).alias("entity_outcome"))
    return stable(
        split.split_rows(
            rows, split.assign_splits(sources, entity="source"), entity="source"
        )
    )


def _train(t: Tables) -> DataFrame:
    return _rows(t).where(F.col("split") == "train")


@kept
def _folds(t: Tables) -> tuple[DataFrame, int]:
    """Training rows with folds of whole sources, even in rows and outcomes."""
    train = _train(t)
    n = split.fold_count(train, target=TARGET)
    folds = split.balanced_folds(train, entity="source", target=TARGET, n_folds=n)
    return stable(train.join(folds.select("source", "fold"), "source")), n


def _stage() -> prep.TabularPreprocessor:
    return prep.build_preprocessor(NUMERIC, CATEGORICAL)


@kept
def _logistic(t: Tables) -> PipelineModel:
    return models.train_logistic_model(_stage(), _train(t), target=TARGET)


@kept
def _forest(t: Tables) -> PipelineModel:
    return models.train_random_forest(_stage(), _train(t), target=TARGET)


@kept
def _boosted(t: Tables) -> PipelineModel:
    return models.train_boosted_trees(_stage(), _train(t), target=TARGET)


KEEP = ["doc_id", "split", TARGET]


@query()
def logistic_scores(t):
    return models.predict_positive(_logistic(t), _rows(t), keep=KEEP)


@query()
def random_forest_scores(t):
    return models.predict_positive(_forest(t), _rows(t), keep=KEEP)


@query()
def boosted_scores(t):
    return models.predict_positive(_boosted(t), _rows(t), keep=KEEP)


@query()
def logistic_coefficients(t):
    return models.logistic_coefficients(_logistic(t), _rows(t))


@query()
def validation_comparison(t):
    """The fitted models' records on validation rows, best first."""
    rows = _rows(t).where(F.col("split") == "validation")
    # the boosted rounds are one task after the other: the other fits run beside them
    named = {
        "Boosted Trees": _boosted,
        "Random Forest": _forest,
        "Logistic Regression": _logistic,
    }
    fitted = models.side_by_side(t.spark, lambda fit: fit(t), list(named.values()))
    parts = [
        models.predict_positive(m, rows, keep=KEEP).withColumn("model", F.lit(name))
        for name, m in zip(named, fitted)
    ]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return metrics.compare_models(
        long, model="model", target=TARGET, probability=models.SCORE
    )


# --- validation over folds -------------------------------------------------------------


@kept
def _cv(t: Tables) -> DataFrame:
    rows, n = _folds(t)
    return models.fold_scores(
        {
            "Random Forest": models.build_random_forest(_stage(), target=TARGET),
            "Boosted Trees": models.build_boosted_trees(
                _stage(), target=TARGET, positive_weight=0.0
            ),
        },
        rows,
        target=TARGET,
        n_folds=n,
    )


@query()
def grouped_cv(t):
    """AUROC and AP per fold; preprocessing and weights refit inside each fold."""
    return _cv(t)


@query()
def cv_summary(t):
    return models.cv_summary(_cv(t))


def _search(t: Tables, build, grid, draws: int, refit: bool = True, **fixed):
    rows, n = _folds(t)
    return models.random_search(
        build, _stage(), rows, target=TARGET, grid=grid, draws=draws, n_folds=n, refit=refit, **fixed
    )


@query()
def tune_random_forest(t):
    """Scores of the model refitted with the best drawn options."""
    best, _, _ = _search(t, models.build_random_forest, models.FOREST_GRID, FOREST_DRAWS)
    return models.predict_positive(best, _rows(t), keep=KEEP)


@query()
def search_results(t):
    """Options, score per fold, mean, population sd and rank of both searches."""
    searches = (
        ("Random Forest", models.build_random_forest, models.FOREST_GRID, FOREST_DRAWS, {}),
        ("Boosted Trees", models.build_boosted_trees, models.BOOSTED_GRID, BOOSTED_DRAWS, {"positive_weight": 0.0}),
    )
    tables = []
    for name, build, grid, draws, fixed in searches:
        _, scores, _ = _search(t, build, grid, draws, refit=False, **fixed)
        tables.append(models.search_results(scores).withColumn("model", F.lit(name)))
    return tables[0].unionByName(tables[1])


@query()
def tune_boosted(t):
    best, _, _ = _search(
        t, models.build_boosted_trees, models.BOOSTED_GRID, BOOSTED_DRAWS, positive_weight=0.0
    )
    return models.predict_positive(best, _rows(t), keep=KEEP)


# One round of depth 1, said in SQL: the sums behind every cut and leaf.
_STUMP_FEATURES = {
    "words": "cast(least(floor(n_words / 8), 200) as double)",
    "digits": "least(n_digits, 60d)",
    "upper": "cast(least(floor(n_upper / 2), 120) as double)",
    "quality": "quality",
}
_STUMP_SQL = r"""counted AS (SELECT CAST(toxic AS INTEGER) AS y,
   len(string_split_regex(text, '\s+')) AS n_words, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
   length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, quality FROM documents JOIN labels USING (doc_id)),
 long AS (SELECT y, unnest([0, 1, 2, 3]) AS place, unnest([least(floor(n_words / 8), 200), least(n_digits, 60), least(floor(n_upper / 2), 120), quality]) AS x FROM counted),
 balance AS (SELECT sum(1 - y) / CAST(sum(y) AS DOUBLE) AS w FROM counted),
 cells AS (SELECT place, x, sum(CASE WHEN y = 1 THEN -w / 2 ELSE 0.5 END) AS g, sum(CASE WHEN y = 1 THEN w / 4 ELSE 0.25 END) AS h FROM long, balance GROUP BY 1, 2),
 run AS (SELECT place, x, sum(g) OVER (PARTITION BY place ORDER BY x) AS gl, sum(h) OVER (PARTITION BY place ORDER BY x) AS hl,
   sum(g) OVER (PARTITION BY place) AS g, sum(h) OVER (PARTITION BY place) AS h FROM cells),
 cuts AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM run WHERE hl >= 5 AND h - hl >= 5)"""


@query(
    f"""WITH {_STUMP_SQL} SELECT ['words', 'digits', 'upper', 'quality'][place + 1] AS feature, CAST(x AS DOUBLE) AS threshold, round(gain, 6) AS gain,
 round(h, 6) AS cover, round(-gl / (hl + 1), 6) AS left_value, round(-(g - gl) / (h - hl + 1), 6) AS right_value
 FROM cuts ORDER BY cuts.gain DESC, place, x LIMIT 1"""
)
def boosted_stump(t):
    """The one cut of a single boosted round of depth 1, found level by level."""
    # written once: every step of the fit reads these rows, none the texts again
    rows = stable(
        star.document_rows(t).select(
            TARGET, *[F.expr(c).alias(name) for name, c in _STUMP_FEATURES.items()]
        )
    )
    stage = prep.build_preprocessor(
        list(_STUMP_FEATURES), [], add_numeric_missing_indicators=False, scale_numeric_features=False
    )
    pipeline = models.build_boosted_trees(
        stage, target=TARGET, positive_weight=0.0, n_estimators=1, learning_rate=1.0, max_depth=1, subsample=1.0, colsample_bytree=1.0
    )
    pipeline.getStages()[-1]._set(taskBytes=1)
    nodes = pipeline.fit(rows).stages[-1].nodes()
    root = nodes[0]
    found = [(list(_STUMP_FEATURES)[root[2]], root[3], root[7], root[8], nodes[root[4]][6], nodes[root[5]][6])]
    return rounded(
        t.spark.createDataFrame(
            found,
            "feature string, threshold double, gain double, cover double, left_value double, right_value double",
        )
    )


@query(
    """SELECT count(*) AS rows_compared, CAST(0 AS DOUBLE) AS max_difference
 FROM documents JOIN labels USING (doc_id)"""
)
def model_roundtrip(t):
    """A saved and reloaded pipeline gives the same scores."""
    path = f"{shared_folder(t.spark)}/model-{uuid.uuid4().hex}"
    _forest(t).write().overwrite().save(path)
    again = PipelineModel.load(path)
    return rounded(
        models.score_difference(
            models.predict_positive(_forest(t), _rows(t), keep=["doc_id"]),
            models.predict_positive(again, _rows(t), keep=["doc_id"]),
            key="doc_id",
        ),
        9,
    )


# --- calibration -------------------------------------------------------------------------


@query(
    f"""WITH RECURSIVE {star.SCORED_ORDERS_SQL}, g AS (SELECT p, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM scored GROUP BY p),
 n AS (SELECT (sum(pos) + 1) / (sum(pos) + 2) AS hi, 1 / (sum(neg) + 2) AS lo FROM g),
 w AS (SELECT p, pos + neg AS w, pos * hi + neg * lo AS t FROM g, n),
 newton(step, a, b) AS (
  SELECT 0, CAST(0 AS DOUBLE), ln(sum(t) / (sum(w) - sum(t))) FROM w
  UNION ALL
  SELECT step + 1, a + (h00 * g1 - h01 * g0) / (h11 * h00 - h01 * h01), b + (h11 * g0 - h01 * g1) / (h11 * h00 - h01 * h01)
  FROM (SELECT step, a, b, sum((t - w * m) * p) AS g1, sum(t - w * m) AS g0,
               sum(w * m * (1 - m) * p * p) AS h11, sum(w * m * (1 - m) * p) AS h01, sum(w * m * (1 - m)) AS h00
        FROM (SELECT step, a, b, p, w, t, 1 / (1 + exp(-(a * p + b))) AS m FROM newton, w WHERE step < 30) q
        GROUP BY step, a, b) r)
 SELECT stay_id, y, p, round(1 / (1 + exp(-(a * p + b))), 5) AS calibrated
 FROM scored, (SELECT a, b FROM newton WHERE step = 30) f"""
)
def sigmoid_calibration(t):
    scored = star.scored_orders(t)
    fitted = calibrate.fit_calibrator(scored, method="sigmoid", score="p", target="y")
    return fitted.apply(scored, score="p", out="calibrated").select(
        "stay_id", "y", "p", F.round("calibrated", 5).alias("calibrated")
    )


@query(
    f"""WITH {star.SCORED_ORDERS_SQL}, g AS (SELECT p, sum(y) AS s, count(*) AS n FROM scored GROUP BY p),
 c AS (SELECT p, row_number() OVER (ORDER BY p) AS i, sum(s) OVER (ORDER BY p) AS cs, sum(n) OVER (ORDER BY p) AS cn,
       s, n FROM g),
 blocks AS (SELECT a.i AS j, b.i AS k, (b.cs - a.cs + a.s) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m
       FROM c a JOIN c b ON a.i <= b.i),
 lows AS (SELECT x.i, q.j, min(q.m) AS m FROM c x JOIN blocks q ON q.j <= x.i AND q.k >= x.i GROUP BY 1, 2),
 fit AS (SELECT i, max(m) AS v FROM lows GROUP BY 1)
 SELECT stay_id, y, p, round(v, 6) AS calibrated FROM scored JOIN c USING (p) JOIN fit USING (i)"""
)
def isotonic_calibration(t):
    scored = star.scored_orders(t)
    fitted = calibrate.fit_calibrator(scored, method="isotonic", score="p", target="y")
    return rounded(
        fitted.apply(scored, score="p", out="calibrated").select(
            "stay_id", "y", "p", "calibrated"
        )
    )


# --- explanations ----------------------------------------------------------------------------


@kept
def _explained(t: Tables) -> PipelineModel:
    return models.train_random_forest(
        _stage(), _train(t), target=TARGET, n_estimators=EXPLAINED_TREES
    )


def _transformed(t: Tables) -> DataFrame:
    return _explained(t).stages[0].transform(_rows(t))


@kept
def _contributions(t: Tables) -> DataFrame:
    model = _explained(t)
    return stable(
        explain.tree_shap(
            model.stages[-1],
            _transformed(t),
            row_id="doc_id",
            feature_names=model.stages[0].feature_names(),
        )
    )


@kept
def _base(t: Tables) -> DataFrame:
    return explain.base_value(explain.node_table(t.spark, _explained(t).stages[-1]))


@query()
def tree_shap(t):
    """Exact contributions of every feature to every row's forest probability."""
    return _contributions(t)


@query()
def shap_base_value(t):
    return _base(t)


@query(
    """SELECT count(*) AS rows_explained, CAST(0 AS BIGINT) AS rows_incomplete, CAST(0 AS BIGINT) AS missing_values
 FROM documents JOIN labels USING (doc_id)"""
)
def shap_completeness(t):
    return explain.shap_completeness(
        _contributions(t),
        row_id="doc_id",
        n_features=len(_explained(t).stages[0].feature_names()),
    )


@query(
    """SELECT count(*) AS rows_compared, CAST(0 AS DOUBLE) AS max_additivity_error
 FROM documents JOIN labels USING (doc_id)"""
)
def shap_additivity(t):
    """Base value plus contributions reproduces the probability."""
    scores = models.predict_positive(_explained(t), _rows(t), keep=["doc_id"])
    return rounded(
        explain.shap_additivity(
            _contributions(t), scores, _base(t), row_id="doc_id", score=models.SCORE
        ),
        9,
    )


@query()
def global_shap_importance(t):
    return explain.global_importance(_contributions(t))


def _builtin(t: Tables, model: PipelineModel) -> DataFrame:
    return explain.builtin_importance(
        t.spark, model.stages[-1], model.stages[0].feature_names()
    )


@query()
def builtin_importance(t):
    """Impurity importance of the forest and of the boosted model."""
    forest = _builtin(t, _explained(t)).withColumn("model", F.lit("forest"))
    boosted = _builtin(t, _boosted(t)).withColumn("model", F.lit("boosted"))
    return forest.unionByName(boosted)


@query()
def importance_comparison(t):
    return explain.compare_importance(
        explain.global_importance(_contributions(t)), _builtin(t, _explained(t))
    )


@query()
def local_shap_top(t):
    """Contributions of one representative case per error category."""
    scored = models.predict_positive(_explained(t), _rows(t), keep=KEEP)
    labelled = metrics.error_categories(scored, target=TARGET, probability=models.SCORE)
    cases = metrics.representative_cases(
        labelled, probability=models.SCORE, row_id="doc_id"
    )
    return explain.local_explanations(
        _contributions(t),
        cases,
        row_id="doc_id",
        keep=["prediction_category", TARGET, models.SCORE],
    )


@query()
def shap_dependence(t):
    contributions = _contributions(t)
    return explain.dependence_points(
        contributions, explain.global_importance(contributions)
    )


@query()
def shap_summary_points(t):
    contributions = _contributions(t)
    return explain.summary_points(
        contributions, explain.global_importance(contributions), top=20
    )


# The same views over a contribution table derived from events, checked by SQL.

CONTRIBUTIONS_SQL = """contributions AS (
  SELECT event_id AS row_id, feature, round(v, 9) AS shap_value FROM (
    SELECT event_id, 'numeric__value' AS feature, (value - 50) / 100 AS v FROM events
    UNION ALL SELECT event_id, 'numeric__hour', (hour(ts) - 12) / CAST(24 AS DOUBLE) FROM events
    UNION ALL SELECT event_id, 'numeric__missingindicator_value', CASE WHEN event_id % 17 = 0 THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END FROM events
    UNION ALL SELECT event_id, 'categorical__event_type_view', CASE WHEN event_type = 'view' THEN CAST(0.2 AS DOUBLE) ELSE CAST(-0.05 AS DOUBLE) END FROM events)),
importance AS (SELECT feature, avg(abs(shap_value)) AS m,
  row_number() OVER (ORDER BY avg(abs(shap_value)) DESC, feature) AS importance_rank FROM contributions GROUP BY 1)"""


def _event_contributions(t: Tables) -> DataFrame:
    cells = {
        "numeric__value": (F.col("value") - 50) / 100,
        "numeric__hour": (F.hour("ts") - 12) / 24.0,
        "numeric__missingindicator_value": F.when(
            F.col("event_id") % 17 == 0, 0.9
        ).otherwise(0.6),
        "categorical__event_type_view": F.when(
            F.col("event_type") == "view", 0.2
        ).otherwise(-0.05),
    }
    return t.events.select(
        F.col("event_id").alias("row_id"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature"), F.round(v, 9).alias("shap_value")
                    )
                    for name, v in cells.items()
                ]
            )
        ),
    )


@query(
    f"WITH {CONTRIBUTIONS_SQL} SELECT feature, round(m, 6) AS mean_absolute_shap, "
    "CAST(importance_rank AS INTEGER) AS importance_rank FROM importance"
)
def importance_of_contributions(t):
    return rounded(explain.global_importance(_event_contributions(t)))


@query(
    f"""WITH {CONTRIBUTIONS_SQL}, cases AS (SELECT event_id AS row_id FROM (SELECT event_id, row_number() OVER (
   PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1)
 SELECT row_id, feature, shap_value, abs(shap_value) AS absolute_shap_value,
 CASE WHEN shap_value > 0 THEN 'increased predicted risk' WHEN shap_value < 0 THEN 'decreased predicted risk'
      ELSE 'no effect' END AS direction,
 CAST(row_number() OVER (PARTITION BY row_id ORDER BY abs(shap_value) DESC, feature) AS INTEGER) AS contribution_rank
 FROM contributions JOIN cases USING (row_id)"""
)
def local_contributions(t):
    cases = first_child(
        t.events, parent="event_type", order=[F.col("value").desc(), "event_id"]
    ).select(F.col("event_id").alias("row_id"))
    return explain.local_explanations(_event_contributions(t), cases, row_id="row_id")


@query(
    f"""WITH {CONTRIBUTIONS_SQL} SELECT row_id, feature, shap_value FROM contributions
 WHERE feature IN ('numeric__value', 'numeric__hour')"""
)
def dependence_of_contributions(t):
    contributions = _event_contributions(t)
    return explain.dependence_points(
        contributions, explain.global_importance(contributions)
    ).select("row_id", "feature", "shap_value")


@query(
    f"""WITH {CONTRIBUTIONS_SQL} SELECT row_id, feature, shap_value FROM contributions
 WHERE feature IN (SELECT feature FROM importance WHERE importance_rank <= 20)"""
)
def summary_of_contributions(t):
    contributions = _event_contributions(t)
    return explain.summary_points(
        contributions, explain.global_importance(contributions), top=20
    ).select("row_id", "feature", "shap_value")
