"""Splits, preprocessing and metrics on the star schema."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayledger.config import (
    DEFAULT_THRESHOLDS,
    REVIEW_CAPACITIES,
    REVIEW_CONTEXT,
)
from stayledger.functions import age_band, knuth_hash
from stayledger.operators import categories, ledger, metrics, models, prep, scale, split
from stayledger.plans import star
from stayledger.plans.registry import query, rounded
from stayledger.session import shared_folder, stable
from stayledger.sources import tables

# --- entity splits -----------------------------------------------------------------------


def _outcomes(t):
    return split.entity_outcomes(
        star.admissions(t),
        entity="subject_id",
        admission="hadm_id",
        target="hospital_expire_flag",
    )


def _assignment(t):
    return split.assign_splits(
        _outcomes(t), entity="subject_id", order_hash=knuth_hash(F.col("subject_id"))
    )


def _assigned(t):
    return split.split_rows(star.admissions(t), _assignment(t), entity="subject_id")


def _quota_sql(source: str, fraction: str) -> str:
    """(entity_outcome, quota): whole shares, then the largest remainders."""
    return f"""SELECT entity_outcome, whole + CASE WHEN row_number() OVER (ORDER BY share - whole DESC, entity_outcome)
      <= wanted - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM (
      SELECT entity_outcome, wanted, wanted * n / CAST(total AS DOUBLE) AS share,
             floor(wanted * n / CAST(total AS DOUBLE)) AS whole FROM (
        SELECT entity_outcome, n, sum(n) OVER () AS total, ceil({fraction} * sum(n) OVER ()) AS wanted FROM (
          SELECT entity_outcome, count(*) AS n FROM {source} GROUP BY 1)))"""


OUTCOMES_SQL = f"""{star.ADMISSIONS_SQL},
outcomes AS (
  SELECT subject_id, max(hospital_expire_flag) AS entity_outcome, count(DISTINCT hadm_id) AS n_admissions,
         (subject_id % 2147483648) * 2654435761 % 4294967296 AS h
  FROM admissions GROUP BY 1)"""

SPLIT_SQL = f"""{OUTCOMES_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_outcome ORDER BY h, subject_id) AS r FROM outcomes),
quota1 AS ({_quota_sql('outcomes', 'CAST(0.3 AS DOUBLE)')}),
held AS (SELECT ranked.* FROM ranked JOIN quota1 USING (entity_outcome) WHERE r <= quota),
quota2 AS ({_quota_sql('held', 'CAST(0.5 AS DOUBLE)')}),
assignment AS (
  SELECT o.subject_id, o.entity_outcome,
         CASE WHEN h2.subject_id IS NULL THEN 'train' WHEN h2.r <= q.quota THEN 'test' ELSE 'validation' END AS split
  FROM outcomes o LEFT JOIN held h2 ON h2.subject_id = o.subject_id
  LEFT JOIN quota2 q ON q.entity_outcome = o.entity_outcome)"""


@query(f"WITH {OUTCOMES_SQL} SELECT subject_id, entity_outcome, n_admissions FROM outcomes")
def patient_outcomes(t):
    return _outcomes(t)


@query(
    f"""WITH {OUTCOMES_SQL} SELECT entity_outcome, count(*) AS n,
 round(count(*) / CAST((SELECT count(*) FROM outcomes) AS DOUBLE), 6) AS proportion FROM outcomes GROUP BY 1"""
)
def outcome_proportions(t):
    return rounded(split.outcome_proportions(_outcomes(t)))


@query(
    f"""WITH {OUTCOMES_SQL}, c AS (SELECT entity_outcome, count(*) AS n FROM outcomes GROUP BY 1)
 SELECT count(*) AS n_classes, min(n) AS smallest_class, count(*) > 1 AND min(n) >= 2 AS can_stratify FROM c"""
)
def can_stratify(t):
    return split.can_stratify(_outcomes(t), outcome="entity_outcome")


@query(f"WITH {SPLIT_SQL} SELECT subject_id, entity_outcome, split FROM assignment")
def patient_split(t):
    """70/15/15 by patient, stratified by the patient's worst outcome."""
    return _assignment(t)


@query(
    f"WITH {SPLIT_SQL} SELECT a.subject_id, a.hadm_id, s.split FROM admissions a JOIN assignment s USING (subject_id)"
)
def split_rows(t):
    return _assigned(t).select("subject_id", "hadm_id", "split")


@query(
    f"""WITH {SPLIT_SQL} SELECT a.subject_id, a.hadm_id, a.hospital_expire_flag
 FROM admissions a JOIN assignment s USING (subject_id) WHERE s.split = 'validation'"""
)
def load_split(t):
    """Splits are stored one folder each; loading by alias prunes the others."""
    path = f"{shared_folder(t.spark)}/splits-{uuid.uuid4().hex}"
    tables.write_splits(
        _assigned(t).select("subject_id", "hadm_id", "hospital_expire_flag", "split"), path
    )
    return tables.load_split(t.spark, path, " Valid ")


@query(
    f"""WITH {SPLIT_SQL} SELECT s.split, count(*) AS rows, count(DISTINCT a.subject_id) AS unique_patients,
 count(DISTINCT a.hadm_id) AS unique_admissions, count(*) FILTER (hospital_expire_flag = 1) AS deaths,
 count(*) FILTER (hospital_expire_flag = 0) AS survivors, round(avg(hospital_expire_flag), 4) AS mortality_rate
 FROM admissions a JOIN assignment s USING (subject_id) GROUP BY 1"""
)
def split_summary(t):
    return split.split_summary(
        _assigned(t), entity="subject_id", admission="hadm_id", target="hospital_expire_flag"
    )


@query(
    f"""WITH {SPLIT_SQL} SELECT s.split, count(*) FILTER (hospital_expire_flag = 0) AS survived,
 count(*) FILTER (hospital_expire_flag = 1) AS died
 FROM admissions a JOIN assignment s USING (subject_id) GROUP BY 1"""
)
def split_crosstab(t):
    return split.split_crosstab(_assigned(t), target="hospital_expire_flag")


@query(
    f"""WITH {OUTCOMES_SQL} SELECT subject_id, entity_outcome,
 CAST((row_number() OVER (PARTITION BY entity_outcome ORDER BY h, subject_id) - 1) % 5 AS INTEGER) AS fold FROM outcomes"""
)
def group_folds(t):
    rows = star.admissions(t)
    return split.group_folds(
        rows,
        entity="subject_id",
        target="hospital_expire_flag",
        n_folds=split.fold_count(rows, target="hospital_expire_flag"),
        order_hash=knuth_hash(F.col("subject_id")),
    )


_SHORTEST = "CASE WHEN q.positives > 0 THEN list_transform(range(5), lambda i: p[i + 1] * 1000000000 + r[i + 1]) ELSE r END"


@query(
    f"""WITH RECURSIVE {OUTCOMES_SQL}, e AS (SELECT o.subject_id, o.entity_outcome, o.h, count(*) AS rows,
   count(*) FILTER (a.hospital_expire_flag = 1) AS positives
   FROM outcomes o JOIN admissions a USING (subject_id) GROUP BY ALL),
 q AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY positives DESC, rows DESC, h, subject_id) AS i FROM e),
 deal AS (SELECT CAST(0 AS BIGINT) AS i, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS r, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS p, CAST(0 AS BIGINT) AS k
   UNION ALL SELECT i, list_transform(range(5), lambda j: r[j + 1] + CASE WHEN j + 1 = k THEN rows ELSE 0 END),
     list_transform(range(5), lambda j: p[j + 1] + CASE WHEN j + 1 = k THEN positives ELSE 0 END), k
   FROM (SELECT q.i, q.rows, q.positives, r, p, list_position({_SHORTEST}, list_min({_SHORTEST})) AS k
     FROM deal JOIN q ON q.i = deal.i + 1))
 SELECT subject_id, entity_outcome, rows, positives, CAST(k - 1 AS INTEGER) AS fold FROM q JOIN deal USING (i)"""
)
def balanced_group_folds(t):
    """Whole entities in folds even in rows and positives (up to 4096 of a kind, as the SQL says it)."""
    rows = star.admissions(t)
    return split.balanced_folds(
        rows,
        entity="subject_id",
        target="hospital_expire_flag",
        n_folds=split.fold_count(rows, target="hospital_expire_flag"),
        order_hash=knuth_hash(F.col("subject_id")),
    )


# --- preprocessing, fitted on training rows only --------------------------------------------

NUMERIC = ["price", "load", "month"]
CATEGORICAL = ["priority", "status"]


def _fitted(t, **options):
    rows = star.prep_rows(t)
    stage = prep.build_preprocessor(NUMERIC, CATEGORICAL, **options)
    return prep.fit_preprocessor(stage, rows.where("is_train")), rows


FILLS_SQL = f"""{star.PREP_SQL},
fills AS (SELECT median(price) AS price, median(load) AS load, median(month) AS month,
  (SELECT priority FROM rows_ WHERE is_train AND priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS priority,
  (SELECT status FROM rows_ WHERE is_train AND status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS status
  FROM rows_ WHERE is_train),
filled AS (SELECT row_id, is_train, {", ".join(f"coalesce(r.{c}, f.{c}) AS {c}" for c in NUMERIC + CATEGORICAL)},
  {", ".join(f"CAST(r.{c} IS NULL AS DOUBLE) AS gone_{c}" for c in NUMERIC)}
  FROM rows_ r, fills f)"""


@query(
    f"WITH {FILLS_SQL} SELECT row_id, "
    + ", ".join(f"round({c}, 6) AS numeric__{c}" for c in NUMERIC)
    + " FROM filled"
)
def impute_median(t):
    model, rows = _fitted(
        t, scale_numeric_features=False, add_numeric_missing_indicators=False
    )
    named = model.named(rows, ["row_id"])
    return rounded(named.select("row_id", *[f"numeric__{c}" for c in NUMERIC]))


@query(
    f"WITH {FILLS_SQL} SELECT row_id, gone_price AS numeric__missingindicator_price, "
    "gone_load AS numeric__missingindicator_load FROM filled"
)
def missing_indicators(t):
    """Flags exist only for columns with gaps among the training rows."""
    model, rows = _fitted(t, scale_numeric_features=False)
    named = model.named(rows, ["row_id"])
    flags = [c for c in named.columns if "missingindicator" in c]
    return named.select("row_id", *flags)


def _centred(c: str) -> str:
    mean = f"(SELECT avg({c}) FROM filled WHERE is_train)"
    sd = f"(SELECT stddev_pop({c}) FROM filled WHERE is_train)"
    return f"({c} - {mean}) / {sd}"


def _scaled(c: str, out: str) -> str:
    return f"round({_centred(c)}, 6) AS {out}"


@query(
    f"WITH {FILLS_SQL} SELECT row_id, "
    + ", ".join(
        [_scaled(c, f"numeric__{c}") for c in NUMERIC]
        + [
            _scaled(f"gone_{c}", f"numeric__missingindicator_{c}")
            for c in ("price", "load")
        ]
    )
    + " FROM filled"
)
def standardize(t):
    """Filled values and flags, both centred and divided by the population sd."""
    model, rows = _fitted(t)
    named = model.named(rows, ["row_id"])
    return rounded(
        named.select("row_id", *[c for c in named.columns if c.startswith("numeric__")])
    )


@query(
    f"WITH {FILLS_SQL} SELECT row_id, priority AS filled_priority, status AS filled_status FROM filled"
)
def impute_mode(t):
    model, rows = _fitted(t)
    fills = {f["column"]: f["fill"] for f in model.fitted["categorical"]}
    return rows.select(
        "row_id",
        *[
            F.coalesce(F.col(c), F.lit(fill)).alias(f"filled_{c}")
            for c, fill in fills.items()
        ],
    )


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    f"WITH {FILLS_SQL} SELECT row_id, "
    + ", ".join(
        [
            f"CAST(priority = '{v}' AS DOUBLE) AS \"categorical__priority_{v}\""
            for v in _PRIORITIES
        ]
        + [f"CAST(status = '{v}' AS DOUBLE) AS categorical__status_{v}" for v in "FOP"]
    )
    + " FROM filled"
)
def one_hot(t):
    model, rows = _fitted(t)
    named = model.named(rows, ["row_id"])
    return named.select(
        "row_id", *[F.col(f"`{c}`") for c in named.columns if c.startswith("categorical__")]
    )


@query(f"WITH {star.PART_SQL} SELECT column_name, value, idx FROM dictionary")
def category_dictionary(t):
    """Numbered categories of the training rows, in code-point order."""
    rows = star.part_rows(t)
    return categories.category_dictionary(rows.where("is_train"), ["part", "flag"])


@query(
    f"""WITH {star.PART_SQL}
 SELECT order_id, line, p.idx AS part_code, f.idx AS flag_code FROM lines_
 LEFT JOIN dictionary p ON p.column_name = 'part' AND p.value = part
 LEFT JOIN dictionary f ON f.column_name = 'flag' AND f.value = flag"""
)
def category_codes(t):
    """Codes of all rows; NULL for a value the training rows do not have."""
    rows = star.part_rows(t)
    known = stable(categories.category_dictionary(rows.where("is_train"), ["part", "flag"]))
    coded = categories.category_codes(rows, known, {"part": "part_code", "flag": "flag_code"})
    return coded.select("order_id", "line", "part_code", "flag_code")


@query(
    f"""WITH {star.PART_SQL},
 top AS (SELECT part FROM lines_ WHERE is_train AND part IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
 top_flag AS (SELECT flag FROM lines_ WHERE is_train AND flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
 filled AS (SELECT coalesce(part, (SELECT part FROM top)) AS part, coalesce(flag, (SELECT flag FROM top_flag)) AS flag FROM lines_),
 shown AS (SELECT 'part' AS column_name, part AS value FROM filled UNION ALL SELECT 'flag', flag FROM filled),
 sums AS (SELECT column_name, value, CAST(count(*) AS DOUBLE) AS total FROM shown GROUP BY 1, 2)
 SELECT 'categorical__' || column_name || '_' || value AS feature, coalesce(total, 0) AS total
 FROM dictionary LEFT JOIN sums USING (column_name, value)"""
)
def sparse_one_hot(t):
    """Sums of the sparse vectors of all rows, thousands of entries wide, by feature."""
    rows = star.part_rows(t)
    stage = prep.build_preprocessor([], ["part", "flag"])
    model = prep.fit_preprocessor(stage, rows.where("is_train"))
    sums = prep.vector_sums(model.transform(rows))
    names = model.feature_table(t.spark)
    total = F.coalesce("total", F.lit(0.0)).alias("total")
    return names.join(sums, "position", "left").select("feature", total)


@query(
    f"""WITH {FILLS_SQL}
 SELECT 'price' AS feature, 'median' AS kind, CAST((SELECT price FROM fills) AS VARCHAR) AS value,
 (SELECT count(*) FROM rows_ WHERE price IS NULL) AS filled_rows
 UNION ALL SELECT 'load', 'median', CAST((SELECT load FROM fills) AS VARCHAR), (SELECT count(*) FROM rows_ WHERE load IS NULL)
 UNION ALL SELECT 'month', 'median', CAST((SELECT month FROM fills) AS VARCHAR), (SELECT count(*) FROM rows_ WHERE month IS NULL)
 UNION ALL SELECT 'priority', 'most_frequent', (SELECT priority FROM fills), (SELECT count(*) FROM rows_ WHERE priority IS NULL)
 UNION ALL SELECT 'status', 'most_frequent', (SELECT status FROM fills), (SELECT count(*) FROM rows_ WHERE status IS NULL)"""
)
def imputation_values(t):
    model, rows = _fitted(t)
    return prep.imputation_values(model, rows)


def _all_features_sql() -> dict[str, str]:
    """Expression of every assembled feature, by its output name."""
    parts = {}
    for c in NUMERIC:
        parts[f"numeric__{c}"] = _centred(c)
    for c in ("price", "load"):
        parts[f"numeric__missingindicator_{c}"] = _centred(f"gone_{c}")
    for v in _PRIORITIES:
        parts[f"categorical__priority_{v}"] = f"CAST(priority = '{v}' AS DOUBLE)"
    for v in "FOP":
        parts[f"categorical__status_{v}"] = f"CAST(status = '{v}' AS DOUBLE)"
    return parts


@query(
    f"WITH {FILLS_SQL} "
    + " UNION ALL ".join(
        f"SELECT row_id, '{name}' AS feature, round({sql}, 6) AS feature_value FROM filled"
        for name, sql in _all_features_sql().items()
    )
)
def preprocess_long(t):
    """(row, feature, value) of the assembled features."""
    model, rows = _fitted(t)
    return rounded(prep.long_features(model, rows, row_id="row_id"))


@query(
    f"WITH {FILLS_SQL} SELECT row_id, "
    + ", ".join(f'round({sql}, 6) AS "{name}"' for name, sql in _all_features_sql().items())
    + " FROM filled"
)
def transform_named(t):
    model, rows = _fitted(t)
    return rounded(prep.transform_features(model, rows, keep=["row_id"]))


@query(
    f"WITH {FILLS_SQL} SELECT row_id, CAST({len(_all_features_sql())} AS INTEGER) AS n_features, round("
    + " + ".join(f"({sql})" for sql in _all_features_sql().values())
    + ", 3) AS feature_sum FROM filled"
)
def fit_on_train(t):
    """Vectors of all rows, from a fit that saw training rows only: size and sum."""
    model, rows = _fitted(t)
    vectors = prep.transform_features(model, rows, keep=["row_id"], named=False)
    values = vector_to_array("features")
    return rounded(
        vectors.select(
            "row_id",
            F.size(values).alias("n_features"),
            F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("feature_sum"),
        ),
        3,
    )


# --- metrics ------------------------------------------------------------------------------------


def _area_sql(source: str = "scored", by: str = "") -> str:
    """AUROC by mid-ranks and AP by precision at each positive's score."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""areas AS (
  SELECT {lead}CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN
      (sum(CASE WHEN y = 1 THEN mid END) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2)
      / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) END AS auroc,
    CASE WHEN sum(y) > 0 THEN sum(CASE WHEN y = 1 THEN hits / CAST(seen AS DOUBLE) END) / sum(y) END AS auprc
  FROM (SELECT {lead}y, rank() OVER ({part} ORDER BY p) + (count(*) OVER (PARTITION BY {lead}p) - 1) / CAST(2 AS DOUBLE) AS mid,
               sum(y) OVER ({part} ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits,
               count(*) OVER ({part} ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
        FROM {source}) {group})"""


_CLIP = "least(greatest(p, CAST(1e-8 AS DOUBLE)), 1 - CAST(1e-8 AS DOUBLE))"


def _quality_sql(source: str = "scored", by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""quality AS (
  SELECT {lead}avg((q - y) * (q - y)) AS brier_score, avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS log_loss,
         avg(q) AS mean_predicted_risk, avg(CAST(y AS DOUBLE)) AS observed_event_rate
  FROM (SELECT {lead}y, {_CLIP} AS q FROM {source}) {group})"""


def _records_sql(source: str = "scored", by: str = "", thresholds=(0.5,)) -> str:
    lead = f"{by}, " if by else ""
    listed = ", ".join(f"(CAST({t} AS DOUBLE))" for t in thresholds)
    return f"""points(threshold) AS (VALUES {listed}),
cells AS (
  SELECT {lead}threshold, count(*) FILTER (y = 1 AND p >= threshold) AS tp, count(*) FILTER (y = 0 AND p >= threshold) AS fp,
         count(*) FILTER (y = 1 AND p < threshold) AS fn, count(*) FILTER (y = 0 AND p < threshold) AS tn
  FROM {source}, points GROUP BY {lead}threshold),
records AS (
  SELECT {lead}threshold, (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision_ppv,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall_sensitivity,
    CASE WHEN tn + fp > 0 THEN tn / CAST(tn + fp AS DOUBLE) END AS specificity,
    CASE WHEN tn + fn > 0 THEN tn / CAST(tn + fn AS DOUBLE) END AS negative_predictive_value,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1_score,
    tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
    tp + fp AS patients_flagged, (tp + fp) / CAST(tp + tn + fp + fn AS DOUBLE) AS flagged_percentage
  FROM cells)"""


_RATES = (
    "accuracy",
    "precision_ppv",
    "recall_sensitivity",
    "specificity",
    "negative_predictive_value",
    "f1_score",
    "flagged_percentage",
)
_COUNTS = (
    "true_negatives",
    "false_positives",
    "false_negatives",
    "true_positives",
    "patients_flagged",
)
_FIELDS = (
    "threshold, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _RATES)
    + ", "
    + ", ".join(_COUNTS)
)
_AREAS = "round(auroc, 6) AS auroc, round(auprc, 6) AS auprc"
_QUALITY = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in ("brier_score", "log_loss", "mean_predicted_risk", "observed_event_rate")
)
ON = {"target": "y", "probability": "p"}


@query(f"WITH {star.SCORED_LINES_SQL}, {_area_sql()} SELECT {_AREAS} FROM areas")
def discrimination_metrics(t):
    return rounded(metrics.discrimination_metrics(star.scored_lines(t), **ON))


@query(
    f"WITH {star.SCORED_LINES_SQL}, {_area_sql()}, {_quality_sql()} SELECT {_AREAS}, {_QUALITY} FROM areas, quality"
)
def probability_metrics(t):
    return rounded(metrics.probability_metrics(star.scored_lines(t), **ON))


@query(
    f"WITH {star.SCORED_LINES_SQL}, {_area_sql()}, {_records_sql()} SELECT {_AREAS}, {_FIELDS} FROM areas, records"
)
def classification_metrics(t):
    return rounded(metrics.classification_metrics(star.scored_lines(t), **ON))


SWEEP_SQL = f"{star.SCORED_ORDERS_SQL}, {_area_sql()}, {_records_sql(thresholds=DEFAULT_THRESHOLDS)}"


@query(f"WITH {SWEEP_SQL} SELECT {_AREAS}, {_FIELDS} FROM areas, records")
def threshold_sweep(t):
    return rounded(metrics.threshold_sweep(star.scored_orders(t), **ON))


@query(
    f"""WITH {SWEEP_SQL} SELECT {_AREAS}, {_FIELDS} FROM areas, records
 ORDER BY records.f1_score DESC, records.recall_sensitivity DESC, records.specificity DESC NULLS LAST, threshold LIMIT 1"""
)
def best_threshold(t):
    """Best F1, then recall, then specificity."""
    return rounded(metrics.best_f1(metrics.threshold_sweep(star.scored_orders(t), **ON)))


@query(
    f"""WITH {SWEEP_SQL} SELECT {_AREAS}, {_FIELDS} FROM areas, records WHERE records.recall_sensitivity >= CAST(0.8 AS DOUBLE)
 ORDER BY records.specificity DESC NULLS LAST, records.precision_ppv DESC, threshold LIMIT 1"""
)
def high_sensitivity_threshold(t):
    sweep = metrics.threshold_sweep(star.scored_orders(t), **ON)
    return rounded(metrics.high_sensitivity(sweep))


@query(
    f"""WITH {SWEEP_SQL} SELECT {_FIELDS.replace('round(accuracy, 6) AS accuracy, ', '')},
 CASE WHEN threshold <= CAST(0.2 AS DOUBLE) THEN 'High-sensitivity / high-alert operating point'
      WHEN threshold <= CAST(0.4 AS DOUBLE) THEN 'Intermediate operating point'
      ELSE 'Lower-alert / higher-miss operating point' END AS interpretation,
 CASE WHEN threshold <= CAST(0.2 AS DOUBLE) THEN 'Higher-sensitivity screening'
      WHEN threshold <= CAST(0.4 AS DOUBLE) THEN 'Balanced exploratory threshold'
      ELSE 'Lower-alert threshold' END AS use_case_interpretation FROM records"""
)
def operational_thresholds(t):
    sweep = metrics.threshold_sweep(star.scored_orders(t), **ON)
    return rounded(metrics.operational_thresholds(sweep))


_RANKED = f"""{star.SCORED_ORDERS_SQL},
ranked AS (SELECT *, row_number() OVER (ORDER BY p DESC, stay_id) AS risk_rank, count(*) OVER () AS n FROM scored)"""


@query(
    f"""WITH {_RANKED}, caps(c) AS (VALUES {', '.join(f'(CAST({c} AS DOUBLE))' for c in REVIEW_CAPACITIES)}),
 k AS (SELECT c, greatest(1, CAST(ceil(c * (SELECT count(*) FROM scored)) AS BIGINT)) AS k FROM caps),
 r AS (SELECT c, k, CAST(sum(y) FILTER (risk_rank <= k) AS BIGINT) AS captured, CAST(sum(y) AS BIGINT) AS total
       FROM k, ranked GROUP BY 1, 2)
 SELECT c AS review_capacity_percentage, k AS patients_reviewed, captured AS deaths_captured, total AS total_deaths,
 round(captured / CAST(total AS DOUBLE), 6) AS death_capture_rate,
 round(captured / CAST(k AS DOUBLE), 6) AS precision_among_reviewed, k - captured AS false_alerts_among_reviewed,
 round(c * 100, 6) AS capacity_percent, round(captured / CAST(total AS DOUBLE) * 100, 6) AS capture_percent FROM r"""
)
def review_capacity(t):
    return rounded(
        metrics.review_capacity(star.scored_orders(t), row_id="stay_id", **ON)
    )


@query(
    f"""WITH {_RANKED} SELECT stay_id, p, risk_rank,
 round(1 - (risk_rank - 1) / CAST(n AS DOUBLE), 9) AS risk_percentile FROM ranked"""
)
def risk_rank(t):
    """Global rank and percentile of every row; ties by id."""
    scored = star.scored_orders(t).select("stay_id", "p")
    n = scored.agg(F.count("*")).scalar()
    ranked = scale.rank_rows(scored, score="p", tie="stay_id")
    return rounded(
        ranked.withColumn(
            "risk_percentile", F.lit(1.0) - (F.col("risk_rank") - 1) / n.cast("double")
        ),
        9,
    )


@query(
    f"WITH {star.SCORED_ORDERS_SQL} SELECT stay_id, y, p FROM scored ORDER BY p DESC, stay_id LIMIT 10"
)
def top_risk(t):
    scored = star.scored_orders(t).select("stay_id", "y", "p")
    return scored.orderBy(F.col("p").desc(), "stay_id").limit(10)


# --- subgroups --------------------------------------------------------------------------------------

_BANDS = "CASE WHEN age <= 49 THEN '18-49' WHEN age <= 69 THEN '50-69' WHEN age IS NOT NULL THEN '70+' END"


def _subgroups_sql(parts: dict[str, str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT y, p, '{name}' AS subgroup_variable, {sql} AS subgroup_value FROM scored"
        for name, sql in parts.items()
    )
    by = "subgroup_variable, subgroup_value"
    joins = "a.subgroup_variable = r.subgroup_variable AND a.subgroup_value IS NOT DISTINCT FROM r.subgroup_value"
    small = "(tp + fp + fn + tn) < 20"
    few = "(tp + fn) < 5"
    rates = ", ".join(f"round(r.{c}, 6) AS {c}" for c in _RATES)
    counts = ", ".join(f"r.{c}" for c in _COUNTS)
    return f"""WITH {star.SCORED_LINES_SQL}, long AS ({union}),
{_area_sql('long', by)}, {_records_sql('long', by)}
SELECT r.subgroup_variable, r.subgroup_value, tp + fp + fn + tn AS sample_size, tp + fn AS deaths,
 round((tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS event_rate, {_AREAS}, r.threshold, {rates}, {counts},
 {small} AS small_sample_warning, {few} AS few_event_warning,
 CASE WHEN {small} OR {few} THEN 'Exploratory only: small sample or few events.' ELSE 'Interpret with caution.' END AS interpretation_note
FROM records r JOIN areas a ON {joins}
JOIN cells c ON c.subgroup_variable = r.subgroup_variable AND c.subgroup_value IS NOT DISTINCT FROM r.subgroup_value"""


@query(_subgroups_sql({"line": "line"}))
def subgroup_metrics(t):
    """One variable; its NULL value is a subgroup."""
    return rounded(
        metrics.subgroup_metrics(star.scored_lines(t), subgroups=["line"], **ON)
    )


@query(_subgroups_sql({"line": "line", "status": "status", "age_group": _BANDS}))
def subgroup_metrics_all(t):
    """Several variables unpivoted and measured in one pass."""
    rows = star.scored_lines(t).withColumn("age_group", age_band(F.col("age")))
    return rounded(
        metrics.subgroup_metrics(rows, subgroups=["line", "status", "age_group"], **ON)
    )


@query(
    f"""WITH {star.SCORED_LINES_SQL} SELECT label, round(avg(CAST(y AS DOUBLE)), 6) AS event_rate FROM (
 SELECT y, 'line: ' || coalesce(line, 'nan') AS label FROM scored UNION ALL SELECT y, 'status: ' || status FROM scored) GROUP BY 1"""
)
def subgroup_event_rates(t):
    return rounded(
        metrics.subgroup_event_rates(
            star.scored_lines(t), subgroups=["line", "status"], target="y"
        ).orderBy("event_rate")
    )


@query(
    f"WITH {star.PATIENTS_SQL} SELECT {_BANDS.replace('age', 'anchor_age')} AS age_group, count(*) AS n FROM patients GROUP BY 1"
)
def age_band_counts(t):
    return (
        star.patients(t)
        .groupBy(age_band(F.col("anchor_age")).alias("age_group"))
        .agg(F.count("*").alias("n"))
    )


# --- several models -----------------------------------------------------------------------------------

COMPARE_SQL = f"{star.MODEL_SCORES_SQL}, {_area_sql(by='model')}, {_records_sql(by='model')}"


@query(f"WITH {COMPARE_SQL} SELECT model, {_AREAS}, {_FIELDS} FROM records JOIN areas USING (model)")
def model_comparison(t):
    return rounded(metrics.compare_models(star.model_scores(t), model="model", **ON))


@query(
    f"""WITH {COMPARE_SQL} SELECT model, {_AREAS}, {_FIELDS} FROM records JOIN areas USING (model)
 ORDER BY areas.auprc DESC NULLS LAST, areas.auroc DESC NULLS LAST, model LIMIT 1"""
)
def select_model(t):
    compared = metrics.compare_models(star.model_scores(t), model="model", **ON)
    return rounded(metrics.select_model(compared))


CALIBRATION_SQL = f"""{star.MODEL_SCORES_SQL.replace(chr(10) + 'scored AS (', chr(10) + 'raw_scores AS (')},
scored AS (SELECT y, model AS method, {_CLIP} AS p FROM raw_scores),
{_area_sql(by='method')}, {_quality_sql(by='method')}"""


def _methods(t):
    return star.model_scores(t).withColumnRenamed("model", "method")


@query(f"WITH {CALIBRATION_SQL} SELECT method, {_AREAS}, {_QUALITY} FROM areas JOIN quality USING (method)")
def calibration_comparison(t):
    return rounded(metrics.compare_calibrations(_methods(t), method="method", **ON))


@query(
    f"""WITH {CALIBRATION_SQL} SELECT method, {_AREAS}, {_QUALITY} FROM areas JOIN quality USING (method)
 ORDER BY quality.brier_score, quality.log_loss, method LIMIT 1"""
)
def select_calibration(t):
    compared = metrics.compare_calibrations(_methods(t), method="method", **ON)
    return rounded(metrics.select_calibration(compared))


@query(
    f"""WITH {COMPARE_SQL}, {_quality_sql(by='model')} SELECT model AS calibration_method, {_AREAS}, {_FIELDS}, {_QUALITY}
 FROM records JOIN areas USING (model) JOIN quality USING (model)"""
)
def final_test_metrics(t):
    """Probability and classification fields side by side per method."""
    rows = star.model_scores(t).withColumnRenamed("model", "calibration_method")
    return rounded(metrics.final_record(rows, by=["calibration_method"], **ON))


@query(
    f"""WITH {star.MODEL_SCORES_SQL} SELECT stay_id, y,
 round(max(CASE WHEN model = 'Price Model' THEN p END), 9) AS price_model_probability,
 round(max(CASE WHEN model = 'Hash Model' THEN p END), 9) AS hash_model_probability,
 round(max(CASE WHEN model = 'Blend' THEN p END), 9) AS blend_probability FROM scored GROUP BY 1, 2"""
)
def score_wide(t):
    wide = models.wide_scores(
        star.model_scores(t),
        ["Price Model", "Hash Model", "Blend"],
        keep=["stay_id", "y"],
        score="p",
    )
    return rounded(wide, 9)


@query(
    """SELECT o_orderkey AS stay_id, round((SELECT avg(CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE 0 END)
 FROM orders), 9) AS predicted_probability FROM orders"""
)
def dummy_baseline(t):
    rows = star.scored_orders(t)
    return rounded(models.prior_scores(rows, rows, target="y", keep=["stay_id"]), 9)


@query(
    """SELECT count(*) FILTER (o_orderstatus <> 'F') AS n_neg, count(*) FILTER (o_orderstatus = 'F') AS n_pos,
 round(count(*) FILTER (o_orderstatus <> 'F') / CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE), 6) AS scale_pos_weight
 FROM orders"""
)
def class_ratio(t):
    return rounded(models.class_ratio(star.scored_orders(t), target="y"))


@query(
    """SELECT y, count(*) AS n, round((SELECT count(*) FROM orders) / CAST(2 * count(*) AS DOUBLE), 6) AS class_weight
 FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders) GROUP BY 1"""
)
def class_weights(t):
    return rounded(models.class_weights(star.scored_orders(t), target="y"))


# --- curves and bins -------------------------------------------------------------------------------------

_CURVE = f"""{star.SCORED_ORDERS_SQL},
led AS (SELECT p, count(*) FILTER (y = 1) AS a, count(*) FILTER (y = 0) AS b FROM scored GROUP BY p),
cum AS (SELECT p, sum(a) OVER (ORDER BY p DESC) AS tp, sum(b) OVER (ORDER BY p DESC) AS fp,
               sum(a) OVER () AS pos, sum(b) OVER () AS neg FROM led)"""


@query(
    f"""WITH {_CURVE} SELECT p AS threshold, round(fp / CAST(neg AS DOUBLE), 6) AS fpr,
 round(tp / CAST(pos AS DOUBLE), 6) AS tpr FROM cum"""
)
def roc_points(t):
    return rounded(ledger.roc_points(star.scored_orders(t), **ON))


@query(
    f"""WITH {_CURVE} SELECT p AS threshold, round(tp / CAST(pos AS DOUBLE), 6) AS recall,
 round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision FROM cum"""
)
def pr_points(t):
    return rounded(ledger.pr_points(star.scored_orders(t), **ON))


def _bins_sql(edges: str) -> str:
    return f"""WITH {star.SCORED_ORDERS_SQL}, edges AS ({edges}),
binned AS (SELECT y, p, CAST((SELECT count(*) FROM edges WHERE e < p) AS INTEGER) AS bin FROM scored)
SELECT bin, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(CAST(y AS DOUBLE)), 6) AS observed_rate
FROM binned GROUP BY 1"""


@query(
    _bins_sql(
        "SELECT unnest(quantile_cont(p, ["
        + ", ".join(f"CAST({i / 10} AS DOUBLE)" for i in range(1, 10))
        + "])) AS e FROM scored"
    )
)
def calibration_bins(t):
    """Ten exact-quantile bins."""
    return rounded(metrics.calibration_bins(star.scored_orders(t), **ON))


@query(
    _bins_sql(
        "SELECT unnest(["
        + ", ".join(f"CAST({i / 10} AS DOUBLE)" for i in range(1, 10))
        + "]) AS e"
    )
)
def calibration_bins_uniform(t):
    return rounded(
        metrics.calibration_bins(star.scored_orders(t), strategy="uniform", **ON)
    )


@query(
    f"""WITH {star.SCORED_ORDERS_SQL}, cells(actual, predicted) AS (VALUES (0, 0), (0, 1), (1, 0), (1, 1))
 SELECT actual, predicted, count(y) AS n FROM cells LEFT JOIN scored
 ON y = actual AND CAST(p >= CAST(0.5 AS DOUBLE) AS INTEGER) = predicted GROUP BY 1, 2"""
)
def confusion_matrix(t):
    return metrics.confusion_matrix(star.scored_orders(t), **ON)


@query(
    f"""WITH {star.SCORED_ORDERS_SQL}, r AS (SELECT y, min(p) AS lo, max(p) AS hi FROM scored GROUP BY y)
 SELECT y AS outcome, CAST(least(floor((p - lo) / ((hi - lo) / 15)) + 1, 15) AS INTEGER) AS bin, count(*) AS n
 FROM scored JOIN r USING (y) GROUP BY 1, 2"""
)
def score_histogram(t):
    return metrics.score_histogram(star.scored_orders(t), **ON)


# --- errors and review ---------------------------------------------------------------------------------------

_CATEGORY = """CASE WHEN y = 1 AND p >= CAST(0.5 AS DOUBLE) THEN 'true_positive' WHEN y = 0 AND p >= CAST(0.5 AS DOUBLE) THEN 'false_positive'
 WHEN y = 1 THEN 'false_negative' ELSE 'true_negative' END"""
ERRORS_SQL = f"""{star.SCORED_ORDERS_SQL},
errors AS (SELECT *, CAST(p >= CAST(0.5 AS DOUBLE) AS INTEGER) AS predicted_label, {_CATEGORY} AS prediction_category FROM scored)"""


def _errors(t):
    return metrics.error_categories(star.scored_orders(t), **ON)


@query(f"WITH {ERRORS_SQL} SELECT stay_id, y, p, predicted_label, prediction_category FROM errors")
def error_categories(t):
    return _errors(t).select("stay_id", "y", "p", "predicted_label", "prediction_category")


@query(
    f"""WITH {ERRORS_SQL} SELECT prediction_category, count(*) AS patients, round(avg(p), 6) AS mean_predicted_probability,
 round(median(p), 6) AS median_predicted_probability, min(p) AS minimum_predicted_probability,
 max(p) AS maximum_predicted_probability FROM errors GROUP BY 1"""
)
def error_category_summary(t):
    return rounded(metrics.error_category_summary(_errors(t), probability="p"))


@query(
    f"""WITH {ERRORS_SQL}, j AS (SELECT e.prediction_category, o.o_totalprice, CAST(o.o_custkey AS DOUBLE) AS o_custkey
 FROM errors e JOIN orders o ON o.o_orderkey = e.stay_id)
 SELECT prediction_category, 'o_totalprice' AS feature, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
 round(median(o_totalprice), 4) AS median FROM j GROUP BY 1
 UNION ALL SELECT prediction_category, 'o_custkey', count(o_custkey), round(avg(o_custkey), 4), round(median(o_custkey), 4)
 FROM j GROUP BY 1"""
)
def error_feature_summary(t):
    rows = _errors(t).join(
        t.orders.select(F.col("o_orderkey").alias("stay_id"), "o_totalprice", "o_custkey"),
        "stay_id",
    )
    return rounded(
        metrics.error_feature_summary(rows, features=["o_totalprice", "o_custkey"]), 4
    )


@query(
    f"""WITH {ERRORS_SQL} SELECT stay_id, y, p, prediction_category FROM (SELECT *, row_number() OVER (PARTITION BY prediction_category
 ORDER BY CASE WHEN prediction_category IN ('false_negative', 'true_negative') THEN p ELSE -p END, stay_id) AS rn FROM errors)
 WHERE rn = 1"""
)
def representative_cases(t):
    return metrics.representative_cases(_errors(t), probability="p", row_id="stay_id").select(
        "stay_id", "y", "p", "prediction_category"
    )


def _context(t):
    return star.admissions(t).withColumnRenamed("hadm_id", "stay_id")


_CONTEXT_SQL = "a.admission_type, a.admission_location, a.insurance"


@query(
    f"""WITH {ERRORS_SQL}, {star.ADMISSIONS_SQL} SELECT e.stay_id, e.y, e.p, {_CONTEXT_SQL} FROM scored e
 LEFT JOIN admissions a ON a.hadm_id = e.stay_id"""
)
def high_risk_review(t):
    """Scores beside whichever context columns the table has, highest first."""
    scored = star.scored_orders(t).select("stay_id", "y", "p")
    reviewed = metrics.with_context(
        scored, _context(t), key="stay_id", columns=REVIEW_CONTEXT
    )
    return reviewed.orderBy(F.col("p").desc(), "stay_id")


def _cases(t, category: str):
    chosen = (
        _errors(t)
        .where(F.col("prediction_category") == category)
        .select("stay_id", "y", "p", "prediction_category")
    )
    return metrics.with_context(
        chosen, _context(t), key="stay_id", columns=REVIEW_CONTEXT
    )


def _cases_sql(category: str) -> str:
    return f"""WITH {ERRORS_SQL}, {star.ADMISSIONS_SQL} SELECT e.stay_id, e.y, e.p, e.prediction_category, {_CONTEXT_SQL}
 FROM errors e LEFT JOIN admissions a ON a.hadm_id = e.stay_id WHERE e.prediction_category = '{category}'"""


@query(_cases_sql("false_negative"))
def false_negatives(t):
    return _cases(t, "false_negative").orderBy("p", "stay_id")


@query(_cases_sql("false_positive"))
def false_positives(t):
    return _cases(t, "false_positive").orderBy(F.col("p").desc(), "stay_id")


@query(
    f"""WITH {ERRORS_SQL}, {star.ADMISSIONS_SQL} SELECT e.subject_id, e.hadm_id, e.stay_id, e.y, e.p, e.predicted_label,
 e.prediction_category, a.admittime, a.dischtime, a.deathtime, a.admission_type, a.admission_location, a.insurance,
 a.marital_status FROM errors e LEFT JOIN admissions a ON a.subject_id = e.subject_id AND a.hadm_id = e.hadm_id"""
)
def error_cases_wide(t):
    """Every scored row with all its columns and its error category."""
    return _errors(t).join(
        star.admissions(t).drop("hospital_expire_flag"), ["subject_id", "hadm_id"], "left"
    )


@query(
    f"""WITH {star.SCORED_ORDERS_SQL} SELECT subject_id, hadm_id, stay_id, y, p AS uncalibrated_probability,
 round(sqrt(p), 9) AS final_probability, CAST(sqrt(p) >= CAST(0.5 AS DOUBLE) AS INTEGER) AS final_prediction_0_50,
 CAST(CAST(sqrt(p) >= CAST(0.5 AS DOUBLE) AS INTEGER) = y AS INTEGER) AS prediction_correct_at_0_50 FROM scored"""
)
def final_predictions(t):
    rows = star.scored_orders(t).withColumn("q", F.sqrt("p"))
    return rounded(
        metrics.final_predictions(
            rows,
            ids=["subject_id", "hadm_id", "stay_id"],
            target="y",
            uncalibrated="p",
            final="q",
        ),
        9,
    )


# --- sinks -----------------------------------------------------------------------------------------------------


@query(
    f"""WITH {star.SCORED_ORDERS_SQL} SELECT scored.*, CASE stay_id % 5 WHEN 1 THEN ''
 WHEN 2 THEN 'two' || chr(10) || '"quoted", lines' WHEN 3 THEN ' padded ' WHEN 4 THEN 'back\\slash' END AS note FROM scored"""
)
def export_predictions(t):
    """Predictions with a free text written as CSV and read back."""
    path = f"{shared_folder(t.spark)}/predictions-{uuid.uuid4().hex}"
    kind = F.col("stay_id") % 5
    note = (
        F.when(kind == 1, "")
        .when(kind == 2, 'two\n"quoted", lines')
        .when(kind == 3, " padded ")
        .when(kind == 4, "back\\slash")
    )
    return tables.export_predictions(star.scored_orders(t).withColumn("note", note), path)


@query(
    f"""WITH {star.COHORT_SQL} SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS hadm_id_repeated,
 CAST(0 AS BIGINT) AS stay_id_repeated, true AS same_content FROM cohort"""
)
def roundtrip_check(t):
    """Write, reload, recheck counts, keys and content."""
    path = f"{shared_folder(t.spark)}/cohort-{uuid.uuid4().hex}"
    return tables.roundtrip_check(
        star.order_cohort(t), path, keys=["hadm_id", "stay_id"]
    )


@query(f"WITH {star.STAYS_SQL} SELECT hadm_id, stay_id, intime, outtime FROM stays")
def load_table_coerced(t):
    """CSV of text dates read back with its date columns coerced."""
    path = f"{shared_folder(t.spark)}/stays-{uuid.uuid4().hex}"
    text = star.stays_of_orders(t).select(
        "hadm_id",
        "stay_id",
        F.coalesce(F.col("intime").cast("string"), F.lit("unknown")).alias("intime"),
        F.col("outtime").cast("string").alias("outtime"),
    )
    tables.write_table(text, path, format="csv")
    return tables.load_table(
        t.spark,
        path,
        schema="hadm_id BIGINT, stay_id BIGINT, intime STRING, outtime STRING",
    )


# Cells of error events hold a text in place of a number, as a source file may.
_EVENT_CELLS = {"value": "CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS string) END"}
_EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"


def _landed_events(t):
    """The event table as a folder of gzip CSV files, landed once."""
    folder = f"{shared_folder(t.spark)}/landing-{uuid.uuid4().hex}"
    columns = ["event_id", "ts", "user_id", "event_type"]
    cells = [F.expr(sql).alias(c) for c, sql in _EVENT_CELLS.items()]
    t.events.select(*columns, *cells).write.options(
        header=True, compression="gzip", timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS", **tables.CSV_TEXT,
    ).csv(f"{folder}/csv")
    return tables.land_csv(
        t.spark, f"{folder}/csv", _EVENT_SCHEMA, f"{folder}/typed", **tables.CSV_TEXT
    )


@query(
    """SELECT user_id, count(*) AS n_events, count(CASE WHEN event_type <> 'error' THEN value END) AS n_values,
 round(avg(CASE WHEN event_type <> 'error' THEN value END), 6) AS value_mean,
 max(CASE WHEN event_type <> 'error' THEN value END) AS value_max, min(ts) AS first_ts, max(ts) AS last_ts
 FROM events GROUP BY user_id"""
)
def csv_view(t):
    """Gzip CSV landed as typed Parquet, a view over it, features by SQL from the view."""
    view = f"landed_{uuid.uuid4().hex}"
    tables.register_view(_landed_events(t).rows, view)
    return t.spark.sql(
        f"""SELECT user_id, count(*) AS n_events, count(value) AS n_values,
        round(avg(value), 6) AS value_mean, max(value) AS value_max,
        min(ts) AS first_ts, max(ts) AS last_ts FROM {view} GROUP BY user_id"""
    )


@query(
    """SELECT 'value' AS "column", 'n/a' AS "value", count(*) AS n FROM events
 WHERE event_type = 'error' HAVING count(*) > 0"""
)
def csv_rejects(t):
    """Cells of the landed files that failed to cast, counted by column and text."""
    return _landed_events(t).rejects.groupBy("column", "value").agg(F.count("*").alias("n"))


@query(
    f"""WITH {COMPARE_SQL} SELECT model AS selected_model_name, 'validation' AS selection_dataset,
 'AUPRC' AS primary_selection_metric, 'AUROC' AS secondary_selection_metric, round(auprc, 6) AS validation_auprc,
 round(auroc, 6) AS validation_auroc, false AS test_set_used_for_selection FROM areas
 ORDER BY areas.auprc DESC, areas.auroc DESC, model LIMIT 1"""
)
def run_metadata(t):
    """One-row run record as JSON."""
    path = f"{shared_folder(t.spark)}/run-{uuid.uuid4().hex}"
    compared = metrics.compare_models(star.model_scores(t), model="model", **ON)
    record = metrics.select_model(compared).select(
        F.col("model").alias("selected_model_name"),
        F.lit("validation").alias("selection_dataset"),
        F.lit("AUPRC").alias("primary_selection_metric"),
        F.lit("AUROC").alias("secondary_selection_metric"),
        F.col("auprc").alias("validation_auprc"),
        F.col("auroc").alias("validation_auroc"),
        F.lit(False).alias("test_set_used_for_selection"),
    )
    return rounded(tables.write_metadata(record, path))
