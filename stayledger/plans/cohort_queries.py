"""Profiles, checks, cohort selection, events and features on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayledger.config import (
    LAB_RULES,
    PLAUSIBLE_BOUNDS,
    TEMPERATURE_UNITS,
    VITAL_RULES,
    VITAL_SEARCH_FRAGMENTS,
)
from stayledger.functions import plausible
from stayledger.operators import checks, cohort, events, features, profile
from stayledger.plans import star
from stayledger.plans.registry import query, rounded

# --- profiles ---------------------------------------------------------------------------


def _unpivoted(source: str, columns, value_sql, name: str = "feature") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {name}, {value_sql(c)} FROM {source}" for c in columns
    )


@query(
    _unpivoted(
        "lineitem",
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        lambda c: f"count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, "
        f"round(min({c}), 6) AS minimum, round(max({c}), 6) AS maximum, "
        f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
        f"round(quantile_cont({c}, 0.75), 6) AS q75",
    )
)
def table_describe(t):
    """Numeric summary with exact quartiles."""
    return rounded(
        profile.describe_numeric(
            t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        )
    )


@query(
    """SELECT 'l_returnflag' AS feature, count(l_returnflag) AS n, count(DISTINCT l_returnflag) AS n_unique,
 (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
 (SELECT count(*) FROM lineitem GROUP BY l_returnflag ORDER BY count(*) DESC LIMIT 1) AS top_count FROM lineitem
 UNION ALL
 SELECT 'l_linestatus', count(l_linestatus), count(DISTINCT l_linestatus),
 (SELECT l_linestatus FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
 (SELECT count(*) FROM lineitem GROUP BY l_linestatus ORDER BY count(*) DESC LIMIT 1) FROM lineitem"""
)
def table_describe_categorical(t):
    """count / unique / top / frequency of category columns."""
    return profile.describe_categorical(t.lineitem, ["l_returnflag", "l_linestatus"])


ADMISSION_COLUMNS = [
    "dischtime",
    "deathtime",
    "admission_location",
    "insurance",
    "marital_status",
    "hospital_expire_flag",
]


@query(
    f"WITH {star.ADMISSIONS_SQL} "
    + _unpivoted(
        "admissions",
        ADMISSION_COLUMNS,
        lambda c: f"count(*) FILTER ({c} IS NULL) AS missing_count",
    )
)
def null_counts(t):
    return profile.null_counts(star.admissions(t), ADMISSION_COLUMNS)


@query(
    """SELECT table_name, row_count, CAST(a AS DOUBLE) AS unique_patients, CAST(b AS DOUBLE) AS unique_admissions,
 CAST(c AS DOUBLE) AS unique_stays FROM (
 SELECT 'customer' AS table_name, count(*) AS row_count, count(DISTINCT c_custkey) AS a,
 CAST(NULL AS BIGINT) AS b, CAST(NULL AS BIGINT) AS c FROM customer
 UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey), count(DISTINCT o_orderkey), NULL FROM orders
 UNION ALL SELECT 'lineitem', count(*), NULL, count(DISTINCT l_orderkey),
 count(DISTINCT l_orderkey * 8 + l_linenumber) FROM lineitem)"""
)
def source_summary(t):
    lines = t.lineitem.select(
        "l_orderkey",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("stay_id"),
    )
    summary = profile.source_summary(
        {
            "customer": (
                t.customer,
                {
                    "unique_patients": "c_custkey",
                    "unique_admissions": None,
                    "unique_stays": None,
                },
            ),
            "orders": (
                t.orders,
                {
                    "unique_patients": "o_custkey",
                    "unique_admissions": "o_orderkey",
                    "unique_stays": None,
                },
            ),
            "lineitem": (
                lines,
                {
                    "unique_patients": None,
                    "unique_admissions": "l_orderkey",
                    "unique_stays": "stay_id",
                },
            ),
        }
    )
    counts = ("unique_patients", "unique_admissions", "unique_stays")
    return summary.withColumns({c: F.col(c).cast("double") for c in counts})


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
        for n in ("customer", "orders", "lineitem", "events", "part")
    )
)
def table_counts(t):
    names = ("customer", "orders", "lineitem", "events", "part")
    return profile.table_counts({n: getattr(t, n) for n in names})


@query(
    f"""WITH {star.ADMISSIONS_SQL}, {star.STAYS_SQL}
 SELECT 'admittime_missing' AS column_name, count(*) FILTER (admittime IS NULL) AS missing_count FROM admissions
 UNION ALL SELECT 'dischtime_missing', count(*) FILTER (dischtime IS NULL) FROM admissions
 UNION ALL SELECT 'deathtime_missing', count(*) FILTER (deathtime IS NULL) FROM admissions
 UNION ALL SELECT 'intime_missing', count(*) FILTER (intime IS NULL) FROM stays
 UNION ALL SELECT 'outtime_missing', count(*) FILTER (outtime IS NULL) FROM stays"""
)
def timestamp_missingness(t):
    return profile.timestamp_missing(
        [
            (star.admissions(t), ["admittime", "dischtime", "deathtime"]),
            (star.stays_of_orders(t), ["intime", "outtime"]),
        ]
    )


@query(
    f"""WITH {star.ADMISSIONS_SQL}
 SELECT hospital_expire_flag, CASE hospital_expire_flag WHEN 0 THEN 'Survived' WHEN 1 THEN 'Died' END AS label,
 count(*) AS count, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM admissions), 2) AS percentage
 FROM admissions GROUP BY hospital_expire_flag"""
)
def target_summary(t):
    return profile.target_summary(star.admissions(t), target="hospital_expire_flag")


COHORT_COLUMNS = [
    "gender",
    "anchor_age",
    "admission_type",
    "admission_location",
    "insurance",
    "marital_status",
    "race",
    "first_careunit",
]
COHORT_TYPES = {"anchor_age": "int"}


def _missing_sql(columns, types, source="cohort", extra=lambda c: ""):
    return _unpivoted(
        source,
        columns,
        lambda c: f"count(*) FILTER ({c} IS NULL) AS missing_count, "
        f"round(count(*) FILTER ({c} IS NULL) * CAST(100 AS DOUBLE) / count(*), 2) AS missing_percentage, "
        f"'{types.get(c, 'string')}' AS data_type{extra(c)}",
    )


@query(f"WITH {star.COHORT_SQL} {_missing_sql(COHORT_COLUMNS, COHORT_TYPES)}")
def missingness_summary(t):
    return profile.missing_summary(star.order_cohort(t), COHORT_COLUMNS)


@query(
    f"WITH {star.COHORT_SQL} SELECT * FROM ({_missing_sql(COHORT_COLUMNS, COHORT_TYPES)}) WHERE missing_count > 0"
)
def columns_with_missing(t):
    return profile.columns_with_missing(star.order_cohort(t), COHORT_COLUMNS)


@query(
    f"WITH {star.COHORT_SQL} "
    + _missing_sql(
        COHORT_COLUMNS,
        COHORT_TYPES,
        extra=lambda c: f", count(DISTINCT {c}) AS unique_non_missing_values",
    )
)
def missingness_with_distinct(t):
    return profile.missing_summary(star.order_cohort(t), COHORT_COLUMNS, distinct=True)


def _outcome_missing_sql(c: str) -> str:
    def share(flag):
        return (
            f"round(count(*) FILTER ({c} IS NULL AND hospital_expire_flag = {flag}) * CAST(100 AS DOUBLE) "
            f"/ count(*) FILTER (hospital_expire_flag = {flag}), 2)"
        )

    return (
        f"{share(0)} AS survivor_missing_pct, {share(1)} AS death_missing_pct, "
        f"round(abs({share(1)} - {share(0)}), 2) AS absolute_difference_pct"
    )


@query(
    f"WITH {star.COHORT_SQL} " + _unpivoted("cohort", COHORT_COLUMNS, _outcome_missing_sql)
)
def missingness_by_outcome(t):
    return profile.missing_by_outcome(
        star.order_cohort(t), COHORT_COLUMNS, target="hospital_expire_flag"
    )


@query(
    f"WITH {star.COHORT_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM cohort GROUP BY 2"
        for c in ("gender", "admission_type", "admission_location", "insurance")
    )
)
def category_counts(t):
    return profile.category_counts(
        star.order_cohort(t),
        ["gender", "admission_type", "admission_location", "insurance"],
    )


@query(
    "SELECT l_orderkey AS hadm_id, count(DISTINCT l_orderkey * 8 + l_linenumber) AS n_children "
    "FROM lineitem GROUP BY 1"
)
def children_per_parent(t):
    return profile.children_per_parent(
        star.stays_of_orders(t), parent="hadm_id", child="stay_id"
    )


@query(
    """SELECT max(n) AS max_children, count(*) FILTER (n > 1) AS parents_with_several
 FROM (SELECT count(DISTINCT o_orderkey) AS n FROM orders GROUP BY o_custkey)"""
)
def orders_per_customer(t):
    return profile.repeat_summary(t.orders, parent="o_custkey", child="o_orderkey")


def _metrics_sql(source: str, pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round(CAST({sql} AS DOUBLE), 6) AS value FROM {source}"
        for name, sql in pairs
    )


@query(
    f"WITH {star.COHORT_SQL} "
    + _metrics_sql(
        "cohort",
        [
            ("rows", "count(*)"),
            ("unique_patients", "count(DISTINCT subject_id)"),
            ("unique_admissions", "count(DISTINCT hadm_id)"),
            ("unique_icu_stays", "count(DISTINCT stay_id)"),
            ("deaths", "sum(hospital_expire_flag)"),
            ("mortality_rate", "avg(hospital_expire_flag)"),
            ("minimum_age", "min(anchor_age)"),
            ("maximum_age", "max(anchor_age)"),
        ],
    )
)
def cohort_summary(t):
    return rounded(
        profile.cohort_summary(
            star.order_cohort(t),
            patient="subject_id",
            admission="hadm_id",
            stay="stay_id",
            target="hospital_expire_flag",
            age="anchor_age",
        )
    )


@query(
    f"WITH {star.USER_COHORT_SQL} "
    + _metrics_sql(
        "base_cohort",
        [
            ("rows", "count(*)"),
            ("unique_patients", "count(DISTINCT subject_id)"),
            ("unique_stays", "count(DISTINCT stay_id)"),
            ("deaths", "sum(hospital_expire_flag)"),
            ("survivors", "count(*) FILTER (hospital_expire_flag = 0)"),
            ("mortality_rate", "avg(hospital_expire_flag)"),
        ],
    )
)
def cohort_summary_compact(t):
    return rounded(
        profile.compact_summary(
            star.user_cohort(t),
            patient="subject_id",
            stay="stay_id",
            target="hospital_expire_flag",
        )
    )


@query(
    f"""WITH {star.COHORT_SQL}
 SELECT 'rows_before_filtering' AS metric, (SELECT count(*) FROM joined) AS value
 UNION ALL SELECT 'rows_after_filtering', (SELECT count(*) FROM cohort)
 UNION ALL SELECT 'rows_removed', (SELECT count(*) FROM joined) - (SELECT count(*) FROM cohort)
 UNION ALL SELECT 'patients_after_filtering', (SELECT count(DISTINCT subject_id) FROM cohort)
 UNION ALL SELECT 'admissions_after_filtering', (SELECT count(DISTINCT hadm_id) FROM cohort)
 UNION ALL SELECT 'icu_stays_after_filtering', (SELECT count(DISTINCT stay_id) FROM cohort)"""
)
def inclusion_report(t):
    return profile.inclusion_report(
        star.joined_cohort(t),
        cohort.inclusion_mask(),
        patient="subject_id",
        admission="hadm_id",
        stay="stay_id",
    )


# --- checks ---------------------------------------------------------------------------------


@query(
    """SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 WHEN 'P' THEN
 CASE WHEN o_orderkey % 3 = 0 THEN 3 END END AS VARCHAR) AS bad_value, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1"""
)
def binary_target_violations(t):
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    flags = t.orders.select(
        F.when(status == "F", 1)
        .when(status == "O", 0)
        .when(key % 3 == 0, 3)
        .alias("flag")
    )
    found = checks.target_violations(flags, target="flag")
    return found.select(F.col("bad_value").cast("string").alias("bad_value"), "n")


@query(
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)
def duplicate_keys(t):
    return checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT 'l_orderkey_missing' AS rule, CAST(count(*) FILTER (l_orderkey IS NULL) AS BIGINT) AS violations FROM lineitem
 UNION ALL SELECT 'stay_id_missing', count(*) FILTER (l_orderkey * 8 + l_linenumber IS NULL) FROM lineitem
 UNION ALL SELECT 'stay_id_repeated', count(*) - count(DISTINCT l_orderkey * 8 + l_linenumber) FROM lineitem
 UNION ALL SELECT 'flag_missing', count(*) FILTER (l_returnflag = 'N') FROM lineitem
 UNION ALL SELECT 'flag_not_binary', count(*) FILTER (l_returnflag = 'A') FROM lineitem"""
)
def cohort_violations(t):
    flag = F.col("l_returnflag")
    rows = t.lineitem.select(
        "l_orderkey",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("stay_id"),
        F.when(flag == "R", 1).when(flag == "A", 2).when(flag == "N", None).alias("flag"),
    )
    return checks.cohort_violations(
        rows, target="flag", ids=["l_orderkey", "stay_id"], unique="stay_id"
    )


@query(
    """WITH s AS (SELECT l_suppkey, CASE WHEN l_linenumber < 5 THEN 'train' WHEN l_linenumber = 5 THEN 'validation'
 ELSE 'test' END AS split FROM lineitem)
 SELECT 'train-validation' AS split_pair, (SELECT count(*) FROM (SELECT l_suppkey FROM s WHERE split = 'train'
   INTERSECT SELECT l_suppkey FROM s WHERE split = 'validation')) AS shared_entities
 UNION ALL SELECT 'train-test', (SELECT count(*) FROM (SELECT l_suppkey FROM s WHERE split = 'train'
   INTERSECT SELECT l_suppkey FROM s WHERE split = 'test'))
 UNION ALL SELECT 'validation-test', (SELECT count(*) FROM (SELECT l_suppkey FROM s WHERE split = 'validation'
   INTERSECT SELECT l_suppkey FROM s WHERE split = 'test'))"""
)
def split_leakage(t):
    """A row-level split leaks suppliers; the table says how many per pair."""
    line = F.col("l_linenumber")
    rows = t.lineitem.select(
        "l_suppkey",
        F.when(line < 5, "train")
        .when(line == 5, "validation")
        .otherwise("test")
        .alias("split"),
    )
    return checks.split_leakage(rows, entity="l_suppkey")


@query(
    """WITH p AS (SELECT CASE WHEN event_id % 19 = 0 THEN NULL ELSE value / 300 END AS p FROM events)
 SELECT 'missing' AS rule, count(*) FILTER (p IS NULL) AS violations FROM p
 UNION ALL SELECT 'not_finite', CAST(0 AS BIGINT)
 UNION ALL SELECT 'outside_unit_interval', count(*) FILTER (p < 0 OR p > 1) FROM p"""
)
def bad_probabilities(t):
    scored = t.events.select(
        F.when(F.col("event_id") % 19 != 0, F.col("value") / 300).alias("p")
    )
    return checks.probability_violations(scored, probability="p")


@query(
    f"""WITH {star.COHORT_SQL}
 SELECT 'icu_out_before_icu_in' AS rule, count(*) FILTER (outtime < intime) AS violations FROM cohort
 UNION ALL SELECT 'hospital_discharge_before_admission', count(*) FILTER (dischtime < admittime) FROM cohort
 UNION ALL SELECT 'icu_in_before_hospital_admission', count(*) FILTER (intime < admittime) FROM cohort
 UNION ALL SELECT 'icu_in_after_hospital_discharge', count(*) FILTER (intime > dischtime) FROM cohort"""
)
def temporal_violations(t):
    return checks.temporal_violations(star.order_cohort(t))


@query(
    f"""WITH {star.USER_COHORT_SQL}
 SELECT count(*) AS total_rows, count(*) FILTER (prediction_time <= intime) AS invalid_windows,
 min(date_diff('second', intime, prediction_time)) AS minimum_window_seconds,
 max(date_diff('second', intime, prediction_time)) AS maximum_window_seconds FROM base_cohort"""
)
def window_validation(t):
    return checks.window_validation(star.user_cohort(t))


# --- cohort ----------------------------------------------------------------------------------


@query(
    f"WITH {star.STAYS_SQL} SELECT hadm_id, stay_id, intime, outtime, first_careunit, last_careunit "
    "FROM (SELECT *, row_number() OVER (PARTITION BY hadm_id ORDER BY intime, stay_id, l_partkey, l_suppkey, "
    "l_extendedprice) AS rn FROM stays WHERE intime IS NOT NULL) WHERE rn = 1"
)
def first_child_row_number(t):
    """The SQL form: rank 1 by start time inside each admission."""
    known = star.stays_of_orders(t).where(F.col("intime").isNotNull())
    return cohort.first_child(
        known, parent="hadm_id", order=["intime", *star.STAY_TIES]
    ).drop(*star.STAY_TIES[1:])


@query(
    f"WITH {star.STAYS_SQL} SELECT hadm_id, stay_id, intime, outtime, first_careunit, last_careunit FROM first_stay"
)
def first_child_total_order(t):
    """Total order with unknown start times last."""
    return cohort.first_stay(star.stays_of_orders(t), tie=star.STAY_TIES).drop(
        *star.STAY_TIES[1:]
    )


_JOINED = (
    "hadm_id, stay_id, subject_id, intime, outtime, admittime, dischtime, "
    "admission_type, insurance, gender, anchor_age, hospital_expire_flag"
)


@query(f"WITH {star.COHORT_SQL} SELECT {_JOINED} FROM joined")
def cohort_join(t):
    """Stay with its admission (one to one) and patient (many to one), both asserted."""
    return star.joined_cohort(t, checked=False).select(*_JOINED.split(", "))


@query(
    f"WITH {star.COHORT_SQL} SELECT subject_id, hadm_id, stay_id, anchor_age, intime FROM cohort"
)
def inclusion_filter(t):
    kept = star.joined_cohort(t).where(cohort.inclusion_mask())
    return kept.select("subject_id", "hadm_id", "stay_id", "anchor_age", "intime")


@query(
    "SELECT o_orderkey AS stay_id, o_orderdate AS intime, o_orderdate + INTERVAL 24 HOUR AS prediction_time FROM orders"
)
def prediction_time(t):
    starts = t.orders.select(
        F.col("o_orderkey").alias("stay_id"), F.col("o_orderdate").alias("intime")
    )
    return cohort.with_prediction_time(starts)


_BASE = (
    "subject_id, hadm_id, stay_id, intime, prediction_time, outtime, gender, anchor_age, "
    "admission_type, admission_location, insurance, marital_status, race, first_careunit, hospital_expire_flag"
)


@query(f"WITH {star.COHORT_SQL} SELECT {_BASE} FROM cohort")
def base_cohort(t):
    """The fixed 15-column cohort."""
    return cohort.base_cohort(star.order_cohort(t))


@query(
    f"""WITH {star.COHORT_SQL} SELECT intime, gender, anchor_age, admission_type, admission_location, insurance,
 marital_status, race, first_careunit, admittime FROM cohort"""
)
def predictor_projection(t):
    """Ids, target and after-outcome columns are removed if present."""
    return cohort.predictor_columns(star.order_cohort(t), also_exclude=["last_careunit"])


# --- dictionaries and events --------------------------------------------------------------------


@query(
    f"WITH {star.EVENT_TABLES_SQL} SELECT itemid, label, abbreviation, category, unitname FROM d_items WHERE "
    + " OR ".join(f"lower(label) LIKE '%{f}%'" for f in VITAL_SEARCH_FRAGMENTS)
)
def dictionary_search(t):
    return events.search_dictionary(star.d_items(t), VITAL_SEARCH_FRAGMENTS)


def _rule_sql(rule) -> str:
    tests = [f"lower(label) = '{e}'" for e in rule.exact]
    tests += [f"lower(label) LIKE '%{c}%'" for c in rule.contains]
    tests += [f"lower(label) LIKE '{p}%'" for p in rule.prefix]
    return " OR ".join(tests)


def _name_sql(rules) -> str:
    arms = " ".join(f"WHEN {_rule_sql(r)} THEN '{r.name}'" for r in rules)
    return f"CASE {arms} END"


@query(
    f"WITH {star.EVENT_TABLES_SQL} SELECT itemid, label, fluid, category FROM d_labitems "
    f"WHERE {_name_sql(LAB_RULES)} IS NOT NULL"
)
def dictionary_lookup(t):
    return events.lookup_dictionary(star.d_labitems(t), LAB_RULES)


WINDOWED_SQL = f"""{star.USER_COHORT_SQL},
{star.EVENT_TABLES_SQL}"""

VITALS_SQL = f"""{WINDOWED_SQL},
standardized AS (
  SELECT c.stay_id, ce.charttime, {_name_sql(VITAL_RULES)} AS vital_name,
   CASE WHEN lower(label) LIKE '%temperature%' AND (lower(coalesce(unitname, '')) LIKE '%f%'
        OR lower(label) LIKE '%fahrenheit%' OR ce.valuenum > 70)
        THEN (ce.valuenum - CAST(32 AS DOUBLE)) * CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)
        ELSE ce.valuenum END AS standardized_value
  FROM base_cohort c JOIN chartevents ce ON c.stay_id = ce.stay_id
   AND ce.charttime >= c.intime AND ce.charttime <= c.prediction_time
  JOIN d_items di ON ce.itemid = di.itemid
  WHERE ce.valuenum IS NOT NULL AND {_name_sql(VITAL_RULES)} IS NOT NULL),
cleaned AS (
  SELECT stay_id, charttime, vital_name, CASE {
    ' '.join(f"WHEN vital_name = '{n}' AND standardized_value BETWEEN {lo} AND {hi} THEN standardized_value"
             for n, (lo, hi) in PLAUSIBLE_BOUNDS.items())} END AS value
  FROM standardized)"""

LABS_SQL = f"""labs AS (
  SELECT c.stay_id, le.charttime, {_name_sql(LAB_RULES)} AS lab_name, le.valuenum AS value
  FROM base_cohort c JOIN labevents le ON c.hadm_id = le.hadm_id
   AND le.charttime >= c.intime AND le.charttime <= c.prediction_time
  JOIN d_labitems dl ON le.itemid = dl.itemid
  WHERE le.valuenum IS NOT NULL AND {_name_sql(LAB_RULES)} IS NOT NULL)"""


@query(
    f"""WITH {WINDOWED_SQL} SELECT c.stay_id, ce.itemid, ce.charttime, ce.valuenum
 FROM base_cohort c JOIN chartevents ce ON c.stay_id = ce.stay_id
 AND ce.charttime >= c.intime AND ce.charttime <= c.prediction_time"""
)
def events_in_window(t):
    return events.events_in_window(star.user_cohort(t), star.chartevents(t))


@query(
    """SELECT o_orderkey AS hadm_id, l_partkey AS itemid, l_shipdate AS charttime, l_quantity AS valuenum,
 o_orderkey * 10 AS stay_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey
 AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY"""
)
def child_events_in_window(t):
    """The other key path: events keyed by the admission, windowed by its start."""
    starts = t.orders.select(
        F.col("o_orderkey").alias("hadm_id"),
        (F.col("o_orderkey") * 10).alias("stay_id"),
        F.col("o_orderdate").alias("intime"),
    )
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_partkey").alias("itemid"),
        F.col("l_shipdate").alias("charttime"),
        F.col("l_quantity").alias("valuenum"),
    )
    return events.events_in_window(
        cohort.with_prediction_time(starts, hours=30 * 24),
        lines,
        key="hadm_id",
        carry=["stay_id"],
    )


@query(
    f"WITH {VITALS_SQL} SELECT stay_id, charttime, vital_name, round(standardized_value, 6) AS standardized_value "
    "FROM standardized"
)
def standardized_events(t):
    return rounded(
        features.standardized_vitals(
            star.user_cohort(t), star.chartevents(t), star.d_items(t)
        )
    )


@query(f"WITH {WINDOWED_SQL}, {LABS_SQL} SELECT stay_id, charttime, lab_name, value FROM labs")
def standardized_labs(t):
    return features.standardized_labs(
        star.user_cohort(t), star.labevents(t), star.d_labitems(t)
    )


@query(
    f"""WITH {star.EVENT_TABLES_SQL} SELECT ce.itemid, {_name_sql(VITAL_RULES)} AS name, count(*) AS n,
 round(sum(CASE WHEN lower(label) LIKE '%temperature%' AND (lower(coalesce(unitname, '')) LIKE '%f%'
        OR lower(label) LIKE '%fahrenheit%' OR ce.valuenum > 70)
        THEN (ce.valuenum - CAST(32 AS DOUBLE)) * CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)
        ELSE ce.valuenum END), 4) AS total
 FROM chartevents ce JOIN d_items di ON ce.itemid = di.itemid
 WHERE ce.valuenum IS NOT NULL AND {_name_sql(VITAL_RULES)} IS NOT NULL GROUP BY 1, 2"""
)
def unit_conversion(t):
    """Fahrenheit to Celsius by unit, by label and by magnitude, over all events."""
    dictionary = events.mapped_dictionary(
        star.d_items(t), VITAL_RULES, unit="unitname", units=TEMPERATURE_UNITS
    )
    converted = events.standardize(
        star.chartevents(t), dictionary, units=TEMPERATURE_UNITS
    )
    totals = converted.groupBy("itemid", "name").agg(
        F.count("*").alias("n"), F.sum("standardized_value").alias("total")
    )
    return rounded(totals, 4)


@query(
    """SELECT event_id, event_type, CASE WHEN event_type = 'view' AND value BETWEEN 5 AND 200 THEN value
 WHEN event_type = 'click' AND value BETWEEN 1 AND 100 THEN value END AS value FROM events"""
)
def plausibility_clean(t):
    bounds = {"view": (5.0, 200.0), "click": (1.0, 100.0)}
    return t.events.select(
        "event_id",
        "event_type",
        plausible(F.col("event_type"), F.col("value"), bounds).alias("value"),
    )


@query(
    f"""WITH {VITALS_SQL} SELECT vital_name, count(*) AS measurement_count,
 count(DISTINCT stay_id) AS stays_with_measurement FROM standardized GROUP BY 1"""
)
def event_coverage(t):
    mapped = features.standardized_vitals(
        star.user_cohort(t), star.chartevents(t), star.d_items(t)
    )
    return profile.event_coverage(mapped, name="vital_name", entity="stay_id")


@query(
    f"""WITH {WINDOWED_SQL}, {LABS_SQL} SELECT lab_name, count(*) AS measurement_count,
 count(DISTINCT stay_id) AS stays_with_measurement FROM labs GROUP BY 1"""
)
def lab_event_coverage(t):
    mapped = features.standardized_labs(
        star.user_cohort(t), star.labevents(t), star.d_labitems(t)
    )
    return profile.event_coverage(mapped, name="lab_name", entity="stay_id")


def _cleaned(t):
    return features.cleaned_vitals(
        star.user_cohort(t), star.chartevents(t), star.d_items(t)
    )


@query(
    f"""WITH {VITALS_SQL} SELECT vital_name, count(*) AS total_mapped_measurements,
 count(*) FILTER (value IS NULL) AS excluded_measurements, count(value) AS retained_measurements
 FROM cleaned GROUP BY 1"""
)
def cleaning_summary(t):
    return profile.cleaning_summary(_cleaned(t), name="vital_name", value="value")


# --- features -----------------------------------------------------------------------------------


@query(
    f"""WITH {WINDOWED_SQL} SELECT c.stay_id, round(min(valuenum), 6) AS item_min, round(max(valuenum), 6) AS item_max,
 round(avg(valuenum), 6) AS item_mean FROM base_cohort c JOIN chartevents ce ON c.stay_id = ce.stay_id
 AND ce.charttime >= c.intime AND ce.charttime <= c.prediction_time WHERE ce.itemid = 16 GROUP BY 1"""
)
def item_window_stats(t):
    """min / max / mean of one item code inside the window."""
    return rounded(
        features.item_window_stats(
            star.user_cohort(t), star.chartevents(t), item_value=16, prefix="item"
        )
    )


def _vital_columns() -> str:
    parts = []
    for rule in VITAL_RULES:
        for stat, fn in (("min", "min"), ("max", "max"), ("mean", "avg")):
            parts.append(
                f"round({fn}(CASE WHEN vital_name = '{rule.name}' THEN value END), 6) AS {rule.name}_{stat}"
            )
    return ", ".join(parts)


def _lab_columns() -> str:
    parts = []
    for rule in LAB_RULES:
        pick = f"CASE WHEN lab_name = '{rule.name}' THEN value END"
        parts += [
            f"round(arg_min({pick}, charttime), 6) AS {rule.name}_first",
            f"round(min({pick}), 6) AS {rule.name}_min",
            f"round(max({pick}), 6) AS {rule.name}_max",
        ]
    return ", ".join(parts)


VITAL_FEATURES_SQL = (
    f"vital_features AS (SELECT stay_id, {_vital_columns()} FROM cleaned "
    "WHERE value IS NOT NULL GROUP BY stay_id)"
)
LAB_FEATURES_SQL = f"lab_features AS (SELECT stay_id, {_lab_columns()} FROM labs GROUP BY stay_id)"


@query(f"WITH {VITALS_SQL}, {VITAL_FEATURES_SQL} SELECT * FROM vital_features")
def vital_features(t):
    return rounded(features.vital_features(_cleaned(t)))


@query(f"WITH {WINDOWED_SQL}, {LABS_SQL}, {LAB_FEATURES_SQL} SELECT * FROM lab_features")
def lab_features(t):
    labs = features.standardized_labs(
        star.user_cohort(t), star.labevents(t), star.d_labitems(t)
    )
    return rounded(features.lab_features(labs))


ADMISSION_FEATURES = """CAST(hour(intime) AS BIGINT) AS icu_admission_hour,
 CASE WHEN extract('dow' FROM intime) IN (0, 6) THEN 1 ELSE 0 END AS weekend_admission,
 CASE WHEN upper(coalesce(admission_type, '')) LIKE '%EMER%' THEN 1 ELSE 0 END AS emergency_admission,
 CASE WHEN upper(coalesce(admission_location, '')) LIKE '%TRANSFER%' THEN 1 ELSE 0 END AS transfer_admission"""


@query(
    f"""WITH {star.ADMISSIONS_SQL}, a AS (SELECT hadm_id, admittime AS intime, admission_type, admission_location
 FROM admissions) SELECT *, {ADMISSION_FEATURES} FROM a"""
)
def admission_features(t):
    rows = star.admissions(t).select(
        "hadm_id",
        F.col("admittime").alias("intime"),
        "admission_type",
        "admission_location",
    )
    return features.admission_features(rows)


MODELING_SQL = f"""{VITALS_SQL}, {LABS_SQL}, {VITAL_FEATURES_SQL}, {LAB_FEATURES_SQL},
modeling AS (
  SELECT a.*, {ADMISSION_FEATURES}, v.* EXCLUDE (stay_id), l.* EXCLUDE (stay_id)
  FROM base_cohort a LEFT JOIN vital_features v ON a.stay_id = v.stay_id
  LEFT JOIN lab_features l ON a.stay_id = l.stay_id)"""


def _modeling(t):
    return features.build_modeling_cohort(
        star.user_cohort(t),
        star.chartevents(t),
        star.d_items(t),
        star.labevents(t),
        star.d_labitems(t),
    )


@query(f"WITH {MODELING_SQL} SELECT * FROM modeling")
def modeling_cohort(t):
    """The whole feature build: cohort, window joins, names, bounds, wide features."""
    return rounded(_modeling(t))


@query(
    f"""WITH {MODELING_SQL} SELECT (SELECT count(*) FROM base_cohort) AS rows_before, count(*) AS rows_after,
 count(stay_id) - count(DISTINCT stay_id) AS stay_id_repeated,
 count(hadm_id) - count(DISTINCT hadm_id) AS hadm_id_repeated FROM modeling"""
)
def feature_join_integrity(t):
    return checks.join_integrity(
        star.user_cohort(t), _modeling(t), keys=["stay_id", "hadm_id"]
    )


MEASURED = [f"{r.name}_{s}" for r in VITAL_RULES for s in ("min", "max", "mean")] + [
    f"{r.name}_{s}" for r in LAB_RULES for s in ("first", "min", "max")
]


@query(
    f"WITH {MODELING_SQL}, m AS MATERIALIZED (SELECT * FROM modeling) "
    + _unpivoted(
        "m",
        MEASURED,
        lambda c: f"count(*) FILTER ({c} IS NULL) AS missing_count, "
        f"round(count(*) FILTER ({c} IS NULL) * CAST(100 AS DOUBLE) / count(*), 2) AS missing_percentage",
    )
)
def feature_missingness(t):
    return profile.missing_summary(_modeling(t), MEASURED).drop("data_type")


@query(
    f"WITH {star.USER_COHORT_SQL} SELECT 'vital_signs' AS feature_group, CAST(18 AS INTEGER) AS number_of_features, "
    "(SELECT count(*) FROM base_cohort) AS table_rows UNION ALL SELECT 'laboratory_values', 36, "
    "(SELECT count(*) FROM base_cohort)"
)
def feature_group_counts(t):
    return profile.feature_group_counts(
        _modeling(t),
        {
            "vital_signs": features.rule_names(VITAL_RULES),
            "laboratory_values": features.rule_names(LAB_RULES),
        },
    )


@query(
    f"""WITH {MODELING_SQL}, m AS (SELECT *, 1 AS always_one FROM modeling)
 SELECT feature FROM (SELECT 'always_one' AS feature, min(always_one) IS NOT DISTINCT FROM max(always_one) AS same FROM m
 UNION ALL SELECT 'anchor_age', min(anchor_age) IS NOT DISTINCT FROM max(anchor_age) FROM m
 UNION ALL SELECT 'weekend_admission', min(weekend_admission) IS NOT DISTINCT FROM max(weekend_admission) FROM m
 UNION ALL SELECT 'spo2_max', min(spo2_max) IS NOT DISTINCT FROM max(spo2_max) FROM m) WHERE same"""
)
def constant_features(t):
    rows = _modeling(t).withColumn("always_one", F.lit(1))
    return profile.constant_columns(
        rows, ["always_one", "anchor_age", "weekend_admission", "spo2_max"]
    )
