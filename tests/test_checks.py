import pytest
from pyspark.sql import functions as F

from stayledger.operators import checks, profile
from tests.conftest import FEATURES


def test_good_cohort_passes(clinical):
    checks.validate_cohort(clinical)
    checks.require_features(clinical, FEATURES)


def test_duplicate_stay_raises(clinical):
    broken = clinical.withColumn(
        "stay_id", F.when(F.col("stay_id") == 3001, 3000).otherwise(F.col("stay_id"))
    )
    with pytest.raises(ValueError, match="not unique"):
        checks.validate_unique(broken)
    with pytest.raises(ValueError, match="stay_id_repeated"):
        checks.validate_cohort(broken)


def test_missing_key_raises(clinical):
    broken = clinical.withColumn("stay_id", F.when(F.col("stay_id") > 3000, F.col("stay_id")))
    with pytest.raises(ValueError, match="missing"):
        checks.validate_unique(broken)


def test_target_must_be_binary(clinical):
    three = clinical.withColumn(
        "hospital_expire_flag",
        F.when(F.col("stay_id") == 3000, 3).otherwise(F.col("hospital_expire_flag")),
    )
    with pytest.raises(ValueError, match="non-binary"):
        checks.validate_binary_target(three)
    gone = clinical.withColumn(
        "hospital_expire_flag",
        F.when(F.col("stay_id") > 3000, F.col("hospital_expire_flag")),
    )
    with pytest.raises(ValueError, match="missing"):
        checks.validate_binary_target(gone)


def test_columns_and_features(clinical):
    with pytest.raises(ValueError, match="missing required columns"):
        checks.require_columns(clinical, ["stay_id", "absent"])
    with pytest.raises(ValueError):
        checks.require_features(clinical, ["absent"])


def test_splits_are_disjoint_or_raise(splits):
    train, validation, test = splits
    checks.validate_patient_split(train, validation, test)
    leaked = validation.withColumn(
        "subject_id", F.when(F.col("stay_id") == 3050, 1000).otherwise(F.col("subject_id"))
    )
    with pytest.raises(ValueError, match="train-validation"):
        checks.validate_patient_split(train, leaked, test)


@pytest.mark.parametrize(
    "values, ok",
    [
        ([0.01, 0.2, 0.5, 0.9], True),
        ([0.2, 1.2], False),
        ([0.2, -0.1], False),
        ([0.2, float("nan")], False),
        ([0.2, float("inf")], False),
        ([0.2, None], False),
    ],
)
def test_probabilities(spark, values, ok):
    df = spark.createDataFrame([(v,) for v in values], "p double")
    if ok:
        checks.validate_probabilities(df, probability="p")
    else:
        with pytest.raises(ValueError):
            checks.validate_probabilities(df, probability="p")


def test_window_start_gate(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS intime")
    with pytest.raises(ValueError, match="intime"):
        checks.validate_window_start(df)


def test_temporal_rules_ignore_missing_times(spark):
    df = spark.sql(
        """SELECT TIMESTAMP_NTZ'2020-01-02' AS intime, TIMESTAMP_NTZ'2020-01-01' AS outtime,
        TIMESTAMP_NTZ'2020-01-03' AS admittime, CAST(NULL AS TIMESTAMP_NTZ) AS dischtime"""
    )
    got = {r["rule"]: r["violations"] for r in checks.temporal_violations(df).collect()}
    assert got == {
        "icu_out_before_icu_in": 1,
        "hospital_discharge_before_admission": 0,
        "icu_in_before_hospital_admission": 1,
        "icu_in_after_hospital_discharge": 0,
    }
    with pytest.raises(ValueError):
        checks.validate_temporal(df)


def test_summaries(clinical):
    got = {
        r["metric"]: r["value"]
        for r in profile.compact_summary(
            clinical, patient="subject_id", stay="stay_id", target="hospital_expire_flag"
        ).collect()
    }
    assert got["rows"] == got["unique_patients"] == got["unique_stays"] == 80
    assert got["deaths"] + got["survivors"] == 80
    assert got["mortality_rate"] == pytest.approx(got["deaths"] / 80)


def test_missing_counts_nan_and_null(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "b")], "x double, c string"
    )
    got = {r["feature"]: r for r in profile.missing_summary(df, distinct=True).collect()}
    assert (got["x"]["missing_count"], got["x"]["unique_non_missing_values"]) == (2, 2)
    assert (got["c"]["missing_percentage"], got["c"]["data_type"]) == (25.0, "string")


def test_missing_by_outcome(spark):
    rows = [(0, None), (0, 1), (1, None), (1, None)]
    df = spark.createDataFrame(rows, "y int, x int")
    r = profile.missing_by_outcome(df, ["x"], target="y").first()
    assert (r["survivor_missing_pct"], r["death_missing_pct"]) == (50.0, 100.0)
    assert r["absolute_difference_pct"] == 50.0


def test_inclusion_report(clinical):
    mask = F.col("anchor_age") >= 40
    got = {
        r["metric"]: r["value"]
        for r in profile.inclusion_report(
            clinical, mask, patient="subject_id", admission="hadm_id", stay="stay_id"
        ).collect()
    }
    assert got["rows_before_filtering"] == 80
    assert got["rows_after_filtering"] + got["rows_removed"] == 80
    assert got["patients_after_filtering"] == got["rows_after_filtering"]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 3, None)], "a int, b int, c int")
    got = {r["feature"] for r in profile.constant_columns(df, ["a", "b", "c"]).collect()}
    assert got == {"a", "c"}
