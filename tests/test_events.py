"""Hand-made hospital tables through the cohort, event and feature operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stayledger.config import LAB_RULES, TEMPERATURE_UNITS, VITAL_RULES
from stayledger.functions import (
    age_band,
    contains_flag,
    first_matching_rule,
    is_weekend,
    knuth_hash,
    ratio_or_null,
    snake_name,
)
from stayledger.operators import cohort, events, features
from stayledger.plans import catalog
from stayledger.sources.tables import SCHEMAS


def table(spark, name, rows):
    """Rows with text times, typed by the source schema."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(SCHEMAS[name])
    text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if "time" in f.name else f.dataType)
            for f in schema.fields
        ]
    )
    df = spark.createDataFrame(rows, text)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@pytest.fixture(scope="module")
def hospital(spark):
    patients = table(spark, "patients", [(1, "F", 70), (2, "M", 17), (3, "F", 40), (4, "M", 50)])
    admissions = table(
        spark,
        "admissions",
        [
            (1, 11, "2020-01-03 00:00:00", "2020-01-20 00:00:00", None, "EW EMER.", "TRANSFER FROM HOSPITAL", "A", None, "R1", 1),
            (2, 12, "2020-01-03 00:00:00", "2020-01-20 00:00:00", None, "URGENT", None, "A", None, "R1", 0),
            (3, 13, "2020-01-05 00:00:00", "2020-01-20 00:00:00", None, None, "CLINIC", "A", None, "R2", 0),
            (4, 14, "2020-01-06 00:00:00", "2020-01-20 00:00:00", None, "ELECTIVE", "CLINIC", "B", None, "R2", 0),
        ],
    )
    stays = table(
        spark,
        "icustays",
        [
            # equal start times: the smaller stay id wins; an unknown start comes last
            (1, 11, 102, "MICU", "MICU", "2020-01-04 10:00:00", "2020-01-08 00:00:00"),
            (1, 11, 101, "SICU", "MICU", "2020-01-04 10:00:00", "2020-01-06 00:00:00"),
            (1, 11, 100, "SICU", "MICU", None, "2020-01-06 00:00:00"),
            (2, 12, 103, "MICU", "MICU", "2020-01-04 00:00:00", "2020-01-06 00:00:00"),
            (3, 13, 104, "MICU", "MICU", "2020-01-05 23:00:00", "2020-01-09 00:00:00"),
            (4, 14, 105, "MICU", "MICU", None, "2020-01-09 00:00:00"),
        ],
    )
    items = table(
        spark,
        "d_items",
        [
            (1, "Heart Rate", "HR", "c", "bpm"),
            (2, "Temperature Fahrenheit", "T", "c", None),
            (3, "Temperature", "T", "c", "Deg F"),
            (4, "Temperature Celsius", "T", "c", "Deg C"),
            (5, "Arterial Blood Pressure mean", "ABPm", "c", "mmHg"),
            (6, "Weight", "W", "c", "kg"),
        ],
    )
    labs = table(spark, "d_labitems", [(50, "Creatinine", "b", "c"), (51, "Lactate", "b", "c"), (52, "Bilirubin, Total", "b", "c"), (53, "Magnesium", "b", "c")])
    chart = table(
        spark,
        "chartevents",
        [
            (101, 1, "2020-01-04 10:00:00", 80.0),  # exactly at the start: kept
            (101, 1, "2020-01-05 10:00:00", 100.0),  # exactly at the end: kept
            (101, 1, "2020-01-05 10:00:01", 300.0),  # a second later: dropped
            (101, 1, "2020-01-04 12:00:00", 301.0),  # implausible
            (101, 1, "2020-01-04 13:00:00", None),
            (101, 2, "2020-01-04 12:00:00", 98.6),
            (101, 3, "2020-01-04 12:00:00", 50.0),  # 10 C: converted, then implausible
            (101, 4, "2020-01-04 12:00:00", 104.0),  # above 70: converted to 40
            (101, 4, "2020-01-04 12:30:00", 36.0),
            (101, 6, "2020-01-04 12:00:00", 70.0),  # not mapped
            (102, 1, "2020-01-04 12:00:00", 60.0),  # not the first stay
            (104, 5, "2020-01-06 00:00:00", 5.0),  # only implausible values
        ],
    )
    lab = table(
        spark,
        "labevents",
        [
            (11, 51, "2020-01-04 11:00:00", 4.0),
            (11, 50, "2020-01-04 12:00:00", 2.0),  # first creatinine comes after another lab
            (11, 50, "2020-01-04 13:00:00", 1.0),
            (11, 53, "2020-01-04 13:00:00", 9.0),
            (11, 52, "2020-01-04 13:00:00", 0.5),
            (13, 50, "2020-01-05 22:59:59", 7.0),  # before the window
        ],
    )
    return patients, admissions, stays, items, labs, chart, lab


def test_first_stay_total_order(hospital):
    first = {r["hadm_id"]: r["stay_id"] for r in cohort.first_stay(hospital[2]).collect()}
    assert first == {11: 101, 12: 103, 13: 104, 14: 105}


def test_build_cohort(hospital):
    built = cohort.build_cohort(*hospital[:3])
    rows = {r["stay_id"]: r for r in built.collect()}
    assert set(rows) == {101, 104}  # 17 years old and unknown start are excluded
    gap = rows[101]["prediction_time"] - rows[101]["intime"]
    assert gap.total_seconds() == 24 * 3600
    assert len(cohort.base_cohort(built).columns) == 15
    kept = cohort.predictor_columns(built).columns
    assert "outtime" not in kept and "deathtime" not in kept and "gender" in kept


def test_join_keys_must_be_unique(spark):
    left = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    right = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        cohort.join_one_to_one(left, right, ["a", "b"])
    with pytest.raises(ValueError):
        cohort.join_many_to_one(right, left, ["a"])


def test_cohort_join_asserts_its_joins(spark, tmp_path):
    orders = [(k, c, "F", "1-URGENT", datetime(2020, 1, 1)) for k, c in ((1, 7), (2, 7), (3, None), (None, 7), (None, 7))]
    customers = [(7, 1, 4000.0, "A"), (8, 2, 5000.0, "B"), (None, 3, 0.0, "C"), (None, 3, 0.0, "C")]
    lines = [(k, n, 1, 1, 5.0, 10.0, datetime(2020, 1, 2), "R", "O") for k in (1, 2, 3, None) for n in (1, 2)]

    def joined(name, orders, customers):
        tables = {
            "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
            "customer": (customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
            "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                         "l_extendedprice double, l_shipdate timestamp, l_returnflag string, l_linestatus string"),
        }
        for table, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/{table}.parquet")
        return catalog.QUERIES["cohort_join"](spark, f"{tmp_path}/{name}")

    # missing keys match nothing, so they may repeat
    found = joined("fine", orders, customers).collect()
    assert sorted((r["hadm_id"], r["stay_id"], r["subject_id"], r["anchor_age"]) for r in found if r["subject_id"]) == [(1, 9, 7, 40), (2, 17, 7, 40)]
    assert [(r["hadm_id"], r["anchor_age"]) for r in found if r["subject_id"] is None] == [(3, None)]
    with pytest.raises(ValueError, match="right.hadm_id is not unique"):
        joined("orders", [*orders, orders[1]], customers)
    with pytest.raises(ValueError, match="right.subject_id is not unique"):
        joined("customers", orders, [*customers, customers[0]])
    # the queries that go on from the joined rows do not assert
    assert catalog.QUERIES["inclusion_filter"](spark, f"{tmp_path}/orders").count() == 3


def test_join_suffixes(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([(1, 3)], "a int, b int")
    assert cohort.join_one_to_one(left, right, ["a"]).columns == ["a", "b_icu", "b_admission"]


def test_modeling_cohort(hospital):
    patients, admissions, stays, items, labs, chart, lab = hospital
    base = cohort.base_cohort(cohort.build_cohort(patients, admissions, stays))
    rows = {
        r["stay_id"]: r
        for r in features.build_modeling_cohort(base, chart, items, lab, labs).collect()
    }
    one, other = rows[101], rows[104]
    assert (one["heart_rate_min"], one["heart_rate_max"], one["heart_rate_mean"]) == (80, 100, 90)
    assert one["temperature_c_min"] == 36.0
    assert one["temperature_c_max"] == pytest.approx(40.0)
    assert one["temperature_c_mean"] == pytest.approx((37 + 40 + 36) / 3)
    assert (one["creatinine_first"], one["creatinine_min"], one["creatinine_max"]) == (2, 1, 2)
    assert one["lactate_first"] == 4.0 and one["bilirubin_total_max"] == 0.5
    assert (one["weekend_admission"], one["emergency_admission"], one["transfer_admission"]) == (1, 1, 1)
    assert one["icu_admission_hour"] == 10
    # only implausible values, and a lab outside the window: all NULL, row kept
    assert other["map_min"] is None and other["creatinine_first"] is None
    assert (other["weekend_admission"], other["emergency_admission"]) == (1, 0)
    assert len(rows) == 2 and len(one) == 15 + 4 + 18 + 36


def test_same_result_whatever_the_join_strategy(hospital):
    patients, admissions, stays, items, _, chart, _ = hospital
    base = cohort.build_cohort(patients, admissions, stays)
    got = [
        sorted(map(tuple, events.events_in_window(base, chart, small=small).collect()), key=str)
        for small in (None, True, False)
    ]
    assert got[0] == got[1] == got[2]
    bounded = events.events_in_window(
        base, chart, time_bounds=("2020-01-01 00:00:00", "2020-02-01 00:00:00")
    )
    assert bounded.count() == len(got[0])


def test_dictionary_search_and_lookup(hospital):
    items, labs = hospital[3], hospital[4]
    assert events.search_dictionary(items, ["temperature"]).count() == 3
    assert events.lookup_dictionary(labs, LAB_RULES).count() == 3
    mapped = events.mapped_dictionary(items, VITAL_RULES, unit="unitname", units=TEMPERATURE_UNITS)
    always = {r["itemid"]: r["always_convert"] for r in mapped.collect()}
    assert always == {1: False, 2: True, 3: True, 4: False, 5: False}


def test_item_window_stats(hospital):
    patients, admissions, stays, *_, chart, _ = hospital
    base = cohort.build_cohort(patients, admissions, stays)
    row = features.item_window_stats(base, chart, item_value=1, prefix="heart_rate").first()
    assert (row["stay_id"], row["heart_rate_max"]) == (101, 301.0)


def test_first_rule_wins(spark):
    labels = ["HEART RATE", "SpO2", "Skin Temperature", "Oxygen saturation (x)", "other"]
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    got = [r[0] for r in df.select(first_matching_rule(F.col("label"), VITAL_RULES)).collect()]
    assert got == ["heart_rate", "spo2", "temperature_c", "spo2", None]


def test_scalars(spark):
    row = spark.sql("SELECT 49 AS a, 50 AS b, 70 AS c, CAST(NULL AS INT) AS d").select(
        *[age_band(F.col(c)).alias(c) for c in "abcd"],
        is_weekend(F.lit("2020-01-05").cast("timestamp_ntz")).alias("sunday"),
        is_weekend(F.lit("2020-01-06").cast("timestamp_ntz")).alias("monday"),
        contains_flag(F.lit(None).cast("string"), "EMER").alias("nothing"),
        ratio_or_null(F.lit(1), F.lit(0)).alias("ratio"),
        snake_name(F.lit("Tuned Random Forest")).alias("name"),
        knuth_hash(F.lit(10**12)).alias("hash"),
    ).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == ("18-49", "50-69", "70+", None)
    assert (row["sunday"], row["monday"], row["nothing"]) == (1, 0, 0)
    assert row["ratio"] is None and row["name"] == "tuned_random_forest"
    assert row["hash"] == (10**12 % 2**31) * 2654435761 % 2**32
