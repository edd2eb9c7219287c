import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from stayledger.operators import categories, prep
from tests.conftest import FEATURES


def stage(**options):
    return prep.build_preprocessor(FEATURES[:3], FEATURES[3:], **options)


def test_types(clinical):
    numeric, categorical = prep.infer_feature_types(
        clinical.withColumn("flag", F.lit(True)), [*FEATURES, "flag"]
    )
    assert numeric == [*FEATURES[:3], "flag"] and categorical == FEATURES[3:]
    with pytest.raises(ValueError):
        prep.infer_feature_types(clinical, ["absent"])


def test_no_gaps_and_names_match_width(splits):
    train, _, test = splits
    model = prep.fit_preprocessor(stage(), train)
    names = model.feature_names()
    assert names == [
        "numeric__anchor_age",
        "numeric__creatinine_first",
        "numeric__lactate_first",
        "numeric__missingindicator_creatinine_first",
        "categorical__gender_F",
        "categorical__gender_M",
        "categorical__admission_type_ELECTIVE",
        "categorical__admission_type_EMERGENCY",
        "categorical__admission_type_URGENT",
    ]
    named = prep.transform_features(model, test, keep=["stay_id"])
    assert named.columns == ["stay_id", *names]
    assert named.count() == test.count()
    gaps = named.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in names]).first()
    assert not any(gaps)
    vector = prep.transform_features(model, test, named=False).first()["features"]
    assert len(vector) == len(names)


def test_values_equal_numpy(splits):
    train, _, test = splits
    model = prep.fit_preprocessor(stage(), train)
    raw = np.array(
        [[np.nan if v is None else v for v in r] for r in train.orderBy("stay_id").select(*FEATURES[:3]).collect()]
    )
    filled = np.where(np.isnan(raw), np.nanmedian(raw, axis=0), raw)
    flags = np.isnan(raw[:, [1]]).astype(float)
    both = np.hstack([filled, flags])
    want = (both - both.mean(axis=0)) / both.std(axis=0)
    got = np.array(model.named(train.orderBy("stay_id")).toPandas().iloc[:, :4])
    assert np.allclose(got, want, atol=1e-12)


def test_unseen_category_is_all_zeros(splits):
    train, _, test = splits
    model = prep.fit_preprocessor(stage(), train)
    odd = test.withColumn("admission_type", F.lit("NEW_CATEGORY"))
    row = model.named(odd).first().asDict()
    assert [v for k, v in row.items() if k.startswith("categorical__admission_type")] == [0.0] * 3


def test_options(splits):
    train, *_ = splits
    plain = prep.fit_preprocessor(
        stage(add_numeric_missing_indicators=False, scale_numeric_features=False), train
    )
    assert not [c for c in plain.feature_names() if "missingindicator" in c]
    assert plain.named(train).first()["numeric__anchor_age"] == train.first()["anchor_age"]
    constant = prep.fit_preprocessor(stage(categorical_imputation_strategy="constant"), train)
    assert "categorical__gender_missing_value" in constant.feature_names()
    sparse = prep.fit_preprocessor(stage(sparse_output=True), train)
    dense = prep.fit_preprocessor(stage(), train)
    pick = lambda m: [r["features"].toArray().tolist() for r in m.transform(train).orderBy("stay_id").collect()]
    assert pick(sparse) == pick(dense)
    with pytest.raises(ValueError):
        stage(categorical_imputation_strategy="mean")


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5.0, "a"), (1.0, None, 6.0, "b")], "c double, e double, x double, k string"
    )
    model = prep.build_preprocessor(["c", "e", "x"], ["k"]).fit(df)
    row = model.named(df.orderBy("x")).first()
    assert row["numeric__c"] == 0.0 and "numeric__e" not in row
    assert row["numeric__missingindicator_e"] == 0.0 and row["numeric__x"] == -1.0


def test_too_many_categories_is_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    narrow = prep.TabularPreprocessor(categoricalCols=["k"], maxCategories=10)
    with pytest.raises(ValueError, match="categories"):
        narrow.fit(df)


@pytest.mark.parametrize("fill", ["most_frequent", "constant"])
def test_dictionary_equals_inline_categories(splits, tmp_path, fill):
    """Categories kept as a table give the vectors that expressions give."""
    train, _, test = splits
    odd = test.unionByName(test.limit(3).withColumn("admission_type", F.lit("NEW_CATEGORY")).withColumn("stay_id", -F.col("stay_id")))
    pick = lambda m: [r["features"].toArray().tolist() for r in m.transform(odd).orderBy("stay_id").collect()]
    options = dict(numericCols=FEATURES[:3], categoricalCols=FEATURES[3:], categoricalFill=fill)
    inline = prep.TabularPreprocessor(**options).fit(train)
    for most in (1, 2):  # both columns in the table, and one of them
        table = prep.TabularPreprocessor(**options, inlineCategories=most).fit(train)
        assert any("size" in f for f in table.fitted["categorical"])
        assert table.feature_names() == inline.feature_names()
        placed = table.feature_table(train.sparkSession).orderBy("position").collect()
        assert [tuple(r) for r in placed] == list(enumerate(inline.feature_names()))
        assert pick(table) == pick(inline)
        assert table.named(odd).exceptAll(inline.named(odd)).count() == 0
        path = str(tmp_path / f"{fill}{most}")
        PipelineModel(stages=[table]).write().overwrite().save(path)
        again = PipelineModel.load(path).stages[0]
        assert again.getOrDefault("dictionaryPath").startswith(path)
        assert pick(again) == pick(inline)


def test_twenty_thousand_categories(spark):
    rows = spark.range(0, 60_000, 1, 4).select(
        (F.col("id") * 1.0).alias("x"), F.concat(F.lit("v"), F.col("id") % 20_000).alias("k"), "id"
    )
    model = prep.build_preprocessor(["x"], ["k"]).fit(rows.where("id < 40000"))
    order = sorted(f"v{i}" for i in range(20_000))
    assert model.dictionary(spark).orderBy("idx").toPandas()["value"].tolist() == order
    done = model.transform(rows).select("id", "k", "features")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    place = {v: i for i, v in enumerate(order)}
    for r in done.where("id % 997 = 0").collect():
        v = r["features"]
        assert v.size == 20_001 and place[r["k"]] + 1 in v.indices and v[place[r["k"]] + 1] == 1.0 and len(v.indices) <= 2


def test_codes_whatever_the_join(spark):
    """NULL, unknown, hot and empty values; broadcast, shuffled, and a clashing column."""
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4), ("new", 5), ("b", 6)], "k string, _value long")
    numbered = categories.category_dictionary(df.where("_value <> 5"), ["k"])
    assert [tuple(r) for r in numbered.orderBy("idx").collect()] == [("k", "", 0), ("k", "a", 1), ("k", "b", 2)]
    for small in (True, False, None):
        got = categories.category_codes(df, numbered, {"k": "code"}, small=small)
        assert got.columns == ["k", "_value", "code"]
        assert [r["code"] for r in got.orderBy("_value").collect()] == [1, 1, None, 0, None, 2]
    none = categories.category_dictionary(df.limit(0), ["k"])
    assert none.count() == 0 and categories.category_codes(df, none, {"k": "code"}).where("code is not null").count() == 0


def test_saved_model_transforms_alike(splits, tmp_path):
    train, _, test = splits
    model = prep.fit_preprocessor(stage(), train)
    path = str(tmp_path / "prep")
    PipelineModel(stages=[model]).write().overwrite().save(path)
    again = PipelineModel.load(path).stages[0]
    assert again.fitted == model.fitted
    assert model.named(test).exceptAll(again.named(test)).count() == 0


def test_imputation_values(splits):
    train, *_ = splits
    model = prep.fit_preprocessor(stage(), train)
    rows = {r["feature"]: r for r in prep.imputation_values(model, train).collect()}
    assert rows["creatinine_first"]["filled_rows"] == 3
    assert rows["gender"]["kind"] == "most_frequent" and rows["gender"]["filled_rows"] == 2


def test_vector_sums_need_no_whole_vector(spark):
    from pyspark.ml.linalg import Vectors

    vectors = [Vectors.sparse(10**9, [1, 999_999_999], [2.0, 3.0]), Vectors.sparse(10**9, [1], [0.5]), Vectors.sparse(10**9, [], []), Vectors.dense([7.0, 0.0]), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "id int, features struct<x:int>" if False else None or ["id", "features"])
    assert {(r["position"], r["total"]) for r in prep.vector_sums(df).collect()} == {(0, 7.0), (1, 2.5), (999_999_999, 3.0)}
