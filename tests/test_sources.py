import gzip
import json

import pytest
from pyspark.sql import functions as F

from stayledger.config import FeatureConfig
from stayledger.session import shared_folder
from stayledger.sources import tables


def test_gzip_csv_with_a_schema(spark, tmp_path):
    path = tmp_path / "icustays.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("stay_id,hadm_id,intime,los\n3,2,2150-01-02 03:04:05,1.5\n4,2,not a time,2\n")
    df = tables.read_source(spark, str(path), "icustays")
    assert df.columns == ["hadm_id", "stay_id", "intime"]
    rows = {r["stay_id"]: r for r in df.collect()}
    assert rows[3]["intime"].year == 2150 and rows[4]["intime"] is None


def test_landed_csv_keeps_cells_that_fail(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "id BIGINT, at TIMESTAMP_NTZ, x DOUBLE, name STRING, _rejects INT"
    for name, body in {
        "a": "1,2150-01-02 03:04:05,1.5,n/a,7\n2,never,,two,\n",
        "b": "x,2150-01-03 00:00:00,much,,q\n",
        "c": "",
    }.items():
        with gzip.open(source / f"{name}.csv.gz", "wt") as f:
            f.write("id,at,x,name,_rejects\n" + body)
    landed = tables.land_csv(spark, str(source), schema, str(tmp_path / "out"))
    rows = {r["id"]: r for r in landed.rows.collect()}
    assert landed.rows.columns == ["id", "at", "x", "name", "_rejects"]
    assert rows.keys() == {1, 2, None}
    assert (rows[1]["at"].year, rows[1]["x"], rows[1]["name"], rows[1]["_rejects"]) == (2150, 1.5, "n/a", 7)
    assert rows[2]["at"] is None and rows[2]["x"] is None and rows[2]["name"] == "two"
    cells = {(r["file"][-8:], r["column"], r["value"]) for r in landed.rejects.collect()}
    assert cells == {
        ("a.csv.gz", "at", "never"),
        ("b.csv.gz", "id", "x"),
        ("b.csv.gz", "x", "much"),
        ("b.csv.gz", "_rejects", "q"),
    }
    with pytest.raises(ValueError):
        tables.land_csv(spark, str(source), "id BIGINT, gone INT", str(tmp_path / "no"))
    partly = tables.land_csv(
        spark, str(source), "name STRING, gone INT", str(tmp_path / "part"), partial=True
    )
    assert partly.rows.columns == ["name"] and partly.rejects.count() == 0


def test_landed_csv_refuses_another_header(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("id,x\n1,2\n")
    (source / "b.csv").write_text("x,id\n3,4\n")
    with pytest.raises(Exception, match="header"):
        tables.land_csv(spark, str(source), "id BIGINT, x BIGINT", str(tmp_path / "out"))


def test_load_table_coerces_dates_that_exist(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("stay_id,intime\n1,2020-01-01 00:00:00\n2,oops\n")
    df = tables.load_table(spark, path)
    assert dict(df.dtypes)["intime"] == "timestamp_ntz"
    assert df.where("intime IS NULL").count() == 1
    raw = tables.load_table(spark, path, convert_dates=False)
    assert dict(raw.dtypes)["intime"] != "timestamp_ntz"


def test_missing_inputs_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="gone"):
        tables.require_paths(spark, {"gone": str(tmp_path / "none.csv")})
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, str(tmp_path / "none.csv"))


def test_split_store_prunes(spark, tmp_path):
    df = spark.range(10).select(
        "id", F.when(F.col("id") < 7, "train").when(F.col("id") < 9, "validation").otherwise("test").alias("split")
    )
    path = str(tmp_path / "splits")
    tables.write_splits(df, path)
    assert [p.count() for p in tables.load_splits(spark, path)] == [7, 2, 1]
    assert tables.load_split(spark, path, " VAL ").count() == 2
    assert tables.select_split(df, "valid").count() == 2
    plan = tables.load_split(spark, path, "test")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ValueError):
        tables.load_split(spark, path, "holdout")


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
def test_roundtrip(spark, tmp_path, format):
    df = spark.createDataFrame([(1, 0.1, "a"), (2, None, "b")], "id bigint, p double, c string")
    row = tables.roundtrip_check(df, str(tmp_path / format), keys=["id"], format=format).first()
    assert (row["rows_before"], row["rows_after"], row["id_repeated"], row["same_content"]) == (2, 2, 0, True)


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    texts = ["", None, "a\nb", "a\r\nb", 'say "x", y', " padded ", "back\\slash", "\\N", '"', "#", "null"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = tables.export_predictions(df, str(tmp_path / "texts")).orderBy("id").collect()
    assert [r["text"] for r in got] == texts


def test_metadata(spark, tmp_path):
    record = spark.createDataFrame([("forest", 0.5)], "model string, auprc double")
    assert tables.write_metadata(record, str(tmp_path / "m")).first() == record.first()


def test_view(spark):
    tables.register_view(spark.range(3), "three_rows")
    assert spark.sql("SELECT count(*) FROM three_rows").first()[0] == 3


def test_feature_config(tmp_path):
    path = tmp_path / "config.json"
    config = FeatureConfig("y", ("a", "b"), extra={"note": 1})
    config.save(path)
    assert FeatureConfig.load(path) == config
    path.write_text(json.dumps({"target_column": "y"}))
    with pytest.raises(ValueError, match="retained_feature_columns"):
        FeatureConfig.load(path)
    with pytest.raises(FileNotFoundError):
        FeatureConfig.load(tmp_path / "none.json")


def test_feature_config_through_spark(spark, tmp_path):
    config = FeatureConfig("y", ("a", "b"), extra={"note": "two words"})
    config.save(tmp_path / "config", spark)
    config.save(tmp_path / "config", spark)
    assert FeatureConfig.load(tmp_path / "config", spark) == config


def test_shared_folder_follows_the_setting(spark, tmp_path):
    assert shared_folder(spark) == shared_folder(spark)
