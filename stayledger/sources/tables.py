"""Readers and writers: explicit schemas, coerced dates, split stores, read-back."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stayledger.config import ROLES
from stayledger.session import stable

_SPLITS = {
    "train": "train",
    "validation": "validation",
    "valid": "validation",
    "val": "validation",
    "test": "test",
}

# Source schemas.
SCHEMAS: dict[str, str] = {
    "patients": "subject_id BIGINT, gender STRING, anchor_age INT",
    "admissions": (
        "subject_id BIGINT, hadm_id BIGINT, admittime TIMESTAMP_NTZ, "
        "dischtime TIMESTAMP_NTZ, deathtime TIMESTAMP_NTZ, admission_type STRING, "
        "admission_location STRING, insurance STRING, marital_status STRING, "
        "race STRING, hospital_expire_flag INT"
    ),
    "icustays": (
        "subject_id BIGINT, hadm_id BIGINT, stay_id BIGINT, first_careunit STRING, "
        "last_careunit STRING, intime TIMESTAMP_NTZ, outtime TIMESTAMP_NTZ"
    ),
    "chartevents": (
        "stay_id BIGINT, itemid INT, charttime TIMESTAMP_NTZ, valuenum DOUBLE"
    ),
    "labevents": (
        "hadm_id BIGINT, itemid INT, charttime TIMESTAMP_NTZ, valuenum DOUBLE"
    ),
    "d_items": (
        "itemid INT, label STRING, abbreviation STRING, category STRING, unitname STRING"
    ),
    "d_labitems": "itemid INT, label STRING, fluid STRING, category STRING",
}


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException:
        return False


def require_paths(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Check every input before any work; works on any file system Spark reads."""
    gone = {name: path for name, path in paths.items() if not _exists(spark, path)}
    if gone:
        raise FileNotFoundError(f"required inputs not found: {gone}")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    *,
    partial: bool = False,
    **options,
) -> DataFrame:
    """Header CSV (plain or gzip) with columns matched by name, not position.

    A column of the schema that the file lacks is an error, unless ``partial``.

    A gzip file is one task whatever its size: land it once as Parquet.
    """
    require_paths(spark, {"csv": path})
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    raw = spark.read.csv(path, header=True, **options)
    absent = [f.name for f in wanted.fields if f.name not in raw.columns]
    if absent and not partial:
        raise ValueError(f"{path} lacks the columns {absent}")
    return raw.select(
        *[
            F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name)
            for f in wanted.fields
            if f.name not in absent
        ]
    )


@dataclass(frozen=True)
class Landed:
    """A landed CSV table: its typed rows, and one row per cell that did not cast."""

    rows: DataFrame
    rejects: DataFrame


def land_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    folder: str,
    *,
    partial: bool = False,
    **options,
) -> Landed:
    """Land header CSV (plain or gzip) once as typed Parquet in ``folder``.

    Each file is decompressed by one task of its own, in one pass that casts the cells
    and keeps the text of those that fail.  The rejects (file, column, value) lie beside
    the typed columns and are read without them; their cells are NULL in the rows.  An
    empty cell is NULL and no reject.  All files must have the header of the first: one
    that differs stops the job.  A column of the schema that the files lack is an error,
    unless ``partial``.  Files with a header only give empty tables.
    """
    require_paths(spark, {"csv": path})
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = spark.read.csv(path, header=True, **options).columns
    absent = [f.name for f in wanted.fields if f.name not in names]
    if absent and not partial:
        raise ValueError(f"{path} lacks the columns {absent}")
    texts = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = spark.read.schema(texts).csv(path, header=True, enforceSchema=False, **options)
    kept = [f for f in wanted.fields if f.name not in absent]
    typed = {
        f.name: F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") for f in kept
    }
    failed = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull(),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.lit(f.name).alias("column"),
                F.col(f"`{f.name}`").alias("value"),
            ),
        )
        for f in kept
        if not isinstance(f.dataType, T.StringType)
    ]
    cells = F.array_compact(F.array(*failed)) if failed else F.array()
    aside = "_rejects"
    while aside in typed:
        aside += "_"
    (
        raw.select(
            *[c.alias(name) for name, c in typed.items()],
            cells.cast("array<struct<file:string,column:string,value:string>>").alias(aside),
        )
        .write.mode("overwrite")
        .parquet(folder)
    )
    landed = spark.read.parquet(folder)
    return Landed(
        landed.drop(aside),
        landed.where(F.size(aside) > 0).select(F.inline(aside)),
    )


def read_source(spark: SparkSession, path: str, table: str) -> DataFrame:
    # a source file may hold some of its table's columns; operators name what they need
    return read_csv(spark, path, SCHEMAS[table], partial=True)


def coerce_dates(df: DataFrame, columns: Sequence[str] = ROLES.dates) -> DataFrame:
    """Listed columns that exist become timestamps; unreadable text becomes NULL."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns(
        {c: F.expr(f"try_cast(`{c}` AS timestamp_ntz)") for c in present}
    )


def load_table(
    spark: SparkSession,
    path: str,
    *,
    format: str = "csv",
    schema: str | None = None,
    convert_dates: bool = True,
    date_columns: Sequence[str] = ROLES.dates,
    **options,
) -> DataFrame:
    """Read a saved table and coerce its date columns.

    Give CSV a schema; without one Spark reads the file an extra time to infer it.
    """
    require_paths(spark, {"table": path})
    reader = spark.read.format(format)
    if format == "csv":
        options = {"header": True, "inferSchema": schema is None, **options}
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    return coerce_dates(df, date_columns) if convert_dates else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


# --- split store ---------------------------------------------------------------------------


def split_alias(name: str) -> str:
    key = name.strip().lower()
    if key not in _SPLITS:
        raise ValueError("split must be train, validation/valid/val, or test")
    return _SPLITS[key]


def select_split(assigned: DataFrame, name: str, *, split: str = "split") -> DataFrame:
    return assigned.where(F.col(split) == split_alias(name))


def write_splits(assigned: DataFrame, path: str, *, split: str = "split") -> None:
    """One folder per split, so loading one prunes the others."""
    assigned.write.mode("overwrite").partitionBy(split).parquet(path)


def load_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    wanted = split_alias(name)
    require_paths(spark, {"splits": path})
    return spark.read.parquet(path).where(F.col("split") == wanted).drop("split")


def load_splits(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(load_split(spark, path, s) for s in ("train", "validation", "test"))


#: Text survives as it is: quotes doubled, line ends and blanks kept.
CSV_TEXT = {
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# --- writers ----------------------------------------------------------------------------------


def write_table(df: DataFrame, path: str, *, format: str = "parquet") -> str:
    """Write a table; in CSV a NULL is an empty field and an empty text is ``""``."""
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.options(header=True, **CSV_TEXT)
    writer.save(path)
    return path


def read_back(spark: SparkSession, path: str, like: DataFrame, *, format: str) -> DataFrame:
    """Read what ``write_table`` wrote; a CSV text may hold line ends, so a part file is one task."""
    if format == "csv":
        # the reader gives quoted empty fields this name, which tells them from NULL
        empty = uuid.uuid4().hex
        saved = read_csv(spark, path, like.schema, multiLine=True, emptyValue=empty, **CSV_TEXT)
        text = [f.name for f in saved.schema.fields if isinstance(f.dataType, T.StringType)]
        return saved.withColumns(
            {c: F.when(F.col(f"`{c}`") == empty, "").otherwise(F.col(f"`{c}`")) for c in text}
        )
    return spark.read.format(format).load(path)


def roundtrip_check(df: DataFrame, path: str, *, keys: Sequence[str], format: str = "parquet") -> DataFrame:
    """Write, reload and compare: rows, repeated keys, rows that differ either way."""
    spark = df.sparkSession
    df = stable(df)
    write_table(df, path, format=format)
    saved = read_back(spark, path, df, format=format)
    # the hash skips NULLs, so where they stand is hashed as well
    hashed = F.xxhash64(*df.columns, *[F.col(f"`{c}`").isNull() for c in df.columns])
    before = df.agg(
        F.count("*").alias("rows_before"), F.sum(hashed.cast("decimal(38,0)")).alias("h")
    )
    after = saved.select(*df.columns).agg(
        F.count("*").alias("rows_after"),
        F.sum(hashed.cast("decimal(38,0)")).alias("_h"),
        *[
            (F.count(k) - F.count_distinct(F.col(k))).alias(f"{k}_repeated")
            for k in keys
        ],
    )
    return after.select(
        before.select("rows_before").scalar().alias("rows_before"),
        "rows_after",
        *[f"{k}_repeated" for k in keys],
        F.col("_h").eqNullSafe(before.select("h").scalar()).alias("same_content"),
    )


def export_predictions(df: DataFrame, path: str, *, format: str = "csv") -> DataFrame:
    """Write predictions and return them as read back."""
    write_table(df, path, format=format)
    return read_back(df.sparkSession, path, df, format=format)


def write_metadata(record: DataFrame, path: str) -> DataFrame:
    """One-row run record as JSON; returned as read back."""
    record.coalesce(1).write.mode("overwrite").json(path)
    return record.sparkSession.read.schema(record.schema).json(path)
