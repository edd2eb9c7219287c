"""Preprocessing as a Spark ML stage, fitted on training rows only.

Numeric columns: exact median fill, missing indicators for columns that had
missing values at fit time, then population-sd scaling of both.  Categorical
columns: most-frequent (or constant) fill and one column per sorted category,
all zeros for a category not seen at fit time.  Columns not listed are dropped
from the vector.  The fitted model is a set of expressions in one projection;
categories of columns with more than ``inlineCategories`` values stay a table,
are joined and become sparse vectors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stayledger.operators import categories
from stayledger.operators.checks import require_columns
from stayledger.operators.profile import category_counts
from stayledger.operators.scale import exact_quantiles, fits_broadcast
from stayledger.session import shared_folder, stable

CONSTANT_FILL = "missing_value"
INLINE_CATEGORIES = 256


def infer_feature_types(
    df: DataFrame, columns: Sequence[str]
) -> tuple[list[str], list[str]]:
    """(numeric, categorical): numbers and booleans are numeric, all else not."""
    require_columns(df, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [
        c for c in columns if isinstance(types[c], (T.NumericType, T.BooleanType))
    ]
    return numeric, [c for c in columns if c not in numeric]


def _number(name: str) -> Column:
    """The column as double, NaN as NULL."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


class _PreprocessorParams(HasOutputCol):
    numericCols = Param(
        Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString
    )
    categoricalCols = Param(
        Params._dummy(), "categoricalCols", "category inputs", TypeConverters.toListString
    )
    addIndicators = Param(
        Params._dummy(), "addIndicators", "missing flags", TypeConverters.toBoolean
    )
    scale = Param(Params._dummy(), "scale", "standardise numbers", TypeConverters.toBoolean)
    categoricalFill = Param(
        Params._dummy(),
        "categoricalFill",
        "most_frequent or constant",
        TypeConverters.toString,
    )
    sparseOutput = Param(
        Params._dummy(), "sparseOutput", "compress vectors", TypeConverters.toBoolean
    )
    maxCategories = Param(
        Params._dummy(),
        "maxCategories",
        "error beyond this many one-hot columns, 0 for no limit",
        TypeConverters.toInt,
    )
    inlineCategories = Param(
        Params._dummy(),
        "inlineCategories",
        "a column with more categories keeps them in a table",
        TypeConverters.toInt,
    )


class TabularPreprocessor(
    Estimator, _PreprocessorParams, DefaultParamsReadable, DefaultParamsWritable
):
    @keyword_only
    def __init__(
        self,
        *,
        numericCols=(),
        categoricalCols=(),
        addIndicators=True,
        scale=True,
        categoricalFill="most_frequent",
        sparseOutput=False,
        maxCategories=0,
        inlineCategories=INLINE_CATEGORIES,
        outputCol="features",
    ):
        super().__init__()
        self._setDefault(
            numericCols=[],
            categoricalCols=[],
            addIndicators=True,
            scale=True,
            categoricalFill="most_frequent",
            sparseOutput=False,
            maxCategories=0,
            inlineCategories=INLINE_CATEGORIES,
            outputCol="features",
        )
        given = dict(self._input_kwargs)
        for key in ("numericCols", "categoricalCols"):
            if key in given:
                given[key] = list(given[key])
        self._set(**given)
        if self.getOrDefault("categoricalFill") not in ("most_frequent", "constant"):
            raise ValueError("categoricalFill must be 'most_frequent' or 'constant'")

    def _fit(self, df: DataFrame) -> TabularPreprocessorModel:
        numeric = self.getOrDefault("numericCols")
        categorical = self.getOrDefault("categoricalCols")
        require_columns(df, [*numeric, *categorical])
        found, path = self._fit_categorical(df, categorical)
        state = {**self._fit_numeric(df, numeric), "categorical": found}
        model = TabularPreprocessorModel(
            state=json.dumps(state),
            dictionaryPath=path,
            sparseOutput=self.getOrDefault("sparseOutput"),
            outputCol=self.getOrDefault("outputCol"),
        )
        return model

    def _fit_numeric(self, df: DataFrame, numeric: Sequence[str]) -> dict:
        if not numeric:
            return {"numeric": [], "indicators": []}
        numbers = df.select(*[_number(c).alias(f"n{i}") for i, c in enumerate(numeric)])
        medians = {
            r["feature"]: r["value"]
            for r in exact_quantiles(numbers, numbers.columns, [0.5]).collect()
        }
        sums = []
        for i, c in enumerate(numeric):
            x = F.col(f"n{i}")
            filled = F.coalesce(x, F.lit(medians.get(f"n{i}")).cast("double"))
            gone = x.isNull().cast("double")
            sums += [
                F.avg(filled).alias(f"m{i}"),
                F.stddev_pop(filled).alias(f"s{i}"),
                F.avg(gone).alias(f"gm{i}"),
                F.stddev_pop(gone).alias(f"gs{i}"),
            ]
        row = numbers.agg(*sums).first()
        scale = self.getOrDefault("scale")

        def centred(mean, sd):
            if not scale:
                return {"mean": 0.0, "sd": 1.0}
            flat = sd is None or sd <= 1e-14 * abs(mean or 0.0) or sd == 0.0
            return {"mean": mean or 0.0, "sd": 1.0 if flat else sd}

        # a column with no value at all at fit time has nothing to fill with
        values = [
            {"column": c, "median": medians[f"n{i}"], **centred(row[f"m{i}"], row[f"s{i}"])}
            for i, c in enumerate(numeric)
            if f"n{i}" in medians
        ]
        flags = [
            {"column": c, **centred(row[f"gm{i}"], row[f"gs{i}"])}
            for i, c in enumerate(numeric)
            if self.getOrDefault("addIndicators") and (row[f"gm{i}"] or 0.0) > 0
        ]
        return {"numeric": values, "indicators": flags}

    def _fit_categorical(
        self, df: DataFrame, categorical: Sequence[str]
    ) -> tuple[list[dict], str]:
        """What is fitted per column, and the folder of the columns' dictionary if any."""
        if not categorical:
            return [], ""
        counts = stable(category_counts(df, categorical))
        constant = self.getOrDefault("categoricalFill") == "constant"
        if constant:
            value = F.coalesce("value", F.lit(CONSTANT_FILL)).alias("value")
            counts = counts.groupBy("column_name", value).agg(F.sum("n").alias("n"))
        summary = {r["column_name"]: r for r in categories.category_summary(counts).collect()}
        limit = self.getOrDefault("maxCategories")
        if 0 < limit < sum(r["size"] for r in summary.values()):
            raise ValueError(f"more than {limit} categories to one-hot encode")
        inline = self.getOrDefault("inlineCategories")
        sizes = {c: summary[c]["size"] for c in categorical if c in summary}
        values: dict[str, list[str]] = {c: [] for c, n in sizes.items() if 0 < n <= inline}
        wide = [c for c, n in sizes.items() if n > inline]
        listed = counts.where(F.col("value").isNotNull() & F.col("column_name").isin(list(values)))
        for r in listed.collect():
            values[r["column_name"]].append(r["value"])
        path, small = "", True
        if wide:
            path = f"{shared_folder(df.sparkSession)}/dictionary-{uuid.uuid4().hex}"
            numbered = categories.number_categories(counts.where(F.col("column_name").isin(wide)))
            numbered.write.parquet(path)
            small = fits_broadcast(df.sparkSession.read.parquet(path))
        out = []
        for c in sizes:
            fill = CONSTANT_FILL if constant else summary[c]["top"]
            if c in values:
                out.append({"column": c, "fill": fill, "values": sorted(values[c])})
            elif c in wide:
                out.append({"column": c, "fill": fill, "size": sizes[c], "small": small})
        return out, path


class _ModelWriter(DefaultParamsWriter):
    """The dictionary is saved beside the parameters, so the saved model is whole."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        source = self.instance.getOrDefault("dictionaryPath")
        if source:
            self.sparkSession.read.parquet(source).write.parquet(f"{path}/dictionary")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str) -> TabularPreprocessorModel:
        model = super().load(path)
        if model.getOrDefault("dictionaryPath"):
            model._set(dictionaryPath=f"{path}/dictionary")
        return model


class TabularPreprocessorModel(
    Model, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)
    sparseOutput = Param(
        Params._dummy(), "sparseOutput", "compress vectors", TypeConverters.toBoolean
    )
    dictionaryPath = Param(
        Params._dummy(), "dictionaryPath", "folder of the dictionary", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, state="{}", sparseOutput=False, dictionaryPath="", outputCol="features"):
        super().__init__()
        self._setDefault(state="{}", sparseOutput=False, dictionaryPath="", outputCol="features")
        self._set(**self._input_kwargs)

    def write(self) -> _ModelWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> _ModelReader:
        return _ModelReader(cls)

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """(column_name, value, idx) of the columns whose categories are a table."""
        return spark.read.parquet(self.getOrDefault("dictionaryPath"))

    def _values(self, f: dict) -> list[str]:
        """A column's categories in order; as many as the vector has entries for it."""
        if "values" in f:
            return f["values"]
        own = self.dictionary(SparkSession.active()).where(F.col("column_name") == f["column"])
        return [r["value"] for r in sorted(own.collect(), key=lambda r: r["idx"])]

    def _columns(self, wide: bool = True) -> list[tuple[str, Column]]:
        """(output name, expression) in vector order, with or without dictionary columns."""
        fitted = self.fitted
        out = []
        for f in fitted["numeric"]:
            filled = F.coalesce(_number(f["column"]), F.lit(f["median"]))
            out.append(
                (f"numeric__{f['column']}", (filled - F.lit(f["mean"])) / F.lit(f["sd"]))
            )
        for f in fitted["indicators"]:
            gone = _number(f["column"]).isNull().cast("double")
            out.append(
                (
                    f"numeric__missingindicator_{f['column']}",
                    (gone - F.lit(f["mean"])) / F.lit(f["sd"]),
                )
            )
        for f in fitted["categorical"]:
            if "values" not in f and not wide:
                continue
            filled = F.coalesce(F.col(f"`{f['column']}`").cast("string"), F.lit(f["fill"]))
            out += [
                (f"categorical__{f['column']}_{v}", (filled == F.lit(v)).cast("double"))
                for v in self._values(f)
            ]
        return out

    def feature_names(self) -> list[str]:
        return [name for name, _ in self._columns()]

    def feature_table(self, spark: SparkSession) -> DataFrame:
        """(position, feature) of the vector's entries; dictionaries stay on the executors."""
        fitted = self.fitted
        singles = iter(name for name, _ in self._columns(wide=False))
        named, wide, at = [], [], 0
        for _ in (*fitted["numeric"], *fitted["indicators"]):
            named.append((at, next(singles)))
            at += 1
        for f in fitted["categorical"]:
            if "values" in f:
                named += [(at + i, next(singles)) for i in range(len(f["values"]))]
                at += len(f["values"])
            else:
                wide.append((f["column"], at))
                at += f["size"]
        out = spark.createDataFrame(named, "position long, feature string")
        for column, start in wide:
            own = self.dictionary(spark).where(F.col("column_name") == column)
            name = F.concat(F.lit(f"categorical__{column}_"), "value")
            out = out.union(own.select((F.col("idx") + start).alias("position"), name.alias("feature")))
        return out

    def named(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The transformed features as ordinary named columns."""
        return df.select(*keep, *[c.alias(name) for name, c in self._columns()])

    def _transform(self, df: DataFrame) -> DataFrame:
        output = self.getOrDefault("outputCol")
        if self.getOrDefault("dictionaryPath"):
            return self._transform_wide(df, output)
        expressions = [c for _, c in self._columns()]
        if not self.getOrDefault("sparseOutput"):
            return df.withColumn(output, array_to_vector(F.array(*expressions)))
        parts = [f"_f{i}" for i in range(len(expressions))]
        wide = df.select("*", *[c.alias(p) for p, c in zip(parts, expressions)])
        return VectorAssembler(inputCols=parts, outputCol=output).transform(wide).drop(*parts)

    def _transform_wide(self, df: DataFrame, output: str) -> DataFrame:
        """Blocks in vector order: expressions, and one sparse vector per dictionary column."""
        found = self.fitted["categorical"]
        tables = [f for f in found if "values" not in f]
        codes = {f["column"]: f"_code{i}" for i, f in enumerate(tables)}
        numbers = dict(self._columns(wide=False))
        singles = {name: f"_f{i}" for i, name in enumerate(numbers)}
        blocks = [singles[n] for n in numbers if not n.startswith("categorical__")]
        for f in found:
            if "values" in f:
                blocks += [singles[f"categorical__{f['column']}_{v}"] for v in f["values"]]
            else:
                blocks.append(f"{codes[f['column']]}_hot")
        wide = df.select("*", *[c.alias(singles[n]) for n, c in numbers.items()])
        coded = categories.category_codes(
            wide,
            self.dictionary(df.sparkSession),
            codes,
            fills={f["column"]: f["fill"] for f in tables},
            small=all(f["small"] for f in tables),
        )
        hot = categories.one_hot_codes(
            coded,
            {codes[f["column"]]: f["size"] for f in tables},
            {c: f"{c}_hot" for c in codes.values()},
        )
        joined = VectorAssembler(inputCols=blocks, outputCol=output).transform(hot).drop(*blocks)
        # one attribute per category would make the schema as wide as the dictionary
        return joined.withMetadata(output, {})


def build_preprocessor(
    numeric_features: Sequence[str],
    categorical_features: Sequence[str],
    *,
    add_numeric_missing_indicators: bool = True,
    scale_numeric_features: bool = True,
    categorical_imputation_strategy: str = "most_frequent",
    sparse_output: bool = False,
) -> TabularPreprocessor:
    return TabularPreprocessor(
        numericCols=list(numeric_features),
        categoricalCols=list(categorical_features),
        addIndicators=add_numeric_missing_indicators,
        scale=scale_numeric_features,
        categoricalFill=categorical_imputation_strategy,
        sparseOutput=sparse_output,
    )


def fit_preprocessor(
    preprocessor: TabularPreprocessor, train: DataFrame
) -> TabularPreprocessorModel:
    return preprocessor.fit(train)


def transform_features(
    model: TabularPreprocessorModel,
    df: DataFrame,
    *,
    keep: Sequence[str] = (),
    named: bool = True,
) -> DataFrame:
    """Named feature columns, or one vector column when ``named`` is False."""
    if named:
        return model.named(df, keep)
    return model.transform(df).select(*keep, model.getOrDefault("outputCol"))


def long_features(
    model: TabularPreprocessorModel, df: DataFrame, *, row_id: str
) -> DataFrame:
    """(row_id, feature, feature_value): one row per row and feature."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), c.alias("feature_value"))
            for name, c in model._columns()
        ]
    )
    return df.select(row_id, F.inline(cells))


def vector_sums(df: DataFrame, features: str = "features") -> DataFrame:
    """(position, total) of the vectors' stored entries, positions never stored left out.

    Entries are summed by position, so no task holds a vector of all sums.
    """
    v = F.unwrap_udt(F.col(f"`{features}`"))
    places = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = F.arrays_zip(places.alias("position"), v["values"].alias("value"))
    entries = df.where(F.size(v["values"]) > 0).select(F.inline(cells).alias("position", "value"))
    return entries.groupBy(F.col("position").cast("long").alias("position")).agg(F.sum("value").alias("total"))


def imputation_values(model: TabularPreprocessorModel, df: DataFrame) -> DataFrame:
    """(feature, kind, value, filled_rows): fitted fills, and rows of ``df`` they fill."""
    fitted = model.fitted
    fills = [(f["column"], "median", str(f["median"])) for f in fitted["numeric"]] + [
        (f["column"], "most_frequent", f["fill"]) for f in fitted["categorical"]
    ]
    gone = [
        F.count_if(
            _number(c).isNull() if kind == "median" else F.col(f"`{c}`").isNull()
        ).alias(f"_g{i}")
        for i, (c, kind, _) in enumerate(fills)
    ]
    return df.agg(*gone).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.lit(kind).alias("kind"),
                        F.lit(v).alias("value"),
                        F.col(f"_g{i}").alias("filled_rows"),
                    )
                    for i, (c, kind, v) in enumerate(fills)
                ]
            )
        )
    )
