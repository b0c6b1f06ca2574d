"""The leakage-safe feature builder as a Spark ML stage.

``LeakageSafeFeatures`` (Estimator) learns, from the TRAINING frame only, the median of every numeric column's finite values and the
sorted category list of every dimension. The fitted model's ``transform`` is a
single ``select``: derived ratios, NULL/NaN/Inf imputed with the train median
(a literal, so it is constant-folded into codegen), one-hot columns, and an
assembled ``features`` vector. No shuffle at transform time.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closecast.functions.columns import finite_or_null
from closecast.functions.quantiles import column_quantiles
from closecast.operators.contracts import check_forbidden
from closecast.schema import DERIVED, DIMENSIONS, FEATURES, HISTORICAL, OPERATIONAL, TARGET

_EPS = 1.0
MAX_CATEGORIES = 1000  # one-hot columns of one dimension; a column of more values is no dimension


def _num(df_cols: set[str], name: str) -> Column:
    if name in df_cols:
        return finite_or_null(F.col(f"`{name}`").try_cast("double"))
    return F.lit(None).cast("double")


def derived_columns(df_cols: set[str]) -> dict[str, Column]:
    """Ratio features from partial-month values (NULL where undefined)."""
    gross = _num(df_cols, "month_to_date_gross_charges")
    elapsed = _num(df_cols, "days_elapsed")
    total = elapsed + _num(df_cols, "remaining_days")
    return {
        "mtd_collection_ratio": F.try_divide(_num(df_cols, "month_to_date_payments"), gross + _EPS),
        "mtd_denial_ratio": F.try_divide(_num(df_cols, "month_to_date_denials"), gross + _EPS),
        "mtd_adjustment_ratio": F.try_divide(_num(df_cols, "month_to_date_contractual_adjustments"), gross + _EPS),
        "mtd_gross_run_rate": F.try_divide(gross, elapsed + _EPS),
        "fraction_month_elapsed": F.try_divide(elapsed, total),
    }


def with_derived(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    return df.withColumns({k: finite_or_null(v) for k, v in derived_columns(cols).items()})


def numeric_inputs(df_cols: list[str]) -> list[str]:
    """Numeric model inputs present after derivation, in builder order."""
    present = set(df_cols) | set(DERIVED)
    return [c for c in OPERATIONAL + HISTORICAL + DERIVED if c in present]


def fit_statistics(df: DataFrame, relative_error: float | None = None) -> DataFrame:
    """M18 + M19: a one-row frame of medians and category arrays.

    Medians are exact at every size (``column_quantiles``), all columns in each
    pass; ``relative_error`` asks for the bounded sketch instead. Category
    lists are the one-hot columns of the model, so they must fit a plan anyway.
    """
    enriched = with_derived(df)
    numeric = numeric_inputs(enriched.columns)
    found = column_quantiles(enriched, {c: finite_or_null(F.col(f"`{c}`").cast("double")) for c in numeric}, [0.5], relative_error)
    medians = df.sparkSession.range(1).select(*[F.lit(found.get(c, [0.0])[0]).alias(f"median__{c}") for c in numeric])
    dims = [c for c in DIMENSIONS if c in df.columns]
    if dims:
        sizes = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(c) for c in dims]).first()
        wide = [c for c in dims if sizes[c] > MAX_CATEGORIES]
        if wide:
            raise ValueError(f"about {sizes[wide[0]]} categories in {wide[0]}; one-hot columns take at most {MAX_CATEGORIES}")
    cats = [F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"cats__{c}") for c in dims]
    return medians.crossJoin(df.agg(*cats)) if cats else medians  # one row each


class _FeatureParams(Params):
    forbidden = Param(Params._dummy(), "forbidden", "post-close columns that must be absent",
                      typeConverter=TypeConverters.toListString)
    relativeError = Param(Params._dummy(), "relativeError", "0 = exact medians, else sketch accuracy",
                          typeConverter=TypeConverters.toFloat)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column ('' = none)",
                      typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label carried for the next stage (never read here)",
                     typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        from closecast.schema import FORBIDDEN_FUTURE

        self._setDefault(forbidden=list(FORBIDDEN_FUTURE), relativeError=0.0, outputCol="features",
                         labelCol=TARGET)

    def _check_inputs(self, columns: list[str]) -> None:
        """Post-close columns must not be feature inputs. The label column
        may ride along for a downstream estimator; this stage never reads it."""
        label = self.getOrDefault("labelCol")
        check_forbidden([c for c in columns if c != label], self.getOrDefault("forbidden"))


class LeakageSafeFeatures(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """fit medians and categories on train only."""

    def __init__(self, outputCol: str = "features", relativeError: float = 0.0):
        super().__init__()
        self._set(outputCol=outputCol, relativeError=relativeError)

    def _fit(self, dataset: DataFrame) -> "LeakageSafeFeaturesModel":
        self._check_inputs(dataset.columns)
        keep = [c for c in FEATURES if c in dataset.columns]
        rel = self.getOrDefault("relativeError") or None
        row = fit_statistics(dataset.select(*keep), rel).first().asDict()
        medians = {k[len("median__"):]: float(v) for k, v in row.items() if k.startswith("median__")}
        cats = {k[len("cats__"):]: list(v or []) for k, v in row.items() if k.startswith("cats__")}
        model = LeakageSafeFeaturesModel()
        model._set(statsJson=json.dumps({"medians": medians, "categories": cats}),
                   outputCol=self.getOrDefault("outputCol"), forbidden=self.getOrDefault("forbidden"),
                   labelCol=self.getOrDefault("labelCol"))
        return model


class LeakageSafeFeaturesModel(Model, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """impute + one-hot + assemble in one projection."""

    statsJson = Param(Params._dummy(), "statsJson", "fitted medians and categories",
                      typeConverter=TypeConverters.toString)

    @property
    def medians(self) -> dict[str, float]:
        return json.loads(self.getOrDefault("statsJson"))["medians"]

    @property
    def categories(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault("statsJson"))["categories"]

    def feature_names(self) -> list[str]:
        """numeric columns in builder order, then ``dim__category`` columns."""
        names = list(self.medians)
        for dim, cats in self.categories.items():
            names += [f"{dim}__{c}" for c in cats]
        return names

    def feature_columns(self, df_cols: list[str]) -> list[Column]:
        cols = set(df_cols)
        derived = derived_columns(cols)
        out = []
        for name, median in self.medians.items():
            raw = finite_or_null(derived[name]) if name in derived else _num(cols, name)
            out.append(F.coalesce(raw, F.lit(float(median))).alias(name))
        for dim, cats in self.categories.items():
            for cat in cats:
                if dim in cols:
                    hot = F.coalesce((F.col(dim).cast("string") == F.lit(cat)), F.lit(False)).cast("double")
                else:
                    hot = F.lit(0.0)
                out.append(hot.alias(f"{dim}__{cat}"))
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self._check_inputs(dataset.columns)
        feats = self.feature_columns(dataset.columns)
        names = self.feature_names()
        passthrough = [F.col(f"`{c}`") for c in dataset.columns if c not in set(names)]
        out = dataset.select(*passthrough, *feats)
        vec = self.getOrDefault("outputCol")
        if vec:
            out = VectorAssembler(inputCols=names, outputCol=vec, handleInvalid="keep").transform(out)
        return out


def build_feature_frame(train: DataFrame, *frames: DataFrame, relative_error: float = 0.0):
    """fit on train, transform train and the other frames (same order)."""
    model = LeakageSafeFeatures(outputCol="", relativeError=relative_error).fit(train)
    return (model, *[model.transform(f) for f in (train, *frames)])
