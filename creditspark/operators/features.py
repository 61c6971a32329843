"""Feature steps as Spark ML stages over native expressions."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from creditspark import schema as S
from creditspark.functions import loan as L

SCALED_NUMERIC = [*S.NUMERIC_FEATURES, "loan_to_income_ratio", "log_loan_amount", "log_annual_income"]
ENCODED = [*S.CATEGORICAL_FEATURES, "credit_score_band"]


class LoanToIncomeRatio(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``loan_to_income_ratio``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("loan_to_income_ratio", L.loan_to_income(F.col("loan_amount"), F.col("annual_income")))


class LogColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<prefix><column>`` = log(1 + max(x, 0)) for the columns that exist."""

    columns = Param(Params._dummy(), "columns", "columns to transform", TypeConverters.toListString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the new columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, prefix="log_"):
        super().__init__()
        self._setDefault(columns=S.LOG_FEATURES, prefix="log_")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        prefix = self.getOrDefault(self.prefix)
        present = [c for c in self.getOrDefault(self.columns) if c in df.columns]
        return df.withColumns({f"{prefix}{c}": L.log_floor0(F.col(c)) for c in present})


class ScoreBands(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the band label of ``credit_score``; outside every band it is ``nan``."""

    edges = Param(Params._dummy(), "edges", "ascending band edges", TypeConverters.toListFloat)
    labels = Param(Params._dummy(), "labels", "one label per band", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "name of the band column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, edges=None, labels=None, outputCol="credit_score_band"):
        super().__init__()
        self._setDefault(
            edges=[float(e) for e in S.SCORE_BAND_EDGES], labels=S.SCORE_BAND_LABELS, outputCol="credit_score_band"
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        band = L.score_band(F.col("credit_score"), self.getOrDefault(self.edges), self.getOrDefault(self.labels))
        return df.withColumn(self.getOrDefault(self.outputCol), band)


class DelinquencyFlag(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``high_delinquency_risk`` (0/1)."""

    threshold = Param(Params._dummy(), "threshold", "lowest flagged count", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, threshold=2):
        super().__init__()
        self._setDefault(threshold=2)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        flag = L.delinquency_flag(F.col("num_delinquencies"), self.getOrDefault(self.threshold))
        return df.withColumn("high_delinquency_risk", flag)


class _ScalerParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to scale", TypeConverters.toListString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the scaled columns", TypeConverters.toString)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """z-scores with the population deviation; a constant column is only centred.

    Spark's own scaler divides by the sample deviation, which is a different number.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, prefix="scaled_"):
        super().__init__()
        self._setDefault(prefix="scaled_")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getOrDefault(self.inputCols)
        stats = [f(F.col(c).cast("double")).alias(f"{k}_{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("s", F.stddev_pop))]
        row = df.agg(*stats).first()
        model = PopulationScalerModel()
        return model._set(
            inputCols=cols,
            prefix=self.getOrDefault(self.prefix),
            means=[row[f"m_{i}"] or 0.0 for i in range(len(cols))],
            scales=[row[f"s_{i}"] or 1.0 for i in range(len(cols))],
        )


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted deviations, 1 for constants", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        prefix = self.getOrDefault(self.prefix)
        stats = zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.means), self.getOrDefault(self.scales))
        return df.withColumns({f"{prefix}{c}": (F.col(c).cast("double") - m) / s for c, m, s in stats})


def scale_columns(train: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with z-scored columns, the statistics coming from ``train`` in the same query."""
    stats = train.agg(
        F.struct(
            *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
        ).alias("s")
    ).scalar()
    wide = rows.withColumn("_s", stats)
    spread = {c: F.when(F.col("_s")[f"s_{c}"] == 0, 1.0).otherwise(F.col("_s")[f"s_{c}"]) for c in columns}
    return wide.withColumns(
        {f"scaled_{c}": (F.col(c).cast("double") - F.col("_s")[f"m_{c}"]) / spread[c] for c in columns}
    ).drop("_s")


def one_hot_columns(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """One 0/1 column per category, in alphabetical order; an unseen value gives zeros."""
    return df.withColumns(
        {
            f"{c}_{v}": F.when(F.col(c) == v, 1.0).otherwise(0.0)
            for c, values in categories.items()
            for v in sorted(values)
        }
    )


def feature_stages(include_flag: bool = False) -> Pipeline:
    """Ratio, logs, bands and flag, then scaling, one-hot encoding and the vector.

    The delinquency flag is computed but enters the vector only when asked for.
    """
    numeric = [*SCALED_NUMERIC, *(["high_delinquency_risk"] if include_flag else [])]
    indexed, encoded = [f"{c}_index" for c in ENCODED], [f"{c}_onehot" for c in ENCODED]
    return Pipeline(
        stages=[
            LoanToIncomeRatio(),
            LogColumns(),
            ScoreBands(),
            DelinquencyFlag(),
            PopulationScaler(inputCols=numeric),
            StringIndexer(inputCols=ENCODED, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            VectorAssembler(inputCols=[f"scaled_{c}" for c in numeric] + encoded, outputCol="features"),
        ]
    )


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector's entries: numeric columns, then ``column_value``."""
    scaler = next(s for s in model.stages if isinstance(s, PopulationScalerModel))
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    names = list(scaler.getOrDefault(scaler.inputCols))
    for column, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        names += [f"{column}_{v}" for v in labels]
    return names


def fit_features(train: DataFrame, include_flag: bool = False) -> PipelineModel:
    return feature_stages(include_flag).fit(train)


def save_features(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_features(path: str) -> PipelineModel:
    return PipelineModel.load(path)
