"""Preparation steps as Spark ML stages: fitted once, applied to any table, saved and reloaded.

Estimators and transformers here take part in a ``pyspark.ml.Pipeline`` next to
Spark's own stages. A fitted stage holds plain numbers as params and per-category
values as tables; both are written by ``model.write().save(path)``, the tables as
Parquet, and come back by ``load``, alone or inside a ``PipelineModel``. Fitting
writes the tables once, so applying a stage never fits it again.

Columns that a step needs and a table lacks leave that step without effect where
its docstring says so; everywhere else they are an error of Spark.
"""

from __future__ import annotations

import math
from typing import ClassVar

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasOutputCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReader,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gridloom.functions.dates import extract_date_features
from gridloom.functions.numeric import transform_value
from gridloom.operators.clean import FillStats, fit_fill_stats, transform_fill
from gridloom.operators.encode import medians, quantile_edges, target_stats

#: What stands for null among the categories of an indexed column.
NULL_NAME = "\x00"


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class Stage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose params are given by name."""

    defaults: ClassVar[dict] = {}

    def __init__(self, **params):
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**params)

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))


class _TablesWriter(MLWriter):
    def __init__(self, instance: "TableModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, {"tables": sorted(self.instance.tables)})
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _TablesReader(MLReader):
    def __init__(self, kind: type["TableModel"]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "TableModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.kind()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        return found.holding(**{name: self.sparkSession.read.parquet(f"{path}/tables/{name}") for name in metadata["tables"]})


class TableModel(Stage, Model):
    """A fitted stage with tables besides its params."""

    def __init__(self, **params):
        super().__init__(**params)
        self.tables: dict[str, DataFrame] = {}

    def holding(self, **tables: DataFrame) -> "TableModel":
        self.tables = tables
        return self

    def write(self) -> MLWriter:
        return _TablesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TablesReader(cls)


# --- matches -----------------------------------------------------------------

class DateParts(Stage, Transformer, HasInputCol):
    """Parsed date, ``month`` and ``is_weekend``."""

    defaults = {"inputCol": "date"}

    def _transform(self, df: DataFrame) -> DataFrame:
        return extract_date_features(df, self.getInputCol())


class _Grouped(Params):
    outer = _param("outer", "the wider grouping column", TypeConverters.toString)
    inner = _param("inner", "the narrower grouping column", TypeConverters.toString)
    flag = _param("flag", "column that marks filled rows", TypeConverters.toString)


_GROUPED = {"inputCol": "avg_mmr", "outer": "region", "inner": "game_mode", "flag": "mmr_missing"}


class GroupMeanFill(Stage, Estimator, HasInputCol, _Grouped):
    """Gaps become the mean of their (outer, inner) group, of their outer group, or of all rows.

    Without effect where the fitting table lacks one of the three columns.
    """

    defaults = _GROUPED

    def _fit(self, df: DataFrame) -> "GroupMeanFillModel":
        names = [self.value(p) for p in ("inputCol", "outer", "inner")]
        made = self._copyValues(GroupMeanFillModel())
        if not set(names) <= set(df.columns):
            return made
        stats = fit_fill_stats(df, *names)
        made._set(overall=stats.global_mean)
        return made.holding(group_means=stats.group_means, region_means=stats.region_means)


class GroupMeanFillModel(TableModel, HasInputCol, _Grouped):
    defaults = _GROUPED
    overall = _param("overall", "mean of all rows", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.tables:
            return df
        stats = FillStats(self.tables["group_means"], self.tables["region_means"], self.value("overall"))
        return transform_fill(df, stats, *[self.value(p) for p in ("inputCol", "outer", "inner", "flag")])


class ValueTransform(Stage, Transformer, HasInputCol):
    """raw / log1p / sqrt of a value's non-negative part; without effect where the column is absent."""

    defaults = {"inputCol": "avg_mmr", "mode": "raw"}
    mode = _param("mode", "raw, log1p or sqrt", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getInputCol()
        return df.withColumn(name, transform_value(name, self.value("mode"))) if name in df.columns else df


# --- categories --------------------------------------------------------------

class TargetEncoder(Stage, Estimator, HasInputCol, HasOutputCol, HasLabelCol):
    """Smoothed mean of the label by category; unknown and missing categories get the label's mean."""

    defaults = {"minLeaf": 20.0, "smoothing": 10.0}
    minLeaf = _param("minLeaf", "rows at which a category weighs half", TypeConverters.toFloat)
    smoothing = _param("smoothing", "how fast the weight rises around minLeaf", TypeConverters.toFloat)

    def _fit(self, df: DataFrame) -> "TargetEncoderModel":
        table, prior = target_stats(df, self.getInputCol(), self.getLabelCol(), self.value("minLeaf"), self.value("smoothing"))
        made = TargetEncoderModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), prior=prior)
        return made.holding(encodings=table.toDF("category", "encoding"))


class TargetEncoderModel(TableModel, HasInputCol, HasOutputCol):
    prior = _param("prior", "mean of the label", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        table = self.tables["encodings"].select(F.col("category").alias("__category"), F.col("encoding").alias("__encoding"))
        found = df.join(table, F.col(self.getInputCol()) == F.col("__category"), "left")
        return found.withColumn(out, F.coalesce("__encoding", F.lit(self.value("prior")))).drop("__category", "__encoding")


class CategoryText(Stage, Transformer, HasInputCols, HasOutputCols):
    """Categories as text that an indexer can hold: null is a category of its own."""

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getInputCols(), self.getOutputCols(), strict=True)
        return df.withColumns({out: F.coalesce(F.col(c).cast("string"), F.lit(NULL_NAME)) for c, out in pairs})


class Dropped(Stage, Transformer, HasInputCols):
    """The table without helper columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getInputCols())


def one_hot_stages(cols: list[str], out: list[str]) -> list:
    """Sparse 0/1 vectors; a category that the fitting table lacks is a zero vector."""
    text, index = [f"{o}__text" for o in out], [f"{o}__index" for o in out]
    return [
        CategoryText(inputCols=cols, outputCols=text),
        StringIndexer(inputCols=text, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=index, outputCols=out, dropLast=True),
        Dropped(inputCols=[*text, *index]),
    ]


# --- numbers -----------------------------------------------------------------

class FillScale(Stage, Estimator, HasInputCols, HasOutputCols):
    """Gaps filled by the column's median or mean, then centred and scaled where ``scaled``.

    ``gapCols`` names the columns that may have gaps anywhere (all, if unset): only those need a median.
    A column without known values is filled with 0; a zero deviation counts as 1.
    """

    defaults = {"strategy": "median", "scaled": True}
    strategy = _param("strategy", "median or mean", TypeConverters.toString)
    scaled = _param("scaled", "whether columns are centred and scaled", TypeConverters.toBoolean)
    gapCols = _param("gapCols", "columns that may have gaps", TypeConverters.toListString)

    def _fit(self, df: DataFrame) -> "FillScaleModel":
        cols, strategy = self.getInputCols(), self.value("strategy")
        if strategy not in ("median", "mean"):
            raise ValueError(f"unknown strategy: {strategy}")
        row = df.agg(*[column_moments(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        moments = {c: row[f"m{i}"] for i, c in enumerate(cols)}
        gaps = self.value("gapCols") if self.isDefined(self.gapCols) else cols
        found = medians(df, [c for c in cols if c in gaps]) if strategy == "median" else {c: moments[c]["mean"] for c in cols}
        fills = [float(found.get(c) or 0.0) for c in cols]
        scales = [with_fill(moments[c], f) for c, f in zip(cols, fills, strict=True)]
        if not self.value("scaled"):
            scales = [(0.0, 1.0)] * len(cols)
        return FillScaleModel(
            inputCols=cols, outputCols=self.getOutputCols(), fills=fills, means=[m for m, _ in scales], deviations=[d for _, d in scales]
        )


class FillScaleModel(Stage, Model, HasInputCols, HasOutputCols):
    fills = _param("fills", "value of a gap by column", TypeConverters.toListFloat)
    means = _param("means", "mean by column, gaps filled", TypeConverters.toListFloat)
    deviations = _param("deviations", "population deviation by column, gaps filled", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        made = zip(self.getInputCols(), self.getOutputCols(), *(self.value(p) for p in ("fills", "means", "deviations")), strict=True)
        return df.withColumns({
            out: (F.coalesce(F.col(c).cast("double"), F.lit(fill)) - F.lit(mean)) / F.lit(dev) for c, out, fill, mean, dev in made
        })


def column_moments(col: str) -> Column:
    x = F.col(col).cast("double")
    return F.struct(F.count(x).alias("n"), F.count_if(x.isNull()).alias("gaps"), F.avg(x).alias("mean"), F.var_pop(x).alias("var"))


def with_fill(m: Row, fill: float) -> tuple[float, float]:
    """Mean and population deviation once the gaps hold ``fill``; a zero deviation counts as 1."""
    n = m["n"] + m["gaps"]
    if not n:
        return 0.0, 1.0
    known, var = (m["mean"], m["var"]) if m["n"] else (fill, 0.0)
    mean = (m["n"] * known + m["gaps"] * fill) / n
    spread = m["n"] * (var + (known - mean) ** 2) + m["gaps"] * (fill - mean) ** 2
    return mean, math.sqrt(spread / n) or 1.0


class QuantileBins(Stage, Estimator, HasInputCol, HasOutputCol):
    """Bin numbers by quantiles of the fitting table; values outside its range fall into the first or last bin."""

    defaults = {"bins": 5}
    bins = _param("bins", "number of bins", TypeConverters.toInt)

    def _fit(self, df: DataFrame) -> "QuantileBinsModel":
        edges = quantile_edges(df, self.getInputCol(), self.value("bins"))
        return QuantileBinsModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), inner=edges[1:-1])


class QuantileBinsModel(Stage, Model, HasInputCol, HasOutputCol):
    inner = _param("inner", "edges between bins", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        slot = F.lit(0)
        for edge in self.value("inner"):
            slot = slot + (F.col(self.getInputCol()) >= F.lit(edge)).cast("int")
        return df.withColumn(self.getOutputCol(), slot)


# --- whole preprocessors -----------------------------------------------------

def match_stages(mode: str = "raw") -> list:
    """Date parts, the rating's fill and its transform: what every match table goes through first."""
    return [DateParts(), GroupMeanFill(), ValueTransform(mode=mode)]


def encoder_stages(
    target: list[str] = (), ohe: list[str] = (), numeric: list[str] = (), label: str = "label", prefix: str = "__", gaps: list[str] | None = None
) -> tuple[list, list[str]]:
    """Stages that route columns by kind, and the columns they make in order: targets, one-hot vectors, numbers."""
    stages: list = []
    made: list[str] = []
    for i, c in enumerate(target):
        made.append(f"{prefix}te{i}")
        stages.append(TargetEncoder(inputCol=c, outputCol=made[-1], labelCol=label))
    if ohe:
        hot = [f"{prefix}h{i}" for i in range(len(ohe))]
        stages += one_hot_stages(list(ohe), hot)
        made += hot
    if numeric:
        scaled = [f"{prefix}n{i}" for i in range(len(numeric))]
        known = {} if gaps is None else {"gapCols": list(gaps)}
        stages.append(FillScale(inputCols=list(numeric), outputCols=scaled, **known))
        made += scaled
    return stages, made


def make_preprocessor(
    target: list[str] = (), ohe: list[str] = (), numeric: list[str] = (), label: str = "label", mode: str | None = None, out: str = "features"
) -> Pipeline:
    """An unfitted pipeline from raw columns to one vector; columns of no kind stay beside it.

    With ``mode`` match tables get their date parts and rating first.
    """
    stages, made = encoder_stages(target, ohe, numeric, label)
    if not made:
        raise ValueError("no column was given")
    first = [] if mode is None else match_stages(mode)
    return Pipeline(stages=[*first, *stages, VectorAssembler(inputCols=made, outputCol=out), Dropped(inputCols=made)])
