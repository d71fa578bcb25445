"""The preparation as stages of ``pyspark.ml``, for pipelines and cross validation.

``PrepareInputs`` screens, imputes, selects, clusters, pools and replaces; ``EncodeInputs`` makes
dummies, indicators and scales of what remains, and one vector. The fitted catalog travels
with the table, in the metadata of the target column. Fitted stages save and load like
any other; a saved pipeline gives equal rows.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsReadable, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.catalog import Catalog
from prepline.operators.encode import PrepModel, fit_prep
from prepline.plans.flow import Preparation, fit_preparation
from prepline.sources import StageStore

CATALOG = "prepline_catalog"


class _StateWriter(MLWriter):
    """Params as Spark keeps them, the fitted state beside them."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.stage, path, spark)
        StageStore(spark, path).save_state("state", self.stage.state)


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.cls(StageStore(spark, path).load_state("state", self.cls.holds))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _Fitted(Model, MLWritable, MLReadable):
    """A model made of fitted state that has ``to_json`` and ``from_json``."""

    holds: type

    def __init__(self, state=None):
        super().__init__()
        self.state = state

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class _PrepareParams(Params):
    catalog = Param(Params._dummy(), "catalog", "the variable catalog, as JSON", TypeConverters.toString)
    key = Param(Params._dummy(), "key", "the column that names a row", TypeConverters.toString)
    levelLimit = Param(Params._dummy(), "levelLimit", "levels from which on a column is rejected", TypeConverters.toInt)
    missingShare = Param(Params._dummy(), "missingShare", "missing share from which on a column is rejected", TypeConverters.toFloat)
    rareShare = Param(Params._dummy(), "rareShare", "share below which levels are pooled", TypeConverters.toFloat)
    forest = Param(Params._dummy(), "forest", "whether a forest selects columns", TypeConverters.toBoolean)
    forestLimit = Param(Params._dummy(), "forestLimit", "importance below which a column is rejected", TypeConverters.toFloat)
    cluster = Param(Params._dummy(), "cluster", "whether correlated columns are reduced to one a cluster", TypeConverters.toBoolean)
    hyper = Param(Params._dummy(), "hyper", "share of variation a cluster's component explains", TypeConverters.toFloat)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(levelLimit=200, missingShare=0.99, rareShare=0.001, forest=True, forestLimit=0.001, cluster=True, hyper=0.8)


class PreparedInputs(_Fitted, _PrepareParams):
    """Fitted by ``PrepareInputs``: adds the derived columns; no row moves."""

    holds = Preparation

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, target = self.state.transform(dataset), self.state.catalog.target()
        return out.withColumn(target, F.col(f"`{target}`").alias(target, metadata={CATALOG: self.state.catalog.to_json()}))


class PrepareInputs(Estimator, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, catalog: str | None = None, key: str | None = None, levelLimit: int = 200, missingShare: float = 0.99, rareShare: float = 0.001,
                 forest: bool = True, forestLimit: float = 0.001, cluster: bool = True, hyper: float = 0.8):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PreparedInputs:
        get = self.getOrDefault
        state = fit_preparation(
            dataset, Catalog.from_json(get("catalog")), get("key"), get("levelLimit"), get("missingShare"), get("rareShare"), get("forest"),
            get("forestLimit"), get("cluster"), get("hyper"))
        return self._copyValues(PreparedInputs(state))


class _EncodeParams(Params):
    inputScale = Param(Params._dummy(), "inputScale", "'Range', 'Z Score' or 'None'", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "the vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "the target as a number", TypeConverters.toString)
    keep = Param(Params._dummy(), "keep", "columns that stay beside the vector", TypeConverters.toListString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputScale="Range", featuresCol="features", labelCol="label", keep=[])


class EncodedInputs(_Fitted, _EncodeParams):
    """Fitted by ``EncodeInputs``: the kept columns, the label and the vector."""

    holds = PrepModel

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return self.state.features(dataset, get("keep"), get("labelCol"), get("featuresCol"))


class EncodeInputs(Estimator, _EncodeParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputScale: str = "Range", featuresCol: str = "features", labelCol: str = "label", keep: list[str] = []):  # noqa: B006
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> EncodedInputs:
        found = [f.metadata[CATALOG] for f in dataset.schema if CATALOG in (f.metadata or {})]
        if len(found) != 1:
            raise ValueError("the table does not come from PrepareInputs")
        scale = self.getOrDefault("inputScale")
        return self._copyValues(EncodedInputs(fit_prep(dataset, Catalog.from_json(found[0]), input_scale=None if scale == "None" else scale)))
