"""A random forest fitted and kept in parts of a few trees.

The trees of a forest do not know each other, so parts fitted with seeds of their own are the same forest as all of them at once. What a
row remembers (how often each tree drew it, its node in each tree), what a task adds up and what is sent along for
scoring then follow from the trees of one part, not from all. A finished part is written and not held on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.sources.staging import stage, staging_path

#: Trees that are fitted at once.
PART = 50
#: Parts that score rows in one pass.
SCORED = 3
#: MB of node statistics that one task adds up in a pass; more nodes take more passes.
NODES_MB = 128
#: Far apart, as a seed and those that follow it serve the partitions.
_SEEDS = 1_000_003


class ForestInParts(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Fits ``numTrees`` trees with the other ``options`` of a RandomForestRegressor."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", numTrees=20, seed=0, options=None):
        super().__init__()
        given: dict[str, Any] = dict(self._input_kwargs)
        self.trees, self.seed, self.options = given.pop("numTrees", 20), given.pop("seed", 0), given.pop("options", None) or {}
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> ForestPartsModel:
        # Every part reads the rows, so they are computed once.
        rows = stage(dataset.select(self.getFeaturesCol(), self.getLabelCol()))
        path = staging_path(dataset.sparkSession)
        sizes = [min(PART, self.trees - at) for at in range(0, self.trees, PART)]
        for i, size in enumerate(sizes):
            # Each row remembers its nodes, so deep trees are not sent along with every pass.
            part = RandomForestRegressor(**{
                "cacheNodeIds": True, "maxMemoryInMB": NODES_MB, **self.options, "featuresCol": self.getFeaturesCol(),
                "labelCol": self.getLabelCol(), "numTrees": size, "seed": self.seed + i * _SEEDS,
            })
            part.fit(rows).write().save(f"{path}/{i}")
        return ForestPartsModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), sizes=sizes, source=path)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for i, part in enumerate(self.instance.parts()):
            part.write().save(f"{path}/parts/{i}")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(source=f"{path}/parts")


class ForestPartsModel(Transformer, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """The mean of all trees; ``source`` has a folder for each part."""

    source = Param(Params._dummy(), "source", "folder of the parts", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "trees of each part", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", sizes=(), source=""):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def treeWeights(self) -> list[float]:
        return [1.0] * sum(self.getOrDefault(self.sizes))

    def parts(self) -> Iterator[RandomForestRegressionModel]:
        """One part after the other, read where it is asked for."""
        for i in range(len(self.getOrDefault(self.sizes))):
            yield RandomForestRegressionModel.load(f"{self.getOrDefault(self.source)}/{i}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes = self.getOrDefault(self.sizes)
        scored = dataset.withColumn("_total", F.lit(0.0))
        for i, part in enumerate(self.parts()):
            if i and i % SCORED == 0:
                scored = stage(scored)  # what follows no longer needs the trees before
            scored = part.setFeaturesCol(self.getFeaturesCol()).setPredictionCol("_part").transform(scored)
            scored = scored.withColumn("_total", F.col("_total") + F.col("_part") * F.lit(float(sizes[i]))).drop("_part")
        return scored.withColumn(self.getPredictionCol(), F.col("_total") / F.lit(float(sum(sizes)))).drop("_total")

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)
