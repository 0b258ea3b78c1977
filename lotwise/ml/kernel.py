"""Random Fourier features (Rahimi and Recht, 2007): a linear model on them approximates an rbf kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows that are projected at a time.
ROWS = 2_000


def slot_normals(seed: int, slots: np.ndarray, components: int) -> np.ndarray:
    """Standard normal numbers by (slot, component).

    Each follows from the hash of seed, slot and component (SplitMix64, Box-Muller), so a task makes those of the slots it meets
    and never those of all slots.
    """
    with np.errstate(over="ignore"):
        place = slots.astype(np.uint64)[:, None] * np.uint64(components) + np.arange(components, dtype=np.uint64)

        def uniform(stream: int) -> np.ndarray:
            z = (np.uint64(2) * place + np.uint64(stream + 1)) * np.uint64(0x9E3779B97F4A7C15) + _mixed(np.uint64(seed % 2**64))
            return ((_mixed(z) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53

        return np.sqrt(-2.0 * np.log(uniform(0))) * np.cos(2.0 * np.pi * uniform(1))


def _mixed(z):
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _projected(entries: list[tuple[np.ndarray, np.ndarray]], seed: int, components: int) -> np.ndarray:
    """Sums of the weights of the entries that are not 0, row by row; no vector is made dense."""
    lengths = np.array([len(v) for _, v in entries])
    sums = np.zeros((len(entries), components))
    filled = np.flatnonzero(lengths)
    if len(filled):
        slots, at = np.unique(np.concatenate([i for i, _ in entries]), return_inverse=True)
        products = slot_normals(seed, slots, components)[at]
        products *= np.concatenate([v for _, v in entries])[:, None]
        sums[filled] = np.add.reduceat(products, (np.cumsum(lengths) - lengths)[filled])
    return sums


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    gamma = Param(Params._dummy(), "gamma", "width of the kernel exp(-gamma |x-y|^2)", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "number of output features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="fourier", gamma=0.01, components=128, seed=42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier", gamma=0.01, components=128, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, seed = self.getOrDefault(self.gamma), self.getOrDefault(self.seed)
        components = self.getOrDefault(self.components)

        @F.pandas_udf("array<double>")
        def project(vectors: pd.DataFrame) -> pd.Series:
            phases = np.random.default_rng(seed).uniform(0.0, 2.0 * np.pi, components)
            out: list[np.ndarray] = []
            for first in range(0, len(vectors), ROWS):
                part = vectors.iloc[first : first + ROWS]
                entries = [
                    (np.arange(len(v)) if i is None else np.asarray(i), np.asarray(v, dtype=np.float64))
                    for i, v in zip(part["indices"], part["values"])
                ]
                sums = np.sqrt(2.0 * gamma) * _projected(entries, seed, components)
                out.extend(np.sqrt(2.0 / components) * np.cos(sums + phases))
            return pd.Series(out, dtype=object)

        values = project(F.unwrap_udt(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(values))


def scale_gamma(encoded: DataFrame, column: str = "features") -> float:
    """1 / (number of features * variance of all entries of the matrix), from two sums over the entries that are not 0."""
    vector = F.unwrap_udt(F.col(column))
    values = vector["values"]

    def total(entries: Column) -> Column:
        return F.sum(F.aggregate(entries, F.lit(0.0), lambda a, b: a + b))

    width, n, entries, squares = encoded.agg(
        F.max(F.coalesce(vector["size"], F.size(values))), F.count(column), total(values), total(F.transform(values, lambda v: v * v))
    ).first()
    if not n:
        return 1.0
    variance = squares / (n * width) - (entries / (n * width)) ** 2
    return 1.0 / (width * variance) if variance > 0 else 1.0


class ScaledFourierFeatures(Estimator, HasInputCol, HasOutputCol):
    """Fits the width of the kernel to its own input, after any selection and for every fold: :func:`scale_gamma`."""

    components = Param(Params._dummy(), "components", "number of output features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="fourier", components=128):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier", components=128)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RandomFourierFeatures:
        return RandomFourierFeatures(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), gamma=scale_gamma(dataset, self.getInputCol()),
            components=self.getOrDefault(self.components),
        )
