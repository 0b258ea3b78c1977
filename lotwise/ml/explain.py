"""Additive contributions of the features to tree predictions (Lundberg et al., 2018).

The trees come from the saved model as a table of nodes. Every leaf is turned
into one condition per feature of its path, and a batch of rows is evaluated
against all leaves with array arithmetic. The work on rows is a ``mapInPandas``
over the partitions; what every task holds is the model.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.ml.features import slot_names
from lotwise.ml.forest import ForestPartsModel
from lotwise.sources.staging import small_table, staging_path


def tree_stage(model: PipelineModel):
    """The tree ensemble inside a fitted chain, or None."""
    return next((s for s in model.stages if hasattr(s, "treeWeights")), None)


def read_nodes(spark: SparkSession, ensemble) -> dict[int, dict[int, dict]]:
    """Nodes per tree from the saved form of the ensemble; bounded by the model."""
    if isinstance(ensemble, ForestPartsModel):
        found: dict[int, dict[int, dict]] = {}
        for part in ensemble.parts():
            first = len(found)
            found.update({first + i: nodes for i, nodes in read_nodes(spark, part).items()})
        return found
    path = staging_path(spark)
    ensemble.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID",
        "nodeData.id",
        "nodeData.prediction",
        F.col("nodeData.rawCount").alias("cover"),
        "nodeData.leftChild",
        "nodeData.rightChild",
        "nodeData.split.featureIndex",
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cut"),
        "nodeData.split.numCategories",
    )
    trees: dict[int, dict[int, dict]] = defaultdict(dict)
    for row in rows.collect():
        trees[row["treeID"]][row["id"]] = row.asDict()
    return trees


def leaf_conditions(nodes: dict[int, dict], weight: float) -> list[tuple[float, dict[int, tuple[float, list]]]]:
    """(value, {feature: (cover share, tests)}) per leaf; a test is (kind, cut, goes left)."""
    leaves = []
    stack = [(0, {})]
    while stack:
        index, conditions = stack.pop()
        node = nodes[index]
        if node["leftChild"] < 0:
            leaves.append((weight * node["prediction"], conditions))
            continue
        feature = node["featureIndex"]
        kind = "category" if node["numCategories"] > 0 else "threshold"
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            share, tests = conditions.get(feature, (1.0, []))
            share *= nodes[child]["cover"] / node["cover"]
            stack.append((child, {**conditions, feature: (share, [*tests, (kind, node["cut"], left)])}))
    return leaves


def _satisfied(values: np.ndarray, tests: list) -> np.ndarray:
    hit = np.ones(len(values), dtype=bool)
    for kind, cut, left in tests:
        goes_left = np.isin(values, cut) if kind == "category" else values <= cut[0]
        hit &= goes_left == left
    return hit


def leaf_contributions(x: np.ndarray, value: float, conditions: dict[int, tuple[float, list]]) -> dict[int, np.ndarray]:
    """Shapley values of the game value * prod(hit for known features, cover share for others)."""
    d = len(conditions)
    features = list(conditions)
    shares = [conditions[f][0] for f in features]
    hits = [_satisfied(x[:, f], conditions[f][1]).astype(float) for f in features]
    weights = np.array([factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)])
    result = {}
    for i, feature in enumerate(features):
        # Coefficient s: sum over the sets of s other features.
        sums = np.zeros((len(x), d))
        sums[:, 0] = 1.0
        for j in range(d):
            if j != i:
                shifted = np.zeros_like(sums)
                shifted[:, 1:] = sums[:, :-1] * hits[j][:, None]
                sums = sums * shares[j] + shifted
        result[feature] = value * (hits[i] - shares[i]) * (sums @ weights)
    return result


def explain_trees(model: PipelineModel, inputs: DataFrame, key: str) -> DataFrame | None:
    """(key, feature, contribution, base_value) on the log scale; None for other models.

    base_value plus all contributions of a row is its prediction. Every key has a row for each
    feature that some tree asks, also where the contribution is 0; if no tree asks
    any, it has one row without a feature.
    """
    ensemble = tree_stage(model)
    if ensemble is None:
        return None
    spark = inputs.sparkSession
    trees = read_nodes(spark, ensemble)
    weights = np.array(ensemble.treeWeights, dtype=float)
    if isinstance(ensemble, ForestPartsModel) or "RandomForest" in type(ensemble).__name__:
        weights = weights / weights.sum()
    leaves = [leaf for i, nodes in trees.items() for leaf in leaf_conditions(nodes, weights[i])]
    base = float(sum(v * np.prod([s for s, _ in c.values()]) for v, c in leaves))
    used = sorted({f for _, c in leaves for f in c})
    position = {f: i for i, f in enumerate(used)}
    leaves = [(v, {position[f]: cond for f, cond in c.items()}) for v, c in leaves if c]
    encoder = PipelineModel(stages=model.stages[: model.stages.index(ensemble)])
    named = slot_names(encoder, used)
    names = [named[f] for f in used]
    encoded = encoder.transform(inputs)
    schema = f"`{key}` {inputs.schema[key].dataType.simpleString()}, feature string, contribution double, base_value double"
    if not used:
        return encoded.select(
            key, F.lit(None).cast("string").alias("feature"), F.lit(0.0).alias("contribution"), F.lit(base).alias("base_value")
        )
    sliced = VectorSlicer(inputCol="features", outputCol="_used", indices=used).transform(encoded)
    arrays = sliced.select(key, vector_to_array("_used").alias("x"))
    shared = spark.sparkContext.broadcast((leaves, names))

    def contributions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaves, names = shared.value
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["x"].to_numpy())
            total = np.zeros((len(x), len(names)))
            for value, conditions in leaves:
                for feature, part in leaf_contributions(x, value, conditions).items():
                    total[:, feature] += part
            yield pd.DataFrame(
                {
                    key: np.repeat(batch[key].to_numpy(), len(names)),
                    "feature": np.tile(np.array(names, dtype=object), len(x)),
                    "contribution": total.reshape(-1),
                    "base_value": base,
                }
            )

    return arrays.mapInPandas(contributions, schema)
