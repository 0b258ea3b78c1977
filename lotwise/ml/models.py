"""The four regressors as stages after the encoder, on the log1p of the price."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.ml.features import FEATURE_SETS, LABEL, FeatureSet, fit_encoder, select_k_best, tree_bins, with_label
from lotwise.ml.forest import ForestInParts
from lotwise.ml.kernel import RandomFourierFeatures, ScaledFourierFeatures
from lotwise.ml.leastsquares import BlockRegression, InsensitiveRegression
from lotwise.sources.staging import stage

# The names models have in the metrics table.
MODEL_NAMES = {
    "linear": "Multiple Linear Regression",
    "svr": "Support Vector Regression",
    "forest": "Random Forest",
    "boosted": "XGBoost",
}
KINDS = tuple(MODEL_NAMES)
TREE_KINDS = ("forest", "boosted")
SEED = 42


def price_stage() -> SQLTransformer:
    """Back to the price scale, without asking for a label."""
    return SQLTransformer(statement="SELECT *, expm1(prediction) AS pred_price FROM __THIS__")


def block_design(train: DataFrame, features: FeatureSet) -> str:
    """Numbers, flags and categories for :class:`BlockRegression`; the category with the most levels is taken out."""
    categories = list(features.categorical)
    wide = None
    if categories:
        sizes = train.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in categories]).first()
        wide = max(categories, key=lambda c: sizes[c])
    return json.dumps({
        "categories": categories, "wide": wide, "small": [c for c in categories if c != wide],
        "numbers": list(features.numeric), "flags": S.flag_columns(train.columns),
    })


def regressor_stages(kind: str, **params: Any) -> list:
    """Stages from the feature vector to ``pred_price``.

    ``linear`` is exact least squares over the raw columns (``design``), without a vector. ``svr`` has the epsilon-insensitive loss and a
    ridge of 1 / ``C``: with ``gamma`` random Fourier features stand for the rbf kernel (``gamma="scale"`` is fitted to the input of the
    kernel), ``k`` selects slots first; with neither it is linear over the raw columns.
    """
    columns = {"labelCol": LABEL, "predictionCol": "prediction"}
    if kind == "linear":
        return [BlockRegression(**columns, **params), price_stage()]
    if kind == "forest":
        options = dict(params)
        forest = ForestInParts(featuresCol="features", seed=SEED, numTrees=options.pop("numTrees", 20), options=options, **columns)
        return [forest, price_stage()]
    if kind == "boosted":
        return [GBTRegressor(featuresCol="features", seed=SEED, **columns, **params), price_stage()]
    if kind == "svr":
        options = dict(params)
        k, gamma, design = options.pop("k", None), options.pop("gamma", None), options.pop("design", None)
        ridge = 1.0 / float(options.pop("C", 1.0))
        if design is not None:
            return [BlockRegression(design=design, ridge=ridge, **columns, **options), price_stage()]
        stages: list = []
        column = "features"
        if k is not None:
            stages.append(select_k_best(k))
            column = "selected"
        if gamma is not None:
            shape = {"inputCol": column, "outputCol": "fourier", "components": options.pop("components", 128)}
            scaled = gamma == "scale"
            stages.append(ScaledFourierFeatures(**shape) if scaled else RandomFourierFeatures(gamma=gamma, **shape))
            column = "fourier"
        return [*stages, InsensitiveRegression(featuresCol=column, ridge=ridge, **columns, **options), price_stage()]
    raise ValueError(f"unknown model kind {kind}")


def on_raw_columns(kind: str, params: dict[str, Any]) -> bool:
    """Whether the regressor reads raw columns and needs no encoder."""
    return kind == "linear" or kind == "svr" and params.get("k") is None and params.get("gamma") is None


def chain(*models: PipelineModel) -> PipelineModel:
    return PipelineModel(stages=[stage for m in models for stage in m.stages])


def fit_inputs(
    train: DataFrame, kind: str, encoding: str | None = None, features: FeatureSet | None = None
) -> tuple[PipelineModel, dict[str, Any]]:
    """The fitted encoder of a model kind and the parameters that follow from it.

    Without ``encoding`` trees get categories in the order of their mean label and the other kinds one-hot ones, at every size.
    """
    is_tree = kind in TREE_KINDS
    encoding = encoding or ("ordered" if is_tree else "one_hot")
    encoder = fit_encoder(train, features or FEATURE_SETS[kind], encoding)
    return encoder, {"maxBins": tree_bins(encoder)} if is_tree else {}


def fit(
    train: DataFrame,
    kind: str,
    target: str = S.TARGET,
    encoding: str | None = None,
    features: FeatureSet | None = None,
    **params: Any,
) -> PipelineModel:
    """Fit encoder and regressor; the model maps a clean row to ``pred_price``."""
    labelled = with_label(train, target)
    if on_raw_columns(kind, params):
        design = block_design(train, features or FEATURE_SETS[kind])
        return Pipeline(stages=regressor_stages(kind, design=design, **params)).fit(labelled)
    encoder, derived = fit_inputs(labelled, kind, encoding, features)
    encoded = encoder.transform(labelled).select("features", LABEL)
    if kind == "boosted":
        # Each pass before the rows are held in memory would join the levels again.
        encoded = stage(encoded)
    stages = regressor_stages(kind, **{**derived, **params})
    return chain(encoder, Pipeline(stages=stages).fit(encoded))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``pred_price`` and drops the columns of the stages."""
    return model.transform(df).select(*[f"`{c}`" for c in df.columns], "pred_price")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
