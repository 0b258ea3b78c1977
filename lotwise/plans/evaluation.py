"""Predictions, residuals, ranges and trends of several models at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.ml import metrics as M
from lotwise.ml.explain import explain_trees
from lotwise.ml.models import load_model
from lotwise.operators.chartdata import price_trend
from lotwise.plans.scoring import prepare_requests
from lotwise.plans.training import predictions
from lotwise.sources.staging import stage


def load_models(paths: Mapping[str, str]) -> tuple[dict[str, PipelineModel], dict[str, str]]:
    """The models that can be read, and the errors of the others."""
    models: dict[str, PipelineModel] = {}
    errors: dict[str, str] = {}
    for name, path in paths.items():
        try:
            models[name] = load_model(path)
        except Exception as error:  # one unreadable model must not stop the others
            errors[name] = str(error)
    return models, errors


def _union(parts: list[DataFrame], errors: Mapping[str, str]) -> DataFrame:
    if not parts:
        raise ValueError(f"no model could be applied: {dict(errors)}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def predict_all(models: Mapping[str, PipelineModel], split: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """(model, listing_id, split, actual, predicted) of every model, and the errors of models that fail."""
    parts: list[DataFrame] = []
    errors: dict[str, str] = {}
    for name, model in models.items():
        try:
            # Staged, so that a model that fails while it runs is caught here.
            parts.append(stage(predictions(model, split).select(F.lit(name).alias("model"), "*")))
        except Exception as error:
            errors[name] = str(error)
    return _union(parts, errors), errors


def residuals_of(predicted: DataFrame) -> DataFrame:
    """(model, listing_id, predicted, residual) of the test rows."""
    return M.residuals(predicted, ("model", S.ID))


def ranges_of(predicted: DataFrame) -> DataFrame:
    """Ends of the ideal line of each model."""
    return predicted.groupBy("model").agg(
        F.least(F.min("actual"), F.min("predicted")).alias("low"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("high"),
    )


def trends_of(predicted: DataFrame) -> DataFrame:
    """The price trend of each model: actual and predicted values along the order of the actual ones.

    One sort for each model, spread over the cluster; there are as many as models, not as rows.
    """
    names = sorted(r[0] for r in predicted.select("model").distinct().collect())
    parts = [
        price_trend(predicted.where(F.col("model") == name)).select(F.lit(name).alias("model"), "*") for name in names
    ]
    return _union(parts, {})


def metrics_of(predicted: DataFrame) -> DataFrame:
    """The eight metrics of each model."""
    names = sorted(r[0] for r in predicted.select("model").distinct().collect())
    return _union([M.evaluate_train_test(predicted.where(F.col("model") == name), name) for name in names], {})


def explain_requests(
    model: PipelineModel, requests: DataFrame, lookup: DataFrame, key: str = "request_id"
) -> DataFrame | None:
    """(key, feature, contribution, base_value) of requests after fallback and filling; None if the model has no trees."""
    prepared = prepare_requests(model, requests, lookup)
    return explain_trees(model, prepared.withColumn(key, F.col(f"request.`{key}`")), key)
