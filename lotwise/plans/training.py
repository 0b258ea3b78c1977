"""Train, evaluate and store one of the four models."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from lotwise import schema as S
from lotwise.ml import metrics as M
from lotwise.ml.models import MODEL_NAMES, fit, predict, save_model
from lotwise.ml.search import randomized_search
from lotwise.ml.split import train_test_split
from lotwise.plans.fitted import split_and_fit
from lotwise.plans.preprocess import preprocess
from lotwise.sources.results import metrics_upsert
from lotwise.sources.staging import stage


@dataclass
class Trained:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    report: DataFrame | None


def prepare_split(raw: DataFrame, fit_on: str = "all") -> DataFrame:
    """Clean table with its ``split`` column, staged: every fit and evaluation reads it.

    By default the statistics of the preprocessing come from all rows, as published; ``fit_on="train"`` takes them from
    the train rows alone (:func:`lotwise.plans.fitted.split_and_fit`, which also returns them).
    """
    if fit_on not in ("all", "train"):
        raise ValueError('fit_on is "all" or "train"')
    return split_and_fit(raw)[0] if fit_on == "train" else stage(train_test_split(preprocess(raw)))


def predictions(model: PipelineModel, split: DataFrame) -> DataFrame:
    """(listing_id, split, actual, predicted) of all rows."""
    return M.actual_vs_predicted(predict(model, split), S.TARGET, "pred_price")


def train_model(
    split: DataFrame,
    kind: str,
    tune: bool = True,
    metrics_path: str | None = None,
    model_path: str | None = None,
    search: dict[str, Any] | None = None,
    **params: Any,
) -> Trained:
    """Fit on the train part (with a search unless linear or ``tune=False``), evaluate on both."""
    train = split.where("split = 'train'").drop("split")
    report = None
    if tune and kind != "linear":
        model, report = randomized_search(train, kind, **(search or {}))
    else:
        model = fit(train, kind, **params)
    predicted = predictions(model, split)
    metrics = stage(M.evaluate_train_test(predicted, MODEL_NAMES[kind]))
    if metrics_path:
        metrics_upsert(metrics, metrics_path)
    if model_path:
        save_model(model, model_path)
    return Trained(model, predicted, metrics, report)
