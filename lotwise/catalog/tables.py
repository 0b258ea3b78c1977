"""Sources and sinks: each query writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog.common import (
    CLEAN_COLUMNS_SQL, LOOKUP_SQL, SPLIT_SQL, baseline, baseline_sql, clean_output, clean_table,
    on_clean, on_listing, rounded, split_table,
)
from lotwise.fixtures import listings
from lotwise.ml import metrics as M
from lotwise.ml.models import fit, load_model, predict, save_model
from lotwise.operators.market import lookup_table
from lotwise.sources import results as R
from lotwise.sources.listings import read_clean, read_raw, write_clean
from lotwise.sources.staging import staging_path


def _read_raw(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark)
    write_clean(listings(spark, sf), path, "csv")
    return read_raw(spark, path)


def _read_clean(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark)
    clean = clean_table(spark, sf)
    write_clean(clean, path, "csv")
    return clean_output(read_clean(spark, path, "csv", clean.schema))


def _write_clean(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark)
    write_clean(clean_table(spark, sf), path)
    return clean_output(read_clean(spark, path))


def _result_write(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark)
    R.write_lookup_json(lookup_table(listings(spark, sf)), path)
    return rounded(R.read_lookup_json(spark, path), 10)


def _metrics_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark)
    by_tenure = baseline(spark, sf, "Tenure")
    R.metrics_upsert(M.evaluate_train_test(by_tenure, "by_state"), path)
    R.metrics_upsert(M.evaluate_train_test(by_tenure, "by_tenure"), path)
    R.metrics_upsert(M.evaluate_train_test(baseline(spark, sf), "by_state"), path)
    return rounded(R.read_metrics(spark, path))


def _model_save(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a saved and loaded model predicts the same as the model itself, for every row."""
    rows = split_table(spark, sf)
    model = fit(rows.where("split = 'train'"), "linear", maxIter=30)
    path = staging_path(spark)
    save_model(model, path)
    both = predict(model, rows).withColumnRenamed("pred_price", "pred_fitted")
    both = predict(load_model(path), both)
    same = F.abs(F.col("pred_price") - F.col("pred_fitted")) <= F.abs("pred_fitted") * 1e-9
    return both.select(S.ID, "split", same.alias("same"))


def metrics_sql(preds: str, model: str, digits: int = 6) -> str:
    """One row of the eight metrics of a table of predictions."""

    def part(split: str) -> str:
        where = f"FILTER (WHERE split = '{split}')"
        logs = "ln(1 + actual) - ln(1 + predicted)"
        return f"""
          round(1 - sum((actual - predicted) ** 2) {where} / (var_pop(actual) {where} * count(actual) {where}), {digits}) AS {split}_r2,
          round(avg(abs({logs})) {where}, {digits}) AS {split}_mae,
          round(sqrt(avg(({logs}) ** 2) {where}), {digits}) AS {split}_rmse,
          round(avg(abs(actual - predicted) / abs(actual)) {where}, {digits}) AS {split}_mape"""

    return f"SELECT '{model}' AS model, {part('train')}, {part('test')} FROM {preds}"


QUERIES = {
    "read_raw": _read_raw,
    "read_clean": _read_clean,
    "write_clean": _write_clean,
    "result_write": _result_write,
    "metrics_upsert": _metrics_upsert,
    "model_save": _model_save,
}

SQL = {
    "model_save": f"WITH {SPLIT_SQL} SELECT listing_id, split, true AS same FROM split",
    "read_raw": on_listing("SELECT * FROM listing"),
    "read_clean": on_clean(f"SELECT {CLEAN_COLUMNS_SQL} FROM clean"),
    "write_clean": on_clean(f"SELECT {CLEAN_COLUMNS_SQL} FROM clean"),
    "result_write": on_listing(
        f", {LOOKUP_SQL} SELECT * REPLACE (round(Area_Transaction_Density, 10) AS Area_Transaction_Density) FROM lookup"
    ),
    "metrics_upsert": (
        f"WITH {SPLIT_SQL}, {baseline_sql()}, {baseline_sql('Tenure', 'preds2')} "
        f"{metrics_sql('preds', 'by_state')} UNION ALL {metrics_sql('preds2', 'by_tenure')}"
    ),
}
