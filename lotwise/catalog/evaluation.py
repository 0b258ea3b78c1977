"""Several models on the same split. Two lines through one number each have closed forms in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog.common import SPLIT_SQL, _once, rounded, split_table
from lotwise.catalog.tables import metrics_sql
from lotwise.ml.features import FeatureSet
from lotwise.ml.models import fit
from lotwise.plans import evaluation as E

_LINES = {"by_density": S.DENSITY, "by_size": S.LOG_SIZE, "by_transactions": S.TX}


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    def make() -> DataFrame:
        # Without the type flags, which every model would take as inputs.
        rows = split_table(spark, sf).select(S.ID, "split", S.TARGET, *_LINES.values())
        train = rows.where("split = 'train'")
        models = {name: fit(train, "linear", features=FeatureSet((), (column,))) for name, column in _LINES.items()}
        return E.predict_all(models, rows)[0]

    return _once("lines", spark, sf, make)


QUERIES = {
    "actual_vs_predicted_all": lambda spark, sf: rounded(_predicted(spark, sf), 2),
    "residuals_all": lambda spark, sf: rounded(E.residuals_of(_predicted(spark, sf)), 2),
    "pred_range_all": lambda spark, sf: rounded(E.ranges_of(_predicted(spark, sf)), 2),
    "price_trend_all": lambda spark, sf: rounded(
        E.trends_of(_predicted(spark, sf).where("split = 'test'")).withColumn("index", F.col("index").cast("long")), 2
    ),
    "evaluate_all": lambda spark, sf: rounded(E.metrics_of(_predicted(spark, sf)), 6),
}

_LINES_SQL = f"WITH {SPLIT_SQL}, lines AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, p.listing_id, p.split, p.Median_Price AS actual, exp(b + a * p.{column}) - 1 AS predicted FROM split p, "
    f"(SELECT regr_slope(ln(1 + Median_Price), {column}) AS a, regr_intercept(ln(1 + Median_Price), {column}) AS b "
    "FROM split WHERE split = 'train')"
    for name, column in _LINES.items()
) + ")"


def _metrics_sql() -> str:
    each = ", ".join(f"m_{name} AS (SELECT * FROM lines WHERE model = '{name}')" for name in _LINES)
    return f"{_LINES_SQL}, {each} " + " UNION ALL ".join(metrics_sql(f"m_{name}", name) for name in _LINES)


SQL = {
    "actual_vs_predicted_all": (
        f"{_LINES_SQL} SELECT model, listing_id, split, round(actual, 2) AS actual, round(predicted, 2) AS predicted FROM lines"
    ),
    "residuals_all": (
        f"{_LINES_SQL} SELECT model, listing_id, round(predicted, 2) AS predicted, round(actual - predicted, 2) AS residual "
        "FROM lines WHERE split = 'test'"
    ),
    "pred_range_all": (
        f"{_LINES_SQL} SELECT model, round(least(min(actual), min(predicted)), 2) AS low, "
        "round(greatest(max(actual), max(predicted)), 2) AS high FROM lines GROUP BY model"
    ),
    "price_trend_all": (
        f"{_LINES_SQL} SELECT model, listing_id, round(actual, 2) AS actual, round(predicted, 2) AS predicted, "
        'row_number() OVER (PARTITION BY model ORDER BY actual, listing_id) - 1 AS "index" FROM lines WHERE split = \'test\''
    ),
    "evaluate_all": _metrics_sql(),
}
