"""The tables behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog.common import FLAGS, baseline, clean_table, on_baseline, on_clean, on_listing, rounded
from lotwise.fixtures import listings
from lotwise.ml import metrics as M
from lotwise.operators import chartdata as D
from lotwise.operators.cleaning import bucket_rare_type
from lotwise.operators.encoding import melt_types

NUMBERS = [S.TARGET, S.PSF, S.TX]


#: Raw and log views of all numeric columns, the target with its own number of bins.
RAW_VIEWS = [
    *[D.View(c, c) for c in NUMBERS],
    *[D.View(f"{c}_log", c, log=True) for c in (S.PSF, S.TX)],
    D.View("target", S.TARGET, D.TARGET_BINS),
    D.View("target_log", S.TARGET, D.TARGET_BINS, True),
]
CLEAN_VIEWS = [D.View("clean_price", S.TARGET, D.CLEAN_BINS)]


def _histograms(spark: SparkSession, sf: str) -> DataFrame:
    parts = [D.histograms(listings(spark, sf), RAW_VIEWS), D.histograms(clean_table(spark, sf), CLEAN_VIEWS)]
    return rounded(parts[0].unionByName(parts[1]), 7)


def _curves(spark: SparkSession, sf: str) -> DataFrame:
    parts = [D.kde_curves(listings(spark, sf), RAW_VIEWS), D.kde_curves(clean_table(spark, sf), CLEAN_VIEWS)]
    curves = parts[0].unionByName(parts[1])
    return curves.select("chart", "point", F.round("x", 4).alias("x"), F.round("density", 9).alias("density"), F.round("height", 4).alias("height"))


def _box_groups(spark: SparkSession, sf: str) -> DataFrame:
    raw, clean = bucket_rare_type(listings(spark, sf), 200), clean_table(spark, sf)
    types = melt_types(clean, [S.TARGET])
    charts = [(c, raw, c, False) for c in ("State", "Tenure", "Type_Plot")]
    charts += [("State_log", raw, "State", True), ("clean_tenure", clean, "Tenure", False), ("clean_type", types, "Type", False)]
    result = None
    for name, df, by, log in charts:
        part = rounded(D.box_stats_by_group(df, by, log=log), 4).withColumn("chart", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


QUERIES = {
    "histogram": _histograms,
    "kde_curve": _curves,
    "box_stats": lambda spark, sf: rounded(D.box_stats(listings(spark, sf)), 4),
    "box_stats_by_group": _box_groups,
    "melt_types": lambda spark, sf: melt_types(clean_table(spark, sf)),
    "scatter_sample": lambda spark, sf: rounded(D.scatter_points(listings(spark, sf)), 8),
    "scatter_grid": lambda spark, sf: D.scatter_grid(listings(spark, sf)),
    "price_trend": lambda spark, sf: rounded(
        D.price_trend(baseline(spark, sf).where("split = 'test'")), 4
    ),
    "pred_range": lambda spark, sf: rounded(M.pred_range(baseline(spark, sf)), 4),
    "residuals": lambda spark, sf: rounded(M.residuals(baseline(spark, sf)), 4),
    "actual_vs_predicted": lambda spark, sf: rounded(
        M.actual_vs_predicted(baseline(spark, sf), "actual", "predicted"), 4
    ),
}


def _histogram_sql(name: str, table: str, value: str, bins: int) -> str:
    return f"""
    SELECT '{name}' AS chart, CAST(i AS INTEGER) AS bin, round(lo + i * w, 7) AS low, round(lo + (i + 1) * w, 7) AS high,
           coalesce(n, 0) AS n
    FROM (SELECT i, lo, w FROM range({bins}) r(i),
          (SELECT min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM {table}))
    LEFT JOIN (SELECT least(floor(({value} - lo) / w), {bins - 1}) AS b, count(*) AS n FROM {table},
               (SELECT min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM {table})
               WHERE {value} IS NOT NULL GROUP BY 1) ON b = i"""


def _curve_sql(name: str, table: str, value: str, bins: int) -> str:
    return f"""
    SELECT '{name}' AS chart, point, round(any_value(x), 4) AS x, round(any_value(unit) * sum(k), 9) AS density,
           round(any_value(unit) * sum(k) * any_value(n * (hi - lo)) / {bins}, 4) AS height
    FROM (SELECT point, x, n, lo, hi, 1 / (n * h * 2.5066282746310002) AS unit, exp(-0.5 * ((x - v) / h) ** 2) AS k
          FROM (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / {D.CURVE_POINTS - 1} AS x, n, lo, hi, h FROM range({D.CURVE_POINTS}) r(i),
                (SELECT count({value}) AS n, min({value}) AS lo, max({value}) AS hi, stddev_samp({value}) * count({value}) ** (-0.2) AS h FROM {table})),
               (SELECT {value} AS v FROM {table} WHERE {value} IS NOT NULL))
    GROUP BY point"""


def _box_sql(table: str, value: str, group: str | None = None) -> str:
    """Statistics of a column, or of each group of it."""
    by = f'"{group}"' if group else "1"
    key = "g AS category" if group else f"'{value}' AS \"column\""
    return f"""
    SELECT {key}, count(x) AS n, round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS median,
           round(any_value(q3), 4) AS q3,
           round(least(any_value(q1), min(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))), 4) AS whisker_low,
           round(greatest(any_value(q3), max(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))), 4) AS whisker_high,
           count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM (SELECT {by} AS g, {value} AS x, quantile_cont({value}, 0.25) OVER (PARTITION BY {by}) AS q1,
                 quantile_cont({value}, 0.5) OVER (PARTITION BY {by}) AS q2,
                 quantile_cont({value}, 0.75) OVER (PARTITION BY {by}) AS q3
          FROM {table} WHERE {value} IS NOT NULL AND {by} IS NOT NULL)
    GROUP BY g"""


def _box_group_sql(chart: str, table: str, by: str, value: str = "Median_Price") -> str:
    return f"""
    SELECT b.*, position, '{chart}' AS chart FROM ({_box_sql(table, value, by)}) b
    JOIN (SELECT "{by}" AS category, CAST(row_number() OVER (ORDER BY quantile_cont(Median_Price, 0.5), "{by}") AS INTEGER)
          AS position FROM {table} WHERE Median_Price IS NOT NULL AND "{by}" IS NOT NULL GROUP BY "{by}") USING (category)"""


_UNION = " UNION ALL ".join
_LONG = ", long AS (" + _UNION(
    f"SELECT listing_id, Median_Price, '{f[5:]}' AS \"Type\" FROM clean WHERE \"{f}\" = 1" for f in FLAGS
) + ")"
_PLOT = (
    ", plotted AS (SELECT *, CASE WHEN \"Type\" IS NULL OR count(*) OVER (PARTITION BY \"Type\") < 200 THEN 'Others' "
    'ELSE "Type" END AS Type_Plot FROM listing)'
)
_LOG = "ln(1 + {})".format
_POINTS = "FROM listing WHERE Transactions IS NOT NULL AND Median_Price IS NOT NULL"

SQL = {
    "histogram": on_clean(
        _UNION(
            _histogram_sql(v.name, table, _LOG(v.column) if v.log else v.column, v.bins)
            for table, views in (("listing", RAW_VIEWS), ("clean", CLEAN_VIEWS))
            for v in views
        )
    ),
    "kde_curve": on_clean(
        _UNION(
            _curve_sql(v.name, table, _LOG(v.column) if v.log else v.column, v.bins)
            for table, views in (("listing", RAW_VIEWS), ("clean", CLEAN_VIEWS))
            for v in views
        )
    ),
    "box_stats": on_listing(_UNION(_box_sql("listing", c) for c in NUMBERS)),
    "box_stats_by_group": on_clean(
        _PLOT
        + _LONG
        + _UNION(
            [
                _box_group_sql("State", "plotted", "State"),
                _box_group_sql("Tenure", "plotted", "Tenure"),
                _box_group_sql("Type_Plot", "plotted", "Type_Plot"),
                _box_group_sql("State_log", "plotted", "State", _LOG(S.TARGET)),
                _box_group_sql("clean_tenure", "clean", "Tenure"),
                _box_group_sql("clean_type", "long", "Type"),
            ]
        )
    ),
    "melt_types": on_clean(f"{_LONG} SELECT * FROM long"),
    "scatter_sample": on_listing(
        f"SELECT listing_id, Transactions AS x, Median_Price AS y, round(ln(1 + Median_Price), 8) AS log_y {_POINTS}"
    ),
    "scatter_grid": on_listing(
        f", p AS (SELECT Transactions AS x, Median_Price AS y {_POINTS}), "
        "e AS (SELECT min(x) AS x0, (max(x) - min(x)) / 50 AS xw, min(y) AS y0, (max(y) - min(y)) / 50 AS yw FROM p) "
        "SELECT CAST(least(floor((x - x0) / xw), 49) AS INTEGER) AS x_bin, CAST(least(floor((y - y0) / yw), 49) AS INTEGER) "
        "AS y_bin, count(*) AS n FROM p, e GROUP BY 1, 2"
    ),
    "price_trend": on_baseline(
        'SELECT listing_id, actual, round(predicted, 4) AS predicted, row_number() OVER (ORDER BY actual, listing_id) - 1 AS "index" '
        "FROM preds WHERE split = 'test'"
    ),
    "pred_range": on_baseline(
        "SELECT round(least(min(actual), min(predicted)), 4) AS low, round(greatest(max(actual), max(predicted)), 4) AS high FROM preds"
    ),
    "residuals": on_baseline(
        "SELECT listing_id, round(predicted, 4) AS predicted, round(actual - predicted, 4) AS residual FROM preds WHERE split = 'test'"
    ),
    "actual_vs_predicted": on_baseline("SELECT listing_id, split, actual, round(predicted, 4) AS predicted FROM preds"),
}
