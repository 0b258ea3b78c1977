"""Split, encoding, models, tuning, evaluation, scoring and attribution."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog.common import (
    CLEAN_COLUMNS_SQL, CLEAN_SQL, FLAGS, REQUESTS_SQL, SPLIT_SQL, TRAIN_FITTED_SQL, _once, baseline, baseline_sql, clean_output, clean_table,
    on_baseline, on_clean, requests, rounded, split_table,
)
from lotwise.catalog.tables import metrics_sql
from lotwise.fixtures import listings
from lotwise.ml import features as X
from lotwise.ml import metrics as M
from lotwise.ml.explain import explain_trees
from lotwise.ml.models import MODEL_NAMES, fit, predict
from lotwise.ml.search import best_params_report, spark_parameters
from lotwise.ml.split import with_folds
from lotwise.operators.encoding import select_features
from lotwise.operators.market import lookup_table
from lotwise.operators.profile import per_column
from lotwise.plans import scoring as P
from lotwise.plans.training import Trained, prepare_split, train_model
from lotwise.sources.staging import small_table, stage, staging_root

#: One point of the published search space for each kind, at its full size; finding a better one is the work of ``randomized_search``.
POINTS = {
    "linear": {},
    "forest": {
        "numTrees": 600, "maxDepth": 15, "minInstancesPerNode": 5, "featureSubsetStrategy": "0.35", "subsamplingRate": 0.75, "minInfoGain": 0.002,
    },
    "boosted": {
        "maxIter": 200, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5,
        "minInfoGain": 0.0,
    },
    "svr": {"kernel": "rbf", "C": 5, "epsilon": 0.1, "gamma": "scale", "k": "all"},
}
BOOSTED = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1}
TUNED = ("forest", "boosted", "svr")


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return split_table(spark, sf).where("split = 'train'").drop("split")


def _model(spark: SparkSession, sf: str, kind: str) -> PipelineModel:
    """The model of the stated point; the queries of a session share it."""
    return _once(f"model_{kind}", spark, sf, lambda: fit(_train(spark, sf), kind, **spark_parameters(kind, POINTS[kind])))


def _fit_linear(spark: SparkSession, sf: str) -> DataFrame:
    """The slope of the squared error along every column of the design: least squares is where all are 0.

    One row for each level, flag and scaled number, with the train rows that have it.
    """
    train = _train(spark, sf)
    numbers, places = [S.TX, S.LOG_SIZE, S.DENSITY], ["Area", "State", "Tenure"]
    rows = X.standard_scale(predict(_model(spark, sf, "linear"), train), numbers, X.scaling_parameters(train, numbers))
    error = F.log1p(S.TARGET) - F.log1p("pred_price")
    products = {c: F.col("e") * F.col(f"`{c}`").cast("double") for c in [*numbers, *FLAGS]}
    # Added up by all three places first, so that each row is read once and only the sums are taken apart.
    sums = rows.withColumn("e", error).groupBy(*places).agg(
        F.count(F.lit(1)).alias("n"), F.struct(F.count("e").alias("m"), F.sum("e").alias("s")).alias("_rows"),
        *[F.struct(F.count(x).alias("m"), F.sum(x).alias("s")).alias(f"_{c}") for c, x in products.items()],
    )
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("level"), F.col("_rows").alias("sums")) for c in places]
    entries += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("string").alias("level"), F.col(f"`_{c}`").alias("sums")) for c in products]
    long = sums.select("n", F.explode(F.array(*entries)).alias("c")).select("n", "c.*")
    slopes = long.groupBy("feature", "level").agg(F.sum("n").alias("n"), (F.sum("sums.s") / F.sum("sums.m")).alias("slope"))
    # Adding 0 makes a negative zero positive.
    return slopes.select("feature", "level", "n", (F.round("slope", 6) + 0.0).alias("slope"))


def _fitted(kind: str):
    """Rows, finite predictions and predictions inside the range of the train prices by split, and whether the model beats the mean."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = split_table(spark, sf)
        label, guess = F.log1p(S.TARGET), F.log1p("pred_price")
        low, high, mean = _train(spark, sf).agg(F.min(label), F.max(label), F.avg(label)).first()
        finite = F.col("pred_price").isNotNull() & ~F.isnan("pred_price") & (F.abs("pred_price") < float("inf"))
        # A sum of boosted steps and a smooth curve may pass the ends a little; means of leaves may not.
        slack = 1e-9 if kind == "forest" else (high - low) / 2
        return predict(_model(spark, sf, kind), rows).groupBy("split").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(finite).alias("finite"),
            F.count_if(guess.between(low - slack, high + slack)).alias("in_range"),
            (F.sum((label - guess) ** 2) < F.sum((label - F.lit(mean)) ** 2)).alias("beats_mean"),
        )

    return query


def _searched(spark: SparkSession, sf: str, kind: str) -> Trained:
    """The full search; its scores lie below the staging root, so a stopped query goes on with the rest."""
    options = {"scores_path": f"{staging_root(spark).rstrip('/')}/lotwise-search"}
    return _once(f"tuned_{kind}", spark, sf, lambda: train_model(split_table(spark, sf), kind, search=options))


def _fit_on_train(spark: SparkSession, sf: str) -> DataFrame:
    """The clean table whose medians, fences, densities and rare values come from the train rows."""
    return clean_output(prepare_split(listings(spark, sf), fit_on="train"), "split")


def _scaled(spark: SparkSession, sf: str) -> DataFrame:
    columns = [S.TX, S.LOG_SIZE, S.DENSITY]
    parameters = X.scaling_parameters(_train(spark, sf), columns)
    return rounded(X.standard_scale(split_table(spark, sf).select(S.ID, *columns), columns, parameters), 6)


def _one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Slot of the one in each sparse vector; NULL for an Area that only test rows have."""
    columns = ["Area", "State", "Tenure"]
    model = Pipeline(stages=X.one_hot_stages(columns)).fit(X.with_label(_train(spark, sf)))
    rows = model.transform(split_table(spark, sf))
    slots = [F.get(F.unwrap_udt(f"_onehot_{c}")["indices"], 0).cast("long").alias(f"{c}_slot") for c in columns]
    return rows.select(S.ID, *columns, *slots)


def _assemble(spark: SparkSession, sf: str) -> DataFrame:
    """Width, places and sum of the entries of each vector that are not 0."""
    rows = split_table(spark, sf)
    encoder = X.fit_encoder(_train(spark, sf), X.FEATURE_SETS["linear"])
    vector = F.unwrap_udt(F.col("features"))
    width = F.coalesce(vector["size"], F.size(vector["values"])).alias("width")
    places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    entry = F.explode(F.arrays_zip(places.alias("place"), vector["values"].alias("x"))).alias("e")
    long = encoder.transform(rows).select(S.ID, width, entry).where("e.x <> 0")
    return long.groupBy(S.ID, "width").agg(
        F.count(F.lit(1)).alias("non_zero"), F.sum("e.place").alias("places"), (F.round(F.sum("e.x"), 6) + 0.0).alias("total")
    )


def _target_log(spark: SparkSession, sf: str) -> DataFrame:
    labelled = X.with_label(clean_table(spark, sf))
    return rounded(labelled.select(S.ID, X.LABEL, F.expm1(X.LABEL).alias("price")), 4)


def _select_k_best(spark: SparkSession, sf: str) -> DataFrame:
    train = _train(spark, sf)
    encoder = X.fit_encoder(train, X.FEATURE_SETS["svr"])
    selector = X.select_k_best(15).fit(encoder.transform(X.with_label(train)))
    chosen = list(X.slot_names(encoder, selector.getIndices()).items())
    return small_table(spark, chosen, "slot int, feature string")


def _feature_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Input columns of each model with the number of values the clean table has for them."""
    clean = clean_table(spark, sf)
    parts = []
    for kind, features in X.FEATURE_SETS.items():
        chosen = select_features(clean, features.categorical, features.numeric, target=None).drop(S.ID)
        counts = per_column(chosen, chosen.columns, {"n": lambda c: F.count(f"`{c}`")})
        parts.append(counts.select(F.lit(kind).alias("kind"), F.col("column").alias("feature"), "n"))
    return reduce(DataFrame.unionByName, parts)


def _search(spark: SparkSession, sf: str) -> DataFrame:
    """All candidates of the three kinds that are tuned."""
    parts = [_searched(spark, sf, kind).report.withColumn("kind", F.lit(kind)) for kind in TUNED]
    return reduce(DataFrame.unionByName, parts)


def _best_params(spark: SparkSession, sf: str) -> DataFrame:
    parts = [best_params_report(_searched(spark, sf, kind).report).withColumn("kind", F.lit(kind)) for kind in TUNED]
    return reduce(DataFrame.unionByName, parts)


def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    parts = [M.evaluate_train_test(baseline(spark, sf, by), f"by_{by.lower()}") for by in ("State", "Tenure")]
    return rounded(M.model_comparison(parts[0].unionByName(parts[1])), 6)


def _score(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares on the Area alone, whose closed form SQL has: the mean of each Area, the mean of all for others."""
    model = fit(_train(spark, sf).drop(*FLAGS), "linear", features=X.FeatureSet(("Area",), ()))
    lookup = stage(lookup_table(listings(spark, sf)))
    scored = P.score(model, MODEL_NAMES["linear"], requests(spark, sf), lookup)
    return scored.select("request_id", "model", F.round("pred_price", 4).alias("pred_price"), F.array_join("notes", " | ").alias("notes"))


def _score_all(spark: SparkSession, sf: str) -> DataFrame:
    """For each request and model whether a usable price came out, and the notes of all models."""
    models = {MODEL_NAMES[k]: _model(spark, sf, k) for k in POINTS}
    lookup = stage(lookup_table(listings(spark, sf)))
    scored, errors = P.score_all_models(models, requests(spark, sf), lookup)
    if errors:  # without a model the result would lack its rows
        raise ValueError(f"models that could not be applied: {errors}")
    limits = P.compare_scores(scored).select("request_id", F.array_join("notes", " | ").alias("notes"), "axis_limit")
    usable = (F.col("pred_price") > 0) & (F.col("pred_price") < F.col("axis_limit"))
    return scored.join(limits, "request_id").select("request_id", "model", usable.alias("usable"), limits["notes"])


def _explain(spark: SparkSession, sf: str) -> DataFrame:
    """Whether base value and contributions add up to the prediction, for every row."""
    rows = split_table(spark, sf)
    model = fit(_train(spark, sf), "boosted", **BOOSTED)
    sums = explain_trees(model, rows, S.ID).groupBy(S.ID).agg(
        (F.sum("contribution") + F.first("base_value")).alias("explained")
    )
    predicted = predict(model, rows).select(S.ID, F.log1p("pred_price").alias("log_pred"))
    same = F.abs(F.col("log_pred") - F.col("explained")) < 1e-8
    return predicted.join(sums, S.ID).select(S.ID, same.alias("adds_up"))


def _fit_one_slot(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares on a single number, which SQL has as well."""
    rows = split_table(spark, sf).select(S.ID, "split", S.LOG_SIZE, S.TARGET)
    one = X.FeatureSet((), (S.LOG_SIZE,))
    model = fit(rows.where("split = 'train'"), "linear", features=one)
    return predict(model, rows).select(S.ID, F.round(F.log1p("pred_price"), 6).alias("log_pred"))


def _select_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The four best of the numbers and flags; the F-test ranks by squared correlation."""
    train = _train(spark, sf)
    encoder = X.fit_encoder(train, X.FeatureSet((), X.FEATURE_SETS["svr"].numeric))
    selector = X.select_k_best(4).fit(encoder.transform(X.with_label(train)))
    names = X.slot_names(encoder, selector.getIndices())
    return small_table(spark, [(n,) for n in names.values()], "feature string")


QUERIES = {
    "train_test_split": lambda spark, sf: split_table(spark, sf).select(S.ID, "State", "split"),
    "train_test_split_fit_on_train": _fit_on_train,
    "kfold": lambda spark, sf: with_folds(clean_table(spark, sf)).select(S.ID, "fold"),
    "standard_scale": _scaled,
    "one_hot": _one_hot,
    "assemble": _assemble,
    "target_log": _target_log,
    "select_k_best": _select_k_best,
    "select_k_best_numbers": _select_numbers,
    "feature_sets": _feature_sets,
    "metrics_price": lambda spark, sf: rounded(M.metrics_price(baseline(spark, sf)), 4),
    "metrics_log": lambda spark, sf: rounded(M.metrics_log(baseline(spark, sf)), 6),
    "evaluate_train_test": lambda spark, sf: rounded(M.evaluate_train_test(baseline(spark, sf), "by_state"), 6),
    "model_comparison": _comparison,
    "fit_linear": _fit_linear,
    "fit_linear_one_slot": _fit_one_slot,
    "fit_forest": _fitted("forest"),
    "fit_boosted": _fitted("boosted"),
    "fit_svr": _fitted("svr"),
    "randomized_search": _search,
    "best_params_report": _best_params,
    "score": _score,
    "score_all_models": _score_all,
    "explain_trees": _explain,
}


def _scale_sql(column: str) -> str:
    train = "FROM split WHERE split = 'train'"
    return f"round(({column} - (SELECT avg({column}) {train})) / (SELECT stddev_pop({column}) {train}), 6) AS {column}"


def _slot_sql(column: str) -> str:
    return (
        f"(SELECT DISTINCT {column} AS v, dense_rank() OVER (ORDER BY {column}) - 1 AS i FROM split WHERE split = 'train') {column}_s "
        f"ON {column}_s.v = split.{column}"
    )


def _metric_sql(actual: str, predicted: str, digits: int) -> str:
    e = f"({actual} - {predicted})"
    return (
        f"SELECT round(avg(abs({e})), {digits}) AS mae, round(sqrt(avg({e} ** 2)), {digits}) AS rmse, "
        f"round(avg(abs({e}) / abs({actual})), {digits}) AS mape, "
        f"round(1 - sum({e} ** 2) / (var_pop({actual}) * count({actual})), {digits}) AS r2 FROM preds"
    )


_RESOLVED_SQL = (
    "effects AS (SELECT Area, avg(ln(1 + Median_Price)) AS m FROM split WHERE split = 'train' GROUP BY Area), "
    "remapped AS (SELECT r.*, CASE WHEN r.State IS NOT NULL AND e.Area IS NULL AND b.Area IS NOT NULL THEN b.Area ELSE r.Area END AS used, "
    "r.Area IS NOT NULL AND r.State IS NOT NULL AND e.Area IS NULL AS is_remapped "
    "FROM requests r LEFT JOIN effects e ON r.Area = e.Area LEFT JOIN effects b ON b.Area = 'Other_' || r.State), "
    "resolved AS (SELECT *, CASE WHEN is_remapped THEN format('"
    + P.NOTE_FALLBACK.replace("'", "''").replace("%s", "{}")
    + "', Area, used) ELSE '' END AS note, CASE WHEN Estimated_Size IS NULL THEN '"
    + (P.NOTE_FILLED % S.LOG_SIZE).replace("'", "''")
    + "' ELSE '' END AS size_note FROM remapped)"
)

# The squared correlation of a 0/1 slot with the label follows from the rows and the mean label of its level.
_SLOT_SCORES_SQL = (
    "t AS (SELECT *, ln(1 + Median_Price) AS y FROM split WHERE split = 'train'), "
    "a AS (SELECT count(*) AS n, avg(y) AS m, var_pop(y) AS v FROM t), levels AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS part, '{c}_' || {c} AS feature, {c} AS level, "
        "count(*) * (avg(y) - any_value(m)) ** 2 / ((1 - count(*) / any_value(n)) * any_value(n) * any_value(v)) AS r2 "
        f"FROM t, a GROUP BY {c}"
        for i, c in enumerate(("Area", "State", "Tenure"))
    )
    + "), numbers AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS i, '{c}' AS feature, corr({c}, y) ** 2 AS r2 FROM t" for i, c in enumerate((S.TX, S.LOG_SIZE, S.DENSITY))
    )
    + "), flags AS ("
    + " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, corr(\"{c}\", y) ** 2 AS r2 FROM t" for i, c in enumerate(FLAGS))
    + "), scores AS (SELECT i AS slot, feature, r2 FROM numbers UNION ALL "
    "SELECT CAST(2 + row_number() OVER (ORDER BY part, level) AS INTEGER), feature, r2 FROM levels UNION ALL "
    "SELECT CAST(3 + (SELECT count(*) FROM levels) + i AS INTEGER), feature, r2 FROM flags)"
)

SQL = {
    "train_test_split": f"WITH {SPLIT_SQL} SELECT listing_id, State, split FROM split",
    "train_test_split_fit_on_train": f"WITH {TRAIN_FITTED_SQL} SELECT {CLEAN_COLUMNS_SQL}, split FROM train_fitted",
    "kfold": on_clean(
        "SELECT listing_id, CAST(CAST('0x' || substr(md5('43:' || listing_id), 1, 13) AS BIGINT) % 5 AS INTEGER) AS fold FROM clean"
    ),
    "feature_sets": on_clean(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, '{c}' AS feature, count(\"{c}\") AS n FROM clean"
            for kind, f in X.FEATURE_SETS.items()
            for c in f.columns(FLAGS)
        )
    ),
    "standard_scale": (
        f"WITH {SPLIT_SQL} SELECT listing_id, {_scale_sql('Transactions')}, {_scale_sql('Log_Estimated_Size')}, "
        f"{_scale_sql('Area_Transaction_Density')} FROM split"
    ),
    "one_hot": (
        f"WITH {SPLIT_SQL} SELECT listing_id, Area, State, Tenure, Area_s.i AS Area_slot, State_s.i AS State_slot, "
        f"Tenure_s.i AS Tenure_slot FROM split LEFT JOIN {_slot_sql('Area')} LEFT JOIN {_slot_sql('State')} "
        f"LEFT JOIN {_slot_sql('Tenure')}"
    ),
    "assemble": (
        f"WITH {SPLIT_SQL}, t AS (SELECT * FROM split WHERE split = 'train'), "
        "w AS (SELECT count(DISTINCT Area) AS a, count(DISTINCT State) AS s, count(DISTINCT Tenure) AS t FROM t), "
        + "z AS (SELECT listing_id, split.Area, split.State, split.Tenure, Area_s.i AS ai, State_s.i AS si, Tenure_s.i AS ti, "
        + ", ".join(f"({c} - (SELECT avg({c}) FROM t)) / (SELECT stddev_pop({c}) FROM t) AS z{i}" for i, c in enumerate((S.TX, S.LOG_SIZE, S.DENSITY)))
        + ", "
        + ", ".join(f'"{c}"' for c in FLAGS)
        + f" FROM split LEFT JOIN {_slot_sql('Area')} LEFT JOIN {_slot_sql('State')} LEFT JOIN {_slot_sql('Tenure')}), "
        + "e AS ("
        + " UNION ALL ".join(
            [f"SELECT listing_id, {i} AS place, z{i} AS x FROM z" for i in range(3)]
            + ["SELECT listing_id, 3 + ai, 1 FROM z WHERE ai IS NOT NULL", "SELECT listing_id, 3 + a + si, 1 FROM z, w WHERE si IS NOT NULL"]
            + ["SELECT listing_id, 3 + a + s + ti, 1 FROM z, w WHERE ti IS NOT NULL"]
            + [f'SELECT listing_id, 3 + a + s + t + {i}, "{c}" FROM z, w' for i, c in enumerate(FLAGS)]
        )
        + f") SELECT listing_id, CAST((SELECT 3 + a + s + t + {len(FLAGS)} FROM w) AS INTEGER) AS width, count(*) AS non_zero, "
        "CAST(sum(place) AS BIGINT) AS places, round(sum(x), 6) AS total FROM e WHERE x <> 0 GROUP BY listing_id"
    ),
    "select_k_best": f"WITH {SPLIT_SQL}, {_SLOT_SCORES_SQL} SELECT slot, feature FROM scores ORDER BY r2 DESC, slot LIMIT 15",
    "select_k_best_numbers": (
        f"WITH {SPLIT_SQL} SELECT feature FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, corr({c}, ln(1 + Median_Price)) ** 2 AS r2 FROM split WHERE split = 'train'"
            for c in (S.TX, S.LOG_SIZE, S.DENSITY, *FLAGS)
        )
        + ") ORDER BY r2 DESC LIMIT 4"
    ),
    "fit_linear_one_slot": (
        f"WITH {SPLIT_SQL}, line AS (SELECT regr_slope(ln(1 + Median_Price), Log_Estimated_Size) AS a, "
        "regr_intercept(ln(1 + Median_Price), Log_Estimated_Size) AS b FROM split WHERE split = 'train') "
        "SELECT listing_id, round(b + a * Log_Estimated_Size, 6) AS log_pred FROM split, line"
    ),
    "fit_linear": (
        f"WITH {SPLIT_SQL}, t AS (SELECT * FROM split WHERE split = 'train'), n AS (SELECT count(*) AS n FROM t) "
        + " UNION ALL ".join(
            [f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n, CAST(0 AS DOUBLE) AS slope FROM t GROUP BY {c}" for c in ("Area", "State", "Tenure")]
            + [f"SELECT '{c}', NULL, n, CAST(0 AS DOUBLE) FROM n" for c in (S.TX, S.LOG_SIZE, S.DENSITY, *FLAGS)]
        )
    ),
    **{
        f"fit_{kind}": (
            f"WITH {SPLIT_SQL} SELECT split, count(*) AS n, count(*) AS finite, count(*) AS in_range, true AS beats_mean FROM split GROUP BY split"
        )
        for kind in TUNED
    },
    "score": (
        f"WITH {SPLIT_SQL}{REQUESTS_SQL.removeprefix(CLEAN_SQL)}, {_RESOLVED_SQL} "
        f"SELECT request_id, '{MODEL_NAMES['linear']}' AS model, "
        "round(exp(coalesce(u.m, (SELECT avg(ln(1 + Median_Price)) FROM split WHERE split = 'train'))) - 1, 4) AS pred_price, "
        "note AS notes FROM resolved LEFT JOIN effects u ON used = u.Area"
    ),
    "score_all_models": (
        f"WITH {SPLIT_SQL}{REQUESTS_SQL.removeprefix(CLEAN_SQL)}, {_RESOLVED_SQL} "
        "SELECT request_id, model, true AS usable, array_to_string(list_sort(list_filter([note, size_note], lambda x: x <> '')), ' | ') AS notes "
        "FROM resolved, (VALUES " + ", ".join(f"('{n}')" for n in MODEL_NAMES.values()) + ") m(model)"
    ),
    "explain_trees": f"WITH {SPLIT_SQL} SELECT listing_id, true AS adds_up FROM split",
    "target_log": on_clean(
        "SELECT listing_id, round(ln(1 + Median_Price), 4) AS log_price, round(Median_Price, 4) AS price FROM clean"
    ),
    "metrics_price": on_baseline(_metric_sql("actual", "predicted", 4)),
    "metrics_log": on_baseline(_metric_sql("ln(1 + actual)", "ln(1 + predicted)", 6)),
    "evaluate_train_test": on_baseline(metrics_sql("preds", "by_state")),
    "model_comparison": (
        f"WITH {SPLIT_SQL}, {baseline_sql()}, {baseline_sql('Tenure', 'preds2')}, m AS ("
        f"{metrics_sql('preds', 'by_state', 15)} UNION ALL {metrics_sql('preds2', 'by_tenure', 15)}) SELECT model, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in S.METRIC_NAMES)
        + ", round(train_r2 - test_r2, 6) AS gap_r2, round(test_mape * 100, 6) AS test_mape_pct FROM m"
    ),
}
