"""Split, encoding, models, search, metrics and attribution on a table with a known signal."""

from itertools import combinations
from math import ceil, factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.ml import explain as X
from lotwise.ml import features as E
from lotwise.ml import forest as R
from lotwise.ml import metrics as M
from lotwise.ml import models
from lotwise.ml.models import MODEL_NAMES, fit, fit_inputs, load_model, predict, save_model
from lotwise.ml.search import SEARCH_SPACES, best_params_report, randomized_search, sample_points, spark_parameters
from lotwise.ml.split import hash_split, train_test_split, with_folds
from lotwise.plans.training import train_model
from lotwise.sources.results import read_metrics
from lotwise.sources.staging import stage

SMALL = {
    "linear": {},
    "forest": {"numTrees": 8, "maxDepth": 5},
    "boosted": {"maxIter": 8, "maxDepth": 3},
    "svr": {"gamma": 0.05, "components": 64, "epsilon": 0.1, "C": 10.0},
}


@pytest.fixture(scope="module")
def signal(spark):
    rng = np.random.default_rng(11)
    n = 1500
    area = rng.integers(0, 12, n)
    size = rng.lognormal(7, 0.4, n)
    flat = rng.integers(0, 2, n)
    log_price = 8 + 0.7 * np.log1p(size) + 0.1 * area - 0.3 * flat + rng.normal(0, 0.1, n)
    frame = pd.DataFrame(
        {
            S.ID: np.arange(n),
            "Area": [f"area {a}" for a in area],
            "State": [f"state {a % 3}" for a in area],
            "Tenure": rng.choice(["Freehold", "Leasehold"], n),
            S.TX: rng.integers(5, 60, n).astype(float),
            S.LOG_SIZE: np.log1p(size),
            S.DENSITY: (area + 1) / 100.0,
            "Type_Flat": flat.astype("int32"),
            "Type_Semi D": (1 - flat).astype("int32"),
            S.TARGET: np.expm1(log_price),
        }
    )
    return stage(train_test_split(stage(spark.createDataFrame(frame))))


@pytest.fixture(scope="module")
def train(signal):
    return signal.where("split = 'train'").drop("split")


def test_split_is_stratified_and_exact(spark):
    df = spark.range(1003).select(F.col("id").alias(S.ID), F.when(F.col("id") < 700, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("State"))
    found = train_test_split(stage(df)).toPandas()
    assert len(found) == 1003 and found[S.ID].is_unique
    assert (found.split == "test").sum() == ceil(0.2 * 1003)
    for _, group in found.groupby("State"):
        assert abs((group.split == "test").sum() - 0.2 * len(group)) < 1
    again = train_test_split(stage(df.repartition(5))).toPandas().set_index(S.ID).split
    assert again.sort_index().tolist() == found.set_index(S.ID).split.sort_index().tolist()


def test_split_without_strata(spark):
    df = stage(spark.range(50).select(F.col("id").alias(S.ID), F.when(F.col("id") == 0, "alone").otherwise("many").alias("State")))
    with pytest.warns(UserWarning, match="not stratified"):
        assert train_test_split(df).where("split = 'test'").count() == 10


def test_hash_split_and_folds(spark):
    df = spark.range(20000).select(F.col("id").alias(S.ID))
    assert abs(hash_split(df).where("split = 'test'").count() - 4000) < 250
    sizes = with_folds(df).groupBy("fold").count().toPandas()
    assert len(sizes) == 5 and sizes["count"].between(3800, 4200).all()


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, k double")
    assert sorted(tuple(r) for r in E.standard_scale(df, ["x", "k"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_unseen_categories_are_all_zero(spark, train):
    encoder = E.fit_encoder(train, E.FEATURE_SETS["linear"])
    names = E.encoded_names(encoder)
    assert names[:4] == [S.TX, S.LOG_SIZE, S.DENSITY, "Area_area 0"] and names[-2:] == ["Type_Flat", "Type_Semi D"]
    row = train.limit(1).withColumns({"Area": F.lit("nowhere"), "State": F.lit(None).cast("string")})
    vector = encoder.transform(row).select(vector_to_array("features")).first()[0]
    assert len(vector) == len(names) == 3 + 12 + 3 + 2 + 2
    assert not any(vector[i] for i, n in enumerate(names) if n.startswith(("Area_area", "State_")))
    boosted = E.fit_encoder(train, E.FEATURE_SETS["boosted"])
    assert S.DENSITY not in E.encoded_names(boosted)


@pytest.mark.parametrize("kind", list(SMALL))
def test_models_beat_the_mean_and_survive_saving(spark, signal, tmp_path, kind):
    metrics, model_path = str(tmp_path / "metrics"), str(tmp_path / "model")
    done = train_model(signal, kind, tune=False, metrics_path=metrics, model_path=model_path, **SMALL[kind])
    row = read_metrics(spark, metrics).first()
    assert row["model"] == MODEL_NAMES[kind]
    assert row["test_r2"] > 0.6 and row["test_mae"] < 0.3
    test = signal.where("split = 'test'")
    before = {r[S.ID]: r["pred_price"] for r in predict(done.model, test).collect()}
    after = {r[S.ID]: r["pred_price"] for r in predict(load_model(model_path), test).collect()}
    assert before.keys() == after.keys()
    assert all(after[k] == pytest.approx(v, rel=1e-9) for k, v in before.items())


def test_save_overwrites(spark, train, tmp_path):
    model = fit(train, "linear")
    for _ in range(2):
        save_model(model, str(tmp_path / "m"))


def test_search_points_are_distinct_and_seeded():
    for kind, size in {"forest": 1296, "boosted": 3888, "svr": 1680}.items():
        space = SEARCH_SPACES[kind]
        assert np.prod([len(v) for v in space.values()]) == size
        points = sample_points(space, 40)
        assert points == sample_points(space, 40)
        assert len({str(p) for p in points}) == 40
    assert len(sample_points({"a": [1, 2]}, 50)) == 2


@pytest.mark.parametrize(
    ("kind", "space"),
    [
        ("boosted", {"maxIter": [1, 6], "maxDepth": [3], "stepSize": [0.3]}),
        ("svr", {"kernel": ["rbf", "linear"], "C": [5], "epsilon": [0.1], "gamma": ["scale"], "k": [15]}),
    ],
)
def test_randomized_search(train, kind, space):
    model, report = randomized_search(train, kind, candidates=2, space=space, folds=3)
    rows = report.collect()
    assert len(rows) == 2 and sum(r["is_best"] for r in rows) == 1
    best = best_params_report(report).first()
    assert best["mean_r2"] == max(r["mean_r2"] for r in rows) > 0.2
    assert predict(model, train).where("pred_price > 0").count() == train.count()


def test_svr_parameters():
    point = {"kernel": "linear", "C": 2, "epsilon": 0.1, "gamma": "scale", "k": "all"}
    assert spark_parameters("svr", point) == {"C": 2.0, "epsilon": 0.1}
    rbf = spark_parameters("svr", {**point, "kernel": "rbf", "k": 15})
    assert rbf["gamma"] == "scale" and rbf["k"] == 15


def test_k_best_ranks_by_correlation(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)) * [1, 10, 0, 1, 1]
    y = x[:, 1] * 0.1 + x[:, 3] * 2 + rng.normal(size=300)
    rows = [(list(map(float, r)), float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, f"x array<double>, {E.LABEL} double").select(array_to_vector("x").alias("features"), E.LABEL)
    expected = [np.corrcoef(x[:, i], y)[0, 1] ** 2 if i != 2 else -1 for i in range(5)]
    assert E.f_scores(df, "features", E.LABEL) == pytest.approx(expected)
    model = E.select_k_best(2).fit(df)
    assert model.getIndices() == [1, 3]
    assert model.transform(df).first()["selected"].size == 2
    assert E.select_k_best(99).fit(df).getIndices() == [0, 1, 2, 3, 4]


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(2)
    y = rng.lognormal(12, 0.5, 400)
    p = y * rng.lognormal(0, 0.2, 400)
    frame = pd.DataFrame({"actual": y, "predicted": p, "split": np.where(rng.random(400) < 0.7, "train", "test")})
    df = spark.createDataFrame(frame)

    def expected(a, b):
        e = a - b
        return [np.abs(e).mean(), np.sqrt((e**2).mean()), (np.abs(e) / np.abs(a)).mean(), 1 - (e**2).sum() / ((a - a.mean()) ** 2).sum()]

    assert tuple(M.metrics_price(df).first()) == pytest.approx(expected(y, p))
    assert tuple(M.metrics_log(df).first()) == pytest.approx(expected(np.log1p(y), np.log1p(p)))
    row = M.evaluate_train_test(df, "m").first()
    part = frame[frame.split == "test"]
    price, log = expected(part.actual, part.predicted), expected(np.log1p(part.actual), np.log1p(part.predicted))
    assert [row["test_mae"], row["test_rmse"], row["test_mape"], row["test_r2"]] == pytest.approx([log[0], log[1], price[2], price[3]])


def test_comparison_accepts_absent_metrics(spark):
    # Published metrics of two models.
    rows = [("Random Forest", 0.7714865529864886, 0.6342619636985303, 0.25494000950922824), ("XGBoost", 0.789594573151496, 0.6692918776175936, None)]
    df = M.model_comparison(spark.createDataFrame(rows, "model string, train_r2 double, test_r2 double, test_mape double"))
    found = {r["model"]: r for r in df.collect()}
    assert round(found["Random Forest"]["gap_r2"], 4) == 0.1372 and round(found["XGBoost"]["gap_r2"], 4) == 0.1203
    assert round(found["Random Forest"]["test_mape_pct"], 2) == 25.49
    assert found["XGBoost"]["train_mae"] is None


def _brute_force(nodes, weight, row, features):
    """Shapley values from the expectation over every subset of features."""

    def value(known, index=0):
        node = nodes[index]
        if node["leftChild"] < 0:
            return weight * node["prediction"]
        left, right = node["leftChild"], node["rightChild"]
        if node["featureIndex"] in known:
            x = row[node["featureIndex"]]
            goes_left = x in node["cut"] if node["numCategories"] > 0 else x <= node["cut"][0]
            return value(known, left if goes_left else right)
        share = nodes[left]["cover"] / node["cover"]
        return share * value(known, left) + (1 - share) * value(known, right)

    d, result = len(features), {}
    for f in features:
        rest = [g for g in features if g != f]
        result[f] = sum(
            factorial(k) * factorial(d - k - 1) / factorial(d) * (value({*s, f}) - value(set(s)))
            for k in range(d)
            for s in combinations(rest, k)
        )
    return result


def test_leaf_contributions_match_brute_force():
    def node(prediction, cover, left=-1, right=-1, feature=-1, cut=(), categories=-1):
        return {"prediction": prediction, "cover": cover, "leftChild": left, "rightChild": right,
                "featureIndex": feature, "cut": list(cut), "numCategories": categories}

    nodes = {
        0: node(0.0, 100, 1, 2, 0, [0.5]), 1: node(0.0, 60, 3, 4, 1, [1.0], 2), 2: node(0.0, 40, 5, 6, 0, [2.0]),
        3: node(1.0, 20), 4: node(-2.0, 40), 5: node(5.0, 10), 6: node(0.0, 30, 7, 8, 2, [0.0]),
        7: node(3.0, 12), 8: node(9.0, 18),
    }
    rows = np.array([[0.2, 1.0, -1.0], [0.7, 0.0, 1.0], [3.0, 1.0, 0.0], [0.5, 0.0, 5.0]])
    totals = np.zeros_like(rows)
    for value, conditions in X.leaf_conditions(nodes, 0.5):
        for feature, part in X.leaf_contributions(rows, value, conditions).items():
            totals[:, feature] += part
    for row, total in zip(rows, totals):
        expected = _brute_force(nodes, 0.5, row, [0, 1, 2])
        assert total == pytest.approx([expected[f] for f in range(3)])


@pytest.mark.parametrize("kind", ["forest", "boosted"])
@pytest.mark.parametrize("encoding", ["one_hot", "indexed", "ordered"])
def test_contributions_add_up(signal, train, kind, encoding):
    model = fit(train, kind, encoding=encoding, **SMALL[kind])
    rows = signal.where("split = 'test'").drop("split")
    parts = X.explain_trees(model, rows, S.ID)
    assert parts.columns == [S.ID, "feature", "contribution", "base_value"]
    sums = parts.groupBy(S.ID).agg((F.sum("contribution") + F.first("base_value")).alias("explained"))
    both = predict(model, rows).join(sums, S.ID).select(F.log1p("pred_price").alias("p"), "explained").toPandas()
    assert len(both) == rows.count()
    np.testing.assert_allclose(both.explained, both.p, rtol=1e-9)
    names = {r["feature"] for r in parts.select("feature").distinct().collect()}
    assert S.LOG_SIZE in names
    assert ("Area" in names) == (encoding != "one_hot")


def test_only_trees_are_explained(train):
    assert X.explain_trees(fit(train, "linear"), train, S.ID) is None


def test_categories_are_indexed_for_trees(train):
    encoder, derived = fit_inputs(train, "forest")
    assert derived == {"maxBins": 32}
    assert "Area" in E.encoded_names(encoder) and E.tree_bins(encoder) == 32


def test_a_forest_is_fitted_and_scored_in_parts(signal, train, tmp_path, monkeypatch):
    """No fit and no pass over the rows holds more trees than a part; the parts are one forest, also after saving and in the contributions."""
    fits = []

    class Recorded(R.RandomForestRegressor):
        def __init__(self, **options):
            fits.append(options)
            super().__init__(**options)

    monkeypatch.setattr(R, "RandomForestRegressor", Recorded)
    monkeypatch.setattr(R, "PART", 3)
    monkeypatch.setattr(R, "SCORED", 2)
    model = fit(train, "forest", **SMALL["forest"], subsamplingRate=0.75)
    assert [f["numTrees"] for f in fits] == [3, 3, 2] and len({f["seed"] for f in fits}) == 3
    assert all(f["maxDepth"] == 5 and f["subsamplingRate"] == 0.75 and f["maxMemoryInMB"] <= 256 for f in fits)
    rows = signal.where("split = 'test'").drop("split")
    found = predict(model, rows).select(S.ID, F.log1p("pred_price").alias("p")).orderBy(S.ID).toPandas()
    forest = X.tree_stage(model)
    trees = [t for part in forest.parts() for t in part.trees]
    assert len(trees) == len(forest.treeWeights) == 8
    encoded = model.stages[0].transform(rows)
    for stage_ in model.stages[1 : model.stages.index(forest)]:
        encoded = stage_.transform(encoded)
    for i, tree in enumerate(trees):
        encoded = tree.setPredictionCol(f"t{i}").transform(encoded)
    alone = encoded.select(S.ID, *[f"t{i}" for i in range(8)]).orderBy(S.ID).toPandas().set_index(S.ID)
    np.testing.assert_allclose(found.p, alone.mean(axis=1), rtol=1e-9)
    assert alone.T.drop_duplicates().shape[0] == 8
    save_model(model, f"{tmp_path}/forest")
    again = predict(load_model(f"{tmp_path}/forest"), rows).select(S.ID, F.log1p("pred_price").alias("p")).orderBy(S.ID).toPandas()
    np.testing.assert_allclose(again.p, found.p, rtol=1e-12)
    sums = X.explain_trees(model, rows, S.ID).groupBy(S.ID).agg((F.sum("contribution") + F.first("base_value")).alias("e")).orderBy(S.ID).toPandas()
    np.testing.assert_allclose(sums.e, found.p, rtol=1e-9)


def test_boosted_fits_read_the_encoded_rows_from_a_table(train, monkeypatch):
    staged = []
    monkeypatch.setattr(models, "stage", lambda df: staged.append(df.columns) or stage(df))
    fit(train, "boosted", **SMALL["boosted"])
    assert staged == [["features", E.LABEL]]
