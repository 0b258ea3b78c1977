"""Ordered levels, block elimination, the insensitive loss, sparse slot scores and the resumable search."""

import json
import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.ml import features as E
from lotwise.ml import leastsquares as L
from lotwise.ml import search
from lotwise.ml.kernel import RandomFourierFeatures, scale_gamma
from lotwise.ml.levels import Levels
from lotwise.ml.models import fit, fit_inputs, load_model, predict, save_model
from lotwise.plans import scoring as P
from lotwise.sources.staging import stage, staging_path
from tests.test_ml import SMALL, signal, train  # noqa: F401


def test_levels_follow_the_mean_label(spark):
    rows = [("b", 1.0), ("b", 3.0), ("a", 5.0), ("c", 2.0), (None, 9.0), ("d", 2.0)]
    df = stage(spark.createDataFrame(rows, f"Area string, {E.LABEL} double"))
    model = Levels(inputCols=["Area"]).fit(df)
    table = {r["value"]: (r["place"], r["n"], r["mean"]) for r in model.table().collect()}
    assert table == {"b": (0.0, 2, 2.0), "c": (1.0, 1, 2.0), "d": (2.0, 1, 2.0), "a": (3.0, 1, 5.0)}
    found = model.transform(spark.createDataFrame([("a",), ("new",), (None,)], "Area string")).collect()
    # The mean of the rows with a level is 2.6: three levels lie below it.
    assert {r["Area"]: r["_index_Area"] for r in found} == {"a": 3.0, "new": 3.0, None: 3.0}
    named = Levels(inputCols=["Area"], by="name").fit(df)
    assert {r["value"]: r["place"] for r in named.table().collect()} == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}
    assert named.transform(spark.createDataFrame([("zz",)], "Area string")).first()["_index_Area"] == 4.0


def test_levels_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], f"Area string, {E.LABEL} double")
    for by in ("label", "name"):
        assert Levels(inputCols=["Area"], by=by).fit(df).transform(df).first()["_index_Area"] == 0.0


def test_a_hundred_thousand_areas(spark, tmp_path):
    """No list of levels reaches the driver, the bins stay fixed and the model is saved with its table."""
    n = 300_000
    area = (F.col("id") % 100_000).cast("long")
    effect = F.sin(area.cast("double"))
    df = spark.range(n).select(
        F.col("id").alias(S.ID), F.concat(F.lit("area "), area.cast("string")).alias("Area"),
        F.lit("s").alias("State"), F.lit("t").alias("Tenure"),
        (F.col("id") % 17).cast("double").alias(S.TX), F.rand(3).alias(S.LOG_SIZE), F.rand(4).alias(S.DENSITY),
        F.lit(1).alias("Type_A"), F.expm1(8 + effect).alias(S.TARGET),
    )
    df = stage(df)
    encoder, derived = fit_inputs(df, "boosted")
    assert derived == {"maxBins": 32} and not any(hasattr(s, "labelsArray") for s in encoder.stages)
    model = fit(df, "boosted", maxIter=3, maxDepth=5, stepSize=1.0)
    save_model(model, str(tmp_path / "m"))
    again = predict(load_model(str(tmp_path / "m")), df)
    left = again.agg((F.sum((F.log1p(S.TARGET) - F.log1p("pred_price")) ** 2) / (F.var_pop(F.log1p(S.TARGET)) * n)).alias("r")).first()["r"]
    assert left < 0.02
    line = fit(df, "linear")
    exact = predict(line, df).agg(F.max(F.abs(F.log1p(S.TARGET) - F.log1p("pred_price")))).first()[0]
    assert exact < 1e-6
    known = E.known_categories(line, spark)
    assert known.where("column = 'Area'").count() == 100_000
    requests = spark.createDataFrame([(1, "area 7", "s"), (2, "nowhere", "s")], "request_id long, Area string, State string")
    seen, unseen = P.known_unknown_split(requests, known)
    assert [r["request_id"] for r in seen.collect()] == [1] and [r["request_id"] for r in unseen.collect()] == [2]


def _dense(frame, train_frame):
    columns = [frame[c].to_numpy(float) for c in (S.TX, S.LOG_SIZE, S.DENSITY, "Type_Flat", "Type_Semi D")]
    for c in ("Area", "State", "Tenure"):
        columns += [(frame[c] == v).to_numpy(float) for v in sorted(train_frame[c].unique())]
    return np.column_stack([*columns, np.ones(len(frame))])


def test_linear_equals_dense_least_squares(signal, train):  # noqa: F811
    frame, known = signal.toPandas(), train.toPandas()
    weights = np.linalg.lstsq(_dense(known, known), np.log1p(known[S.TARGET]), rcond=None)[0]
    expected = dict(zip(frame[S.ID], _dense(frame, known) @ weights))
    model = fit(train, "linear")
    assert model.stages[0].losses[1] < model.stages[0].losses[0]
    found = {r[S.ID]: math.log1p(r["pred_price"]) for r in predict(model, signal).collect()}
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(v, abs=1e-7) for k, v in expected.items())


def test_linear_of_unseen_null_and_constant_values(spark, train):  # noqa: F811
    model = fit(train.withColumn(S.TX, F.lit(3.0)), "linear")
    row = train.limit(1).withColumns({"Area": F.lit(None).cast("string"), "State": F.lit("nowhere"), S.LOG_SIZE: F.lit(None).cast("double")})
    assert predict(model, row).first()["pred_price"] > 0
    only = fit(train.drop("Type_Flat", "Type_Semi D"), "linear", features=E.FeatureSet(("Area",), ()))
    means = {r["Area"]: r["m"] for r in train.groupBy("Area").agg(F.avg(F.log1p(S.TARGET)).alias("m")).collect()}
    for r in predict(only, train).select("Area", "pred_price").distinct().collect():
        assert math.log1p(r["pred_price"]) == pytest.approx(means[r["Area"]])
    with pytest.raises(ValueError, match="no rows"):
        fit(train.limit(0), "linear")


def _rows(spark, x, y, level=None):
    frame = pd.DataFrame({"x": [list(map(float, r)) for r in x], "y": y, "level": level if level is not None else [None] * len(y)})
    return stage(spark.createDataFrame(frame, "x array<double>, y double, level string"))


def test_insensitive_loss_falls_and_ends_at_its_minimum(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 3))])
    y = x @ [1.0, 2.0, -1.0, 0.5] + rng.standard_t(2, 400) * 0.3
    found = L.solve(_rows(spark, x, y), ridge=0.5, epsilon=0.2, steps=200, tolerance=1e-7, unpenalised=[0])
    assert all(b <= a for a, b in zip(found.losses, found.losses[1:])) and len(found.losses) > 5

    def objective(w):
        return np.maximum(np.abs(y - x @ w) - 0.2, 0).sum() + 0.25 * (w[1:] ** 2).sum()

    best = found.weights + [found.constant, 0, 0, 0]
    assert objective(best) == pytest.approx(found.losses[-1], rel=1e-6)
    for _ in range(300):
        assert objective(best + rng.normal(size=4) * 0.02) > objective(best) - 1e-3 * found.losses[-1]


def test_levels_with_a_ridge_equal_dense_ridge(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 2))])
    level = rng.integers(0, 7, 300)
    y = x @ [3.0, 1.0, -2.0] + level * 0.4 + rng.normal(size=300)
    found = L.solve(_rows(spark, x, y, [f"l{v}" for v in level]), ridge=2.0, unpenalised=[0])
    full = np.column_stack([x, np.eye(7)[level]])
    expected = np.linalg.solve(full.T @ full + 2.0 * np.diag([0, *[1] * 9]), full.T @ y)
    assert found.weights == pytest.approx(expected[:3])
    effects = {r["level"]: r["effect"] for r in found.effects.collect()}
    assert [effects[f"l{k}"] for k in range(7)] == pytest.approx(expected[3:].tolist())


def test_epsilon_is_the_half_width_of_the_tube(train):  # noqa: F811
    wide = fit(train, "svr", C=10.0, epsilon=100.0, gamma=0.05)
    prices = {round(r["pred_price"], 3) for r in predict(wide, train).collect()}
    assert len(prices) == 1  # no error leaves the tube


def test_sparse_slots(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 12)) * (rng.random((200, 12)) < 0.3)
    x[:, 5] = 0
    y = x[:, 2] + 0.5 * x[:, 9] + rng.normal(size=200) * 0.1
    rows = [(Vectors.sparse(12, {i: float(v) for i, v in enumerate(r) if v}) if k % 2 else Vectors.dense(r), float(t)) for k, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["features", E.LABEL])
    expected = [np.corrcoef(x[:, i], y)[0, 1] ** 2 if i != 5 else -1 for i in range(12)]
    assert E.f_scores(df, "features", E.LABEL) == pytest.approx(expected)
    order = sorted((i for i in range(12) if i != 5), key=lambda i: -expected[i])
    for k in (1, 4, 11):
        assert E.select_k_best(k).fit(df).getIndices() == sorted(order[:k])
    assert E.select_k_best(12).fit(df).getIndices() == list(range(12))


SPACE = {"maxIter": [2, 4, 6], "maxDepth": [2, 3], "stepSize": [0.3]}


def test_a_stopped_search_goes_on(spark, train):  # noqa: F811
    path, fits = staging_path(spark), []

    def counted(kind, params, rows, stop_after=None):
        if stop_after is not None and len(fits) >= stop_after:
            raise RuntimeError("stopped")
        fits.append(json.dumps({k: v for k, v in params.items() if k in SPACE}))
        return search.fit_encoded(kind, params, rows)

    options = {"candidates": 6, "space": SPACE, "folds": 2, "scores_path": path, "parallelism": 1}
    with pytest.raises(RuntimeError, match="stopped"):
        search.randomized_search(train, "boosted", fit=lambda k, p, r: counted(k, p, r, 3), **options)
    kept = search.read_scores(spark, path).collect()
    assert len(kept) == 9 and len(fits) == 3
    _, report = search.randomized_search(train, "boosted", fit=counted, **options)
    # Two depths and two folds make four fits; the last one found the best model again.
    assert len(fits) == 3 + 1 + 1
    scores = search.read_scores(spark, path).collect()
    assert len(scores) == 12 and all(r["seconds"] > 0 for r in scores)
    alone, plain = search.randomized_search(train, "boosted", candidates=6, space=SPACE, folds=2)
    assert {tuple(r) for r in report.collect()} == {tuple(r) for r in plain.collect()}
    other = train.withColumn(S.TARGET, F.col(S.TARGET) * 2)
    fits.clear()
    search.randomized_search(other, "boosted", fit=counted, **options)
    assert len(fits) == 5  # other rows have other scores


def test_rounds_share_a_fit(train):  # noqa: F811
    encoder, derived = fit_inputs(train, "boosted")
    rows = stage(encoder.transform(E.with_label(train)).withColumn("price", F.col(S.TARGET)))
    point = {"maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.7", **derived}
    long = search.fit_encoded("boosted", {**point, "maxIter": 30}, rows)
    scored, names = search.rounds_predictions(long, rows, [5, 26, 30])
    assert names == ["_after_5", "_after_26", "_after_30"]
    found = scored.select(S.ID, *names).toPandas().set_index(S.ID).sort_index()
    for rounds, name in zip((5, 26, 30), names):
        short = search.fit_encoded("boosted", {**point, "maxIter": rounds}, rows)
        expected = short.transform(rows).select(S.ID, "prediction").toPandas().set_index(S.ID).sort_index()
        np.testing.assert_allclose(found[name], expected["prediction"], rtol=1e-9)


def test_svr_search_covers_raw_and_encoded_candidates(train):  # noqa: F811
    space = {"kernel": ["rbf", "linear"], "C": [5], "epsilon": [0.1], "gamma": [0.05], "k": [15, "all"]}
    model, report = search.randomized_search(train, "svr", candidates=4, space=space, folds=2)
    rows = report.collect()
    assert len(rows) == 4 and all(r["mean_r2"] > 0.2 for r in rows)
    assert predict(model, train).where("pred_price > 0").count() == train.count()


def test_a_limit_on_steps_leaves_exact_least_squares_as_it_is(train):  # noqa: F811
    found = [predict(fit(train, "linear", **more), train).agg(F.sum("pred_price")).first()[0] for more in ({}, {"maxIter": 30})]
    assert found[1] == pytest.approx(found[0], rel=1e-12)
    steps = [len(fit(train, "svr", C=10.0, epsilon=0.05, maxIter=n).stages[0].losses) for n in (1, 60)]
    assert steps[0] == 2 < steps[1]


def test_a_projection_makes_the_weights_of_the_slots_it_meets_only(spark):
    wide, gamma = 500_000_000, 0.1  # a matrix of all weights would have 2 * 10^12 numbers
    slots = [{1: 1.0, 499_999_999: 2.0}, {1: 1.5, 7: -1.0}, {}]
    rows = spark.createDataFrame([(i, Vectors.sparse(wide, s)) for i, s in enumerate(slots)], ["id", "features"])
    found = RandomFourierFeatures(gamma=gamma, components=4096).transform(rows).select("id", vector_to_array("fourier")).collect()
    points = np.array([r[1] for r in sorted(found)])
    for i, j in ((0, 0), (0, 1), (0, 2), (1, 2)):
        distance = sum((slots[i].get(k, 0.0) - slots[j].get(k, 0.0)) ** 2 for k in {*slots[i], *slots[j]})
        assert points[i] @ points[j] == pytest.approx(math.exp(-gamma * distance), abs=0.06)


def test_the_width_of_the_kernel_of_sparse_and_dense_vectors(spark):
    dense = np.array([[1.0, 0.0, 3.0], [0.0, 0.0, -2.0], [0.5, 4.0, 0.0]])
    sparse = [Vectors.sparse(3, {i: float(v) for i, v in enumerate(row) if v}) for row in dense]
    for vectors in ([Vectors.dense(row) for row in dense], sparse):
        frame = spark.createDataFrame([(v,) for v in vectors], ["features"])
        assert scale_gamma(frame) == pytest.approx(1 / (3 * dense.var()))


def test_threads_without_an_active_session_read_the_table_of_a_model(spark, train, monkeypatch):  # noqa: F811
    model = fit(train, "linear")
    # What a thread of a search may see.
    monkeypatch.setattr("lotwise.ml.tables.SparkSession.getActiveSession", lambda: None)
    with ThreadPool(2) as pool:
        counts = pool.map(lambda _: model.transform(train).where("prediction IS NOT NULL").count(), range(2))
    assert counts == [train.count()] * 2


def test_slot_scores_compute_the_vectors_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(y):
        seen.add(1)
        return y

    rows = [(Vectors.sparse(3, {0: 1.0, 2: 2.0}), 1.0), (Vectors.dense([0.0, 1.0, 5.0]), 3.0), (Vectors.sparse(3, {2: 4.0}), 2.5)]
    df = spark.createDataFrame(rows, ["features", "y"]).withColumn("y", F.udf(read, "double")("y"))
    scores, width = E.slot_scores(df, "features", "y")
    found = {r["slot"]: r["score"] for r in scores.collect()}
    assert seen.value == len(rows) and width == 3
    x, y = np.array([[1, 0, 2], [0, 1, 5], [0, 0, 4]], float), np.array([1.0, 3.0, 2.5])
    assert found == pytest.approx({i: np.corrcoef(x[:, i], y)[0, 1] ** 2 for i in range(3)})
