"""Requests: fallback, fill rules, notes, predictions."""

import math

import pytest
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog import all_queries, learning
from lotwise.ml import forest as R
from lotwise.ml.models import MODEL_NAMES, fit
from lotwise.operators.encoding import TYPE_NAMES
from lotwise.plans import scoring as P
from tests.test_ml import SMALL, signal, train  # noqa: F401

# The sample requests.
SAMPLES = [
    (1, "", "Selangor", "Freehold", "Terrace House", 1200.0, 16.0),
    (2, "Mont Kiara", "Kuala Lumpur", "Freehold", "Condominium", 1450.0, 45.0),
    (3, "Skudai", "Johor", "Freehold", "Terrace House", 1800.0, 120.0),
    (4, "Ayer Itam", "Penang", "Leasehold", "Flat", 750.0, 35.0),
]
EXPECTED = ["Area", "State", "Tenure", S.TX, S.LOG_SIZE, S.DENSITY, *[f"Type_{t}" for t in TYPE_NAMES]]


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(SAMPLES, S.REQUEST)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("Johor", "Skudai", 30.0, 0.02), ("Johor", "Other_Johor", 1.0, 0.5)], S.LOOKUP)


@pytest.fixture(scope="module")
def known(spark):
    rows = [("Area", "Mont Kiara"), ("Area", "Other_Johor"), ("State", "Johor")]
    return spark.createDataFrame(rows, "column string, value string")


def _by_id(df, *columns):
    return {r["request_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_area_fallback(requests, known):
    found = P.category_fallback(requests, known).withColumn("note", P.fallback_note())
    assert _by_id(found, "area_used", "area_remapped") == {
        1: ("", True), 2: ("Mont Kiara", False), 3: ("Other_Johor", True), 4: ("Ayer Itam", True),
    }
    notes = _by_id(found, "note")
    assert notes[2] == (None,)
    assert notes[3][0].startswith("'Skudai' not in training data's known areas, reverted to using 'Other_Johor'")


def test_without_a_vocabulary_areas_stay(requests):
    found = P.category_fallback(requests, None)
    assert _by_id(found, "area_used", "area_remapped")[3] == ("Skudai", False)


def test_lookup_defaults_and_given_values(spark, requests, lookup):
    found = _by_id(P.lookup_join(requests, lookup), "tx_filled", "density_filled")
    assert found[3] == (120.0, 0.02) and found[2] == (45.0, 0.005)
    open_tx = requests.withColumn(S.TX, F.lit(None).cast("double"))
    found = _by_id(P.lookup_join(open_tx, lookup), "tx_filled", "density_filled")
    assert found[3] == (30.0, 0.02) and found[2] == (16.0, 0.005)


def test_filled_features(requests, lookup):
    filled = P.fill_features(requests, EXPECTED, lookup)
    row = {r["request_id"]: r for r in filled.collect()}[3]
    assert row[S.LOG_SIZE] == pytest.approx(math.log1p(1800))
    assert row["Type_Terrace House"] == 1 and row["Type_Flat"] == 0
    assert row["fill_notes"] == []
    assert set(EXPECTED) <= set(filled.columns)


def test_what_is_missing_is_zero_and_noted(requests, lookup):
    bare = requests.drop("Type", S.SIZE, "Tenure")
    row = P.fill_features(bare, ["Tenure", S.LOG_SIZE, "Type_Flat", "Distance"], lookup).first()
    assert (row["Tenure"], row[S.LOG_SIZE], row["Type_Flat"], row["Distance"]) == ("0", 0.0, 0, 0.0)
    assert [n.split("'")[1] for n in row["fill_notes"]] == ["Tenure", S.LOG_SIZE, "Type_Flat", "Distance"]


def test_low_counts_are_noted(spark, requests):
    counts = spark.createDataFrame([("Skudai", 4), ("Mont Kiara", 5)], "Area string, n long")
    found = _by_id(P.area_reliability(requests, counts), "few_note")
    assert found[3][0] == "Note: Training data only has 4 records for 'Skudai', prediction stability may be compromised."
    assert found[2] == found[1] == (None,)


def test_known_and_unknown_requests(requests, known):
    seen, unseen = P.known_unknown_split(requests, known)
    assert [r["request_id"] for r in seen.collect()] == [2]
    assert sorted(r["request_id"] for r in unseen.collect()) == [1, 3, 4]


def test_scores_of_all_models(spark, train, lookup):  # noqa: F811
    rows = [(1, "area 3", "state 0", "Freehold", "Flat", 1000.0, None), (2, "nowhere", "state 1", "Freehold", "Semi D", None, 9.0)]
    requests = spark.createDataFrame(rows, S.REQUEST)
    models = {MODEL_NAMES[k]: fit(train, k, **SMALL[k]) for k in ("linear", "boosted")}
    scored, errors = P.score_all_models({**models, "broken": None}, requests, lookup)
    assert list(errors) == ["broken"]
    assert scored.columns == [*S.REQUEST.names, "model", "pred_price", "notes"]
    assert scored.count() == 4 and scored.where("pred_price > 0").count() == 4
    both = {r["request_id"]: r for r in P.compare_scores(scored).collect()}
    assert both[1]["notes"] == []
    assert len(both[2]["notes"]) == 2 and both[2]["notes"] == sorted(both[2]["notes"])
    highest = scored.groupBy("request_id").agg(F.max("pred_price").alias("m")).collect()
    assert all(both[r["request_id"]]["axis_limit"] == pytest.approx(1.25 * r["m"]) for r in highest)


def test_lookup_on_the_original_area(spark, train):  # noqa: F811
    model = fit(train, "linear")
    lookup = spark.createDataFrame([("state 0", "far away", 77.0, 0.9)], S.LOOKUP)
    requests = spark.createDataFrame([(1, "far away", "state 0", "Freehold", "Flat", 9.0, None)], S.REQUEST)
    bucketed = train.withColumn("Area", F.when(F.col("Area") == "area 0", "Other_state 0").otherwise(F.col("Area")))
    model = fit(bucketed, "linear")
    replaced = P.prepare_requests(model, requests, lookup).first()
    assert (replaced["Area"], replaced[S.TX]) == ("Other_state 0", 16.0)
    original = P.prepare_requests(model, requests, lookup, lookup_on="original").first()
    assert (original["Area"], original[S.TX], original[S.DENSITY]) == ("Other_state 0", 77.0, 0.9)


def test_requests_are_joined_once(spark, train, tmp_path):  # noqa: F811
    """Null, unknown and repeated keys: one join of the requests, and the rows of the operators one after the other."""
    model = fit(train, "linear")
    rows = [
        (1, None, "S0", "Freehold", "Flat", 900.0, None),
        (2, "Nowhere", "S0", "Freehold", "Flat", 900.0, 7.0),
        (3, "Nowhere", None, "Freehold", "Flat", 900.0, None),
        (4, None, None, None, None, None, None),
        *[(i, "Nowhere", "S0", "Freehold", "Flat", 900.0 + i, None) for i in range(5, 40)],
    ]
    spark.createDataFrame(rows, S.REQUEST).write.parquet(str(tmp_path / "r"))
    requests = spark.read.parquet(str(tmp_path / "r"))
    lookup = spark.createDataFrame([("S0", "Nowhere", 30.0, 0.02), ("S0", "Nowhere", 31.0, 0.01)], S.LOOKUP)
    prepared = P.prepare_requests(model, requests, lookup, "original")
    plan = prepared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    known = P.known_categories(model, spark)
    resolved = P.category_fallback(requests, known).withColumn("_area_note", P.fallback_note())
    once = lookup.where("Transactions = 31")
    slow = P.fill_features(resolved, P.expected_columns(model), once, "area_used", "Area")
    columns = ["request_id", *[c for c in P.expected_columns(model)], "fill_notes"]
    key = lambda df: sorted(map(repr, df.select("request.request_id", *[f"`{c}`" for c in columns[1:]]).collect()))
    assert key(prepared) == key(slow) and prepared.count() == len(rows)
    both, errors = P.score_all_models({"a": model, "b": model}, requests, lookup, "original")
    alone = P.score(model, "a", requests, lookup, "original")
    assert not errors and both.count() == 2 * len(rows)
    assert sorted(map(repr, both.where("model = 'a'").collect())) == sorted(map(repr, alone.collect()))


def test_no_requests(spark, train, lookup):  # noqa: F811
    empty = spark.createDataFrame([], S.REQUEST)
    scored, errors = P.score_all_models({"a": fit(train, "linear")}, empty, lookup)
    assert scored.isEmpty() and not errors
    with pytest.raises(ValueError):
        P.score_all_models({}, empty, lookup)


def test_a_forest_of_many_parts_is_scored_beside_other_models(spark, train, lookup, monkeypatch):  # noqa: F811
    """The rows are written between passes, so that a pass needs the trees of some parts only; prices are those of all trees at once."""
    rows = [(1, "area 3", "state 0", "Freehold", "Flat", 1000.0, None), (2, "nowhere", "state 1", "Freehold", "Semi D", None, 9.0)]
    requests = spark.createDataFrame(rows, S.REQUEST)
    monkeypatch.setattr(R, "PART", 2)
    models = {MODEL_NAMES[k]: fit(train, k, **SMALL[k]) for k in ("linear", "forest")}
    at_once = P.score(models["Random Forest"], "Random Forest", requests, lookup).collect()
    passes, written = [], R.stage
    monkeypatch.setattr(R, "SCORED", 1)
    monkeypatch.setattr(R, "stage", lambda df: passes.append(df) or written(df))
    scored, errors = P.score_all_models(models, requests, lookup)
    assert not errors and scored.count() == 4 and len(passes) == 3  # four parts
    found = {r["request_id"]: r["pred_price"] for r in scored.where("model = 'Random Forest'").collect()}
    assert all(found[r["request_id"]] == pytest.approx(r["pred_price"]) for r in at_once) and len(found) == 2


def test_the_query_of_all_models_leaves_none_out(spark, folder, monkeypatch):
    linear = fit(learning._train(spark, folder), "linear")
    monkeypatch.setattr(learning, "_model", lambda spark, sf, kind: None if kind == "forest" else linear)
    with pytest.raises(ValueError, match="Random Forest"):
        all_queries()["score_all_models"](spark, folder)
