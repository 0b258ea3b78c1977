"""Readers, writers, staged tables and result stores."""

import pytest
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.sources import results as R
from lotwise.sources import staging
from lotwise.sources.listings import nan_to_null, path_exists, read_clean, read_raw, with_listing_id, write_clean


def _metrics(spark, model, value):
    return spark.createDataFrame([(model, value)], "model string, test_r2 double")


def test_metrics_upsert(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert R.read_metrics(spark, path).count() == 0
    R.metrics_upsert(_metrics(spark, "Random Forest", 0.5), path)
    R.metrics_upsert(_metrics(spark, "XGBoost", 0.6), path)
    R.metrics_upsert(_metrics(spark, "Random Forest", 0.7), path)
    found = {r["model"]: (r["test_r2"], r["train_r2"]) for r in R.read_metrics(spark, path).collect()}
    assert found == {"Random Forest": (0.7, None), "XGBoost": (0.6, None)}


def test_lookup_json_round_trip(spark, tmp_path):
    path = str(tmp_path / "lookup")
    assert R.read_lookup_json(spark, path).count() == 0
    rows = [("Kuala Lumpur", "Mont Kiara", 45.0, 0.25), ("Johor", "Sku/dai", 1.0, 0.75)]
    R.write_lookup_json(spark.createDataFrame(rows, S.LOOKUP), path)
    assert sorted(map(tuple, R.read_lookup_json(spark, path).collect())) == sorted(rows)


def test_csv_round_trip_keeps_text(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(1, ' lot "1", a', "x", "S", " leasehold,  freehold", "a, b", 1.5, 0.1, None)]
    write_clean(spark.createDataFrame(rows, S.RAW), path, "csv")
    assert [tuple(r) for r in read_raw(spark, path).collect()] == rows


def test_missing_files_are_named(spark):
    for read in (read_raw, read_clean):
        with pytest.raises(FileNotFoundError, match="/no/such/table"):
            read(spark, "/no/such/table")


def test_header_must_match_the_schema(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        read_raw(spark, str(path)).collect()


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "v double, t string"))
    assert [tuple(r) for r in df.collect()] == [(None, "x"), (1.0, None)]


def test_listing_id_is_fixed(spark):
    df = with_listing_id(spark.range(50).select(F.rand().alias("v")))
    first = {r[S.ID]: r["v"] for r in df.collect()}
    assert first == {r[S.ID]: r["v"] for r in df.collect()} and len(first) == 50


def test_staged_tables_live_in_the_configured_folder_and_go(spark):
    df = staging.stage(spark.range(3))
    path = df.inputFiles()[0]
    assert staging.staging_root(spark) in path
    assert path_exists(spark, path)
    staged = list(staging._staged)
    # Only the table of this test: the others still serve cached inputs.
    staging._staged[:] = staged[-1:]
    staging.drop_staged(spark)
    staging._staged[:] = staged[:-1]
    assert not path_exists(spark, path)


def test_a_staged_lookup_is_broadcast_by_its_size(spark):
    small = staging.stage(spark.range(10).withColumn("x", F.lit(1)))
    plan = spark.range(100).join(small, "id", "left")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = spark.range(100).join(small, "id", "left")
        assert "SortMergeJoin" in plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_row_keys_follow_from_the_content(spark, monkeypatch):
    monkeypatch.setattr("lotwise.sources.listings._EQUAL", 3)
    rows = [("a", None), (None, "a"), ("b", "c"), *[("b", "d")] * 8]
    df = spark.createDataFrame(rows, "Area string, State string")
    first = sorted(tuple(r) for r in with_listing_id(df).collect())
    again = sorted(tuple(r) for r in with_listing_id(df.repartition(5)).collect())
    assert first == again and len({r[0] for r in first}) == len(rows)
    assert sorted(map(repr, (r[1:] for r in first))) == sorted(map(repr, rows))
