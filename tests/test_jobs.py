"""The command-line jobs from a CSV file to scores."""

import pytest

from lotwise import schema as S
from lotwise.__main__ import main
from lotwise.fixtures import listing_view
from lotwise.sources import staging
from lotwise.sources.listings import write_clean
from lotwise.sources.results import read_lookup_json, read_metrics


@pytest.fixture()
def own_staging(monkeypatch):
    """Jobs delete what they staged; the tables of other tests must stay."""
    monkeypatch.setattr(staging, "_staged", [])


def test_jobs(spark, folder, tmp_path, own_staging):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_clean(listing_view(spark, folder).drop(S.ID), raw, "csv")
    main(["preprocess", "--input", raw, "--format", "csv", "--output", out])
    assert spark.read.parquet(f"{out}/clean").count() > 1000
    lookup = spark.read.parquet(f"{out}/lookup")
    assert lookup.count() == read_lookup_json(spark, f"{out}/lookup_json").count() == 150

    main(["profile", "--input", raw, "--format", "csv", "--output", out])
    assert spark.read.parquet(f"{out}/describe").count() == 11
    assert spark.read.parquet(f"{out}/association").count() == 49
    assert spark.read.parquet(f"{out}/summary").first()["n_columns"] == 8

    metrics, model = str(tmp_path / "metrics"), str(tmp_path / "model")
    main(["train", "--kind", "linear", "--input", raw, "--format", "csv", "--output", model, "--metrics", metrics])
    assert read_metrics(spark, metrics).first()["model"] == "Multiple Linear Regression"
    main(["compare", "--metrics", metrics, "--output", f"{out}/comparison"])
    assert spark.read.parquet(f"{out}/comparison").first()["gap_r2"] is not None

    requests = str(tmp_path / "requests")
    spark.createDataFrame([(1, "nowhere", "Nation_3", "Freehold", "Large", 100.0, None)], S.REQUEST).write.parquet(requests)
    main(["score", "--model", model, "--input", requests, "--lookup", f"{out}/lookup", "--output", f"{out}/scores"])
    row = spark.read.parquet(f"{out}/scores").first()
    assert row["pred_price"] > 0 and row["notes"]

    boosted = str(tmp_path / "boosted")
    main(["train", "--kind", "boosted", "--no-search", "--input", raw, "--format", "csv", "--output", boosted, "--metrics", metrics])
    models = ["--model", f"line={model}", "--model", f"trees={boosted}", "--model", f"none={tmp_path}/none"]
    main(["evaluate", "--input", raw, "--format", "csv", "--output", f"{out}/evaluation", *models])
    metric_rows = {r["model"]: r["test_r2"] for r in spark.read.parquet(f"{out}/evaluation/metrics").collect()}
    assert sorted(metric_rows) == ["line", "trees"] and spark.read.parquet(f"{out}/evaluation/trends").count() > 100
    main(["score-all", "--input", requests, "--lookup", f"{out}/lookup", "--output", f"{out}/all", *models])
    assert sorted(r["model"] for r in spark.read.parquet(f"{out}/all").collect()) == ["line", "trees"]
    main(["explain", "--input", requests, "--lookup", f"{out}/lookup", "--output", f"{out}/why", *models])
    assert spark.read.parquet(f"{out}/why/trees").where("request_id = 1").count() > 0
