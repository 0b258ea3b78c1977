"""Every named query against its SQL, and the entry points."""

import pytest

import __spark_entry__ as entry_points
from lotwise.catalog import all_queries, all_sql, common
from lotwise.catalog.learning import POINTS
from lotwise.ml.models import fit
from lotwise.ml.search import SEARCH_SPACES
from lotwise.sources.staging import small_table
from tests.compare import differences

QUERIES, SQL = all_queries(), all_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, folder, name):
    assert not differences(QUERIES[name](spark, folder), duck.execute(SQL[name]).df())


#: These run the whole published search, which takes hours; their rows are tested with a search that is handed in.
SEARCHES = {"randomized_search", "best_params_report"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SEARCHES))
def test_query_without_sql_has_rows(spark, folder, name):
    result = QUERIES[name](spark, folder)
    assert result.columns and result.count() > 0


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    top = entry_points.entry(spark)
    assert top.columns == ["State", "median"]
    assert top.count() == 10


def test_queries_run_the_search_of_the_library(spark, folder, monkeypatch):
    """All three kinds, with no other space, candidates or folds, and with a table of scores to go on from."""
    calls = []

    def searched(train, kind, **options):
        calls.append((kind, sorted(options)))
        rows = [(0, f"{kind} 0", 0.25, False), (1, f"{kind} 1", 0.5, True)]
        return fit(train, "linear"), small_table(spark, rows, "candidate int, params string, mean_r2 double, is_best boolean")

    monkeypatch.setattr("lotwise.plans.training.randomized_search", searched)
    monkeypatch.setattr(common, "_memo", dict(common._memo))
    found = {(r["kind"], r["params"], r["is_best"]) for r in QUERIES["randomized_search"](spark, folder).collect()}
    assert found == {(k, f"{k} {i}", i == 1) for k in ("forest", "boosted", "svr") for i in (0, 1)}
    best = QUERIES["best_params_report"](spark, folder).collect()
    assert {(r["kind"], r["params"]) for r in best} == {(k, f"{k} 1") for k in ("forest", "boosted", "svr")}
    assert calls == [(k, ["scores_path"]) for k in ("forest", "boosted", "svr")]


@pytest.mark.parametrize("kind", ["forest", "boosted", "svr"])
def test_fitted_points_are_published_ones(kind):
    assert all(POINTS[kind][name] in values for name, values in SEARCH_SPACES[kind].items())
    assert set(POINTS[kind]) == set(SEARCH_SPACES[kind])


def test_fit_linear_reads_the_train_rows_once(spark, folder, capsys):
    """Slopes follow from the predicted rows themselves, without a join of the train rows with a copy of theirs."""
    QUERIES["fit_linear"](spark, folder).explain()
    plan = capsys.readouterr().out
    assert "Join" in plan  # the effects of the levels
    assert not [line for line in plan.splitlines() if "Join" in line and "listing_id" in line]
