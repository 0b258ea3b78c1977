"""The exact quantiles against pandas."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.functions.numeric import log_cell
from lotwise.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _check(spark, frame):
    df = spark.createDataFrame(frame)
    found = Q.exact_quantiles(df, ["v"], PROBS, by=["g"]).toPandas().set_index("g")
    groups = frame.dropna(subset=["v"]).groupby("g").v
    expected = groups.quantile(PROBS).unstack()
    assert sorted(found.index) == sorted(expected.index)
    for g in expected.index:
        np.testing.assert_allclose(found.loc[g, "q"], expected.loc[g].to_numpy(), rtol=1e-12, atol=1e-300)
        assert found.loc[g, "n"] == groups.count()[g]


def _frame():
    rng = np.random.default_rng(7)
    parts = {
        "hot": rng.normal(1e6, 0.5, 6000),  # close values: needs the fine grid
        "tiny": rng.normal(0, 1e-9, 500),
        "wide": rng.lognormal(0, 30, 500),
        "ties": rng.integers(0, 4, 700).astype(float),
        "same": np.full(300, 3.25),
        "one": np.array([-5.5]),
        "two": np.array([1.0, 2.0]),
        "negative": -rng.lognormal(3, 1, 400),
    }
    frame = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in parts.items()])
    missing = pd.DataFrame({"g": ["hot", "none"], "v": [np.nan, np.nan]})
    return pd.concat([frame, missing]).sample(frac=1, random_state=1)


def test_quantiles_of_groups(spark):
    _check(spark, _frame())


def test_dense_values_reach_the_last_level(spark):
    # 4,000 values inside one fine cell of a coarse cell that also has a distant value.
    close = 1e6 + np.arange(4000) * 1e-7
    frame = pd.DataFrame({"g": "a", "v": np.concatenate([close, [1e6 + 400.0, 1e6 - 100.0]])})
    _check(spark, frame)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=60))
def test_counting_route_on_any_values(spark, values):
    _check(spark, pd.DataFrame({"g": "a", "v": values}))


def test_cells_keep_the_order(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate(
        [rng.normal(0, 1, 500), rng.lognormal(0, 200, 500), [0.0, 5e-324, -5e-324, 1.7e308, float("inf"), float("-inf")]]
    )
    df = spark.createDataFrame(pd.DataFrame({"v": values})).select("v", log_cell(F.col("v")).alias("c"))
    assert df.toPandas().sort_values("v").c.is_monotonic_increasing


def test_values_for_whole_columns_skip_empty_ones(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert Q.quantile_values(df, ["a", "b"], [0.5]) == {"a": [2.0]}


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("v"))
    found = Q.quantile_values(df, ["v"], [0.25, 0.5], approx=True)["v"]
    assert abs(found[0] - 2500) <= 2 and abs(found[1] - 5000) <= 2


def test_order_statistics_of_a_large_group_use_many_tasks(spark):
    """The shuffle keys of the counting pass contain the cell, not the group alone."""
    group = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(1000).select(group.alias("g"), F.rand(1).alias("value"), F.lit(1).alias("_n"))
    plan = Q._count_cells(df, ["g"], log_cell(F.col("value")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "hashpartitioning(" in line]
    # The lowest exchange carries the partial counts.
    assert "_cell" in exchanges[-1].split("hashpartitioning(")[1]
