"""Profiles, associations and chart data on small tables against pandas and NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotwise.operators import association as A
from lotwise.operators import chartdata as D
from lotwise.operators import market as K
from lotwise.operators import profile as P


@pytest.fixture(scope="module")
def mixed():
    rng = np.random.default_rng(5)
    n = 800
    hot = rng.random(n) < 0.4
    frame = pd.DataFrame(
        {
            "a": np.where(hot, "hot", rng.choice(list("pqrstu"), n)),
            "b": rng.choice(["x", "y", "z"], n),
            "v": rng.lognormal(3, 1, n),
            "w": rng.integers(0, 20, n).astype(float),
        }
    )
    frame["v"] = frame["v"] + (frame["a"] == "hot") * 20
    frame.loc[frame.sample(40, random_state=1).index, "a"] = None
    frame.loc[frame.sample(40, random_state=2).index, "w"] = np.nan
    return frame


def _cramers(x, y):
    table = pd.crosstab(x, y).to_numpy(dtype=float)
    n = table.sum()
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    phi2 = ((table - expected) ** 2 / expected).sum() / n
    r, k = table.shape
    phi2 = max(0, phi2 - (k - 1) * (r - 1) / (n - 1))
    rc, kc = r - (r - 1) ** 2 / (n - 1), k - (k - 1) ** 2 / (n - 1)
    return np.sqrt(phi2 / min(kc - 1, rc - 1)) if min(kc - 1, rc - 1) > 0 else None


def _ratio(c, v):
    d = pd.DataFrame({"c": c, "v": v}).dropna()
    grand = d.v.mean()
    means = d.groupby("c").v.transform("mean")
    return np.sqrt(((means - grand) ** 2).sum() / ((d.v - grand) ** 2).sum())


def test_association_matrix(spark, mixed):
    matrix = A.association_matrix(spark.createDataFrame(mixed)).toPandas().set_index(["col_i", "col_j"])
    value = matrix["value"]
    assert len(matrix) == 16
    for i, j in matrix.index:
        assert value[i, j] == value[j, i]
    assert all(value[c, c] == 1 for c in "abvw")
    assert value["a", "b"] == pytest.approx(_cramers(mixed.a, mixed.b))
    assert value["v", "w"] == pytest.approx(mixed.v.corr(mixed.w))
    for c in "ab":
        for v in "vw":
            assert value[c, v] == pytest.approx(_ratio(mixed[c], mixed[v]))
    wide = A.association_wide(A.association_matrix(spark.createDataFrame(mixed)), list("abvw"))
    assert wide.columns == ["col_i", "a", "b", "v", "w"] and wide.count() == 4


def test_association_of_constants_is_null(spark):
    df = spark.createDataFrame([("k", "x", 1.0, 2.0), ("k", "y", 1.0, 3.0), ("k", "y", 1.0, 9.0)], "a string, b string, v double, w double")
    assert A.cramers_v(df, [("a", "b")]).first()["value"] is None
    assert A.correlation_ratio(df, [("b", "v")]).first()["value"] is None
    assert A.pearson_pair(df, "v", "w").first()["r"] is None


def test_corr_matrix_matches_pandas(spark, mixed):
    found = A.corr_matrix(spark.createDataFrame(mixed)).toPandas().pivot(index="col_i", columns="col_j", values="r")
    np.testing.assert_allclose(found.to_numpy(), mixed[["v", "w"]].corr().to_numpy(), rtol=1e-10)


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "x string, y double")
    assert P.duplicate_count(df).first()[0] == 1
    assert tuple(P.profile_summary(df).first()) == (3, 2, 1, 2)
    assert tuple(P.profile_summary(df.limit(0)).first()) == (0, 2, 0, 0)


def test_skew_matches_pandas(spark, mixed):
    df = spark.createDataFrame(mixed.assign(k=2.0))
    found = P.skew_report(df).toPandas().set_index("column")
    for c in ("v", "w", "k"):
        series = mixed.assign(k=2.0)[c]
        assert found.loc[c, "skew_raw"] == pytest.approx(series.skew())
        assert found.loc[c, "skew_log1p"] == pytest.approx(np.log1p(series).skew())
    assert P.skew_report(df.limit(2), ["v"]).first()["skew_raw"] is None


def test_describe_matches_pandas(spark, mixed):
    ours = P.describe_all(spark.createDataFrame(mixed)).toPandas().set_index("stat")
    theirs = mixed.describe(include="all")
    for stat in ("mean", "std", "min", "25%", "50%", "75%", "max", "count"):
        for c in "vw":
            assert ours.loc[stat, c] == pytest.approx(theirs.loc[stat, c])
    assert ours.loc["top", "a"] == "hot" and int(ours.loc["freq", "a"]) == theirs.loc["freq", "a"]
    assert int(ours.loc["unique", "b"]) == 3 and ours.loc["mean", "a"] is None


def test_outliers_and_rare_categories(spark):
    df = spark.createDataFrame([(float(v), f"c{v % 60}") for v in range(100)] + [(1e6, "c0"), (None, "c1")], "v double, c string")
    row = P.iqr_outlier_count(df).first()
    assert (row["outliers"], row["pct"]) == (1, pytest.approx(100 / 102))
    rare = P.rare_category_pct(df).first()
    assert rare["n_unique"] == 60 and rare["rare_pct"] == 100.0
    assert P.rare_category_pct(df, many=60).count() == 0


def test_top_values_prune_before_the_shuffle(spark, mixed):
    top = P.top_k_values(spark.createDataFrame(mixed), k=2)
    assert {(r["column"], r["rank"]) for r in top.collect()} == {("a", 1), ("a", 2), ("b", 1), ("b", 2)}
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_fd_check(spark):
    df = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", "X"), ("c", None)], "Area string, State string")
    assert tuple(P.fd_check(df).first()) == (2, False)


@pytest.mark.parametrize("log", [False, True])
def test_histogram_counts(spark, mixed, log):
    found = D.histogram(spark.createDataFrame(mixed), "v", 30, log).orderBy("bin").toPandas()
    values = np.log1p(mixed.v) if log else mixed.v
    counts, edges = np.histogram(values, bins=30)
    assert found.n.tolist() == counts.tolist()
    np.testing.assert_allclose(found.low, edges[:-1], rtol=1e-9)


def test_histogram_of_a_constant_and_of_nothing(spark):
    one = D.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).orderBy("bin").toPandas()
    assert one.n.tolist() == [0, 0, 2, 0] and one.low[0] == 1.5
    assert D.histogram(spark.createDataFrame([(None,)], "v double"), "v").count() == 0


def test_kde_matches_the_definition(spark, mixed):
    found = D.kde_curve(spark.createDataFrame(mixed), "v").orderBy("point").toPandas()
    v = mixed.v.to_numpy()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    density = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(found.x, x, rtol=1e-9)
    np.testing.assert_allclose(found.density, density, rtol=1e-9, atol=1e-300)


def test_kde_skips_distant_points(spark):
    values = np.concatenate([np.random.default_rng(0).normal(0, 1e-3, 5000), [1.0]])
    found = D.kde_curve(spark.createDataFrame(pd.DataFrame({"v": values})), "v").orderBy("point").toPandas()
    h = values.std(ddof=1) * len(values) ** -0.2
    density = np.exp(-0.5 * ((found.x.to_numpy()[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(found.density, density, rtol=1e-9, atol=1e-300)


def test_views_share_two_scans(spark, mixed):
    """Bins and curves of raw, log, integer, constant and empty views, together as one at a time."""
    table = spark.createDataFrame(mixed).select("v", F.lit(3.0).alias("same"), F.lit(None).cast("double").alias("none"), F.expr("int(v)").alias("i"))
    views = [D.View("raw", "v"), D.View("log", "v", 40, True), D.View("i", "i", 7), D.View("same", "same", 4), D.View("none", "none")]
    bins, curves = D.histograms_and_curves(table, views)
    assert {r["chart"] for r in bins.select("chart").distinct().collect()} == {"raw", "log", "i", "same"}
    assert {r["chart"] for r in curves.select("chart").distinct().collect()} == {"raw", "log", "i"}
    for v in views:
        alone = D.histogram(table, v.column, v.bins, v.log).orderBy("bin").toPandas()
        pd.testing.assert_frame_equal(bins.where(F.col("chart") == v.name).drop("chart").orderBy("bin").toPandas(), alone)
        curve = D.kde_curve(table, v.column, v.bins, v.log).orderBy("point").toPandas()
        together = curves.where(F.col("chart") == v.name).drop("chart").orderBy("point").toPandas()
        pd.testing.assert_frame_equal(together, curve)
    with pytest.raises(ValueError):
        D.view_extents(table, [D.View("raw", "v"), D.View("raw", "i")])


def test_all_views_read_the_table_once_after_the_extents(spark, mixed, tmp_path):
    spark.createDataFrame(mixed).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    views = [D.View("raw", "v"), D.View("log", "v", 40, True)]
    extents = D.view_extents(table, views)
    for made in (D.histograms(table, views, extents), D.kde_curves(table, views, extents)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") == 1


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 30.0]
    row = D.box_stats(spark.createDataFrame([(v,) for v in values], "v double")).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)


def test_ordered_index_with_a_hot_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.rand(3) * 20).alias("v"), "id")
    found = D.ordered_index(df, ["v", "id"]).toPandas().sort_values("index")
    assert found["index"].tolist() == list(range(5000))
    expected = found.sort_values(["v", "id"])
    assert expected["id"].tolist() == found["id"].tolist()


def test_market_tables(spark):
    rows = [("S", "a", 1.0, 10.0), ("S", "a", 3.0, None), ("S", "b", 2.0, 5.0), (None, "a", 9.0, 5.0)]
    df = spark.createDataFrame(rows, "State string, Area string, Median_Price double, Transactions double")
    assert [tuple(r) for r in K.group_median_topk(df).collect()] == [("S", 2.0)]
    lookup = {r.Area: (r.Transactions, r.Area_Transaction_Density) for r in K.lookup_table(df).collect()}
    assert lookup == {"a": (10.0, 0.5), "b": (5.0, 0.25)}
    nothing = K.lookup_table(df.withColumn("Transactions", F.lit(None).cast("double"))).first()
    assert (nothing["Transactions"], nothing["Area_Transaction_Density"]) == (16.0, 0.005)
    typed = df.withColumnRenamed("Area", "Type")
    bench = K.market_benchmark(typed, "S", "b", 7.0).collect()
    assert [tuple(r) for r in bench] == [("a", 2.0, None), ("b", 2.0, 7.0)]
    assert K.market_benchmark(typed, "nowhere").count() == 0
    assert {r.Area: r.group_total for r in K.group_total(df).collect()} == {"a": 15.0, "b": 5.0}
