"""Hand-made edge cases of cleaning and encoding."""

import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions import text as X
from lotwise.operators import cleaning as C
from lotwise.operators import encoding as E
from lotwise.plans.preprocess import preprocess


def _column(df, name):
    return [r[name] for r in df.select(f"`{name}`").collect()]


def _frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize(
    "text",
    ["semi-d", "o'brien 3RD", "  taman\t mawar ", "ß straße", "ΣΟΦΟΣ ΑΣ", "a1b 2c", "x 　y\x1c", "", " ", "ªx", "Bukit (2)"],
)
def test_text_follows_python(spark, text):
    df = _frame(spark, [(text,)], "Area string")
    assert _column(C.standardize_text(df), "Area") == [re.sub(r"\s+", " ", text.strip().title())]


def test_text_of_whole_documents_follows_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text", X.standardize(F.col("text")).alias("s"))
    assert all(re.sub(r"\s+", " ", r.text.strip().title()) == r.s for r in docs.collect())


def test_null_text_stays_null(spark):
    assert _column(C.standardize_text(_frame(spark, [(None,)], "Area string")), "Area") == [None]


def test_tenure_merges_only_exact_values(spark):
    rows = [("LEASEHOLD,  FREEHOLD",), ("Freehold,Leasehold",), ("Freehold",)]
    df = C.canonicalize_tenure(C.standardize_text(_frame(spark, rows, "Tenure string")))
    assert _column(df, "Tenure") == ["Freehold and Leasehold", "Freehold,Leasehold", "Freehold"]


def test_multi_hot(spark):
    rows = [(1, "b, a"), (2, "a"), (3, ""), (4, None), (5, "a ,b")]
    df = E.multi_hot(_frame(spark, rows, "id int, Type string")).orderBy("id")
    assert df.columns == ["id", "Type_a", "Type_b"]
    assert [tuple(r)[1:] for r in df.collect()] == [(1, 1), (1, 0), (0, 0), (0, 0), (1, 1)]


def test_multi_hot_agrees_with_pandas(spark):
    values = ["Flat, Semi D", "Semi D", "Flat ,Town House", "x,,y", ","]
    ours = E.multi_hot(_frame(spark, [(v,) for v in values], "Type string")).toPandas()
    theirs = pd.Series(values).str.replace(r"\s*,\s*", ", ", regex=True).str.get_dummies(sep=", ").add_prefix("Type_")
    pd.testing.assert_frame_equal(ours.astype("int64"), theirs.astype("int64"))


def test_multi_hot_takes_any_number_of_items(spark):
    items = [f"t{i:04d}" for i in range(5200)]
    df = E.multi_hot(_frame(spark, [(", ".join(items),), ("t0001",)], "Type string"))
    assert df.columns == [f"Type_{t}" for t in items]
    assert [tuple(r) for r in df.select("Type_t0000", "Type_t0001").collect()] == [(1, 1), (0, 1)]


def test_a_caller_can_bound_the_schema(spark):
    with pytest.raises(ValueError):
        E.column_names_of(_frame(spark, [("a",), ("b",), ("c",)], "Type string"), at_most=2)


def test_nan_counts_as_null(spark):
    nan = float("nan")
    rows = [("a", 10.0, 2.0), ("a", 20.0, nan), ("b", 30.0, 6.0), ("b", nan, 4.0)]
    df = _frame(spark, rows, f"Area string, {S.TARGET} double, {S.TX} double")
    assert _column(C.impute_median(df), S.TX) == [2.0, 4.0, 6.0, 4.0]
    assert C.drop_null_target(df).count() == 3
    shares = {r["Area"]: r[S.DENSITY] for r in C.area_density(df).collect()}
    assert shares == {"a": pytest.approx(2 / 12), "b": pytest.approx(10 / 12)}


def test_multi_hot_fixed(spark):
    df = E.multi_hot_fixed(_frame(spark, [("Flat , Castle",), (None,)], "Type string"))
    assert df.columns == [f"Type_{t}" for t in E.TYPE_NAMES]
    assert _column(df, "Type_Flat") == [1, 0]
    bare = E.multi_hot_fixed(_frame(spark, [(1, 1)], "id int, Type_Flat int"))
    assert _column(bare, "Type_Flat") == [1] and _column(bare, "Type_Semi D") == [0]


def test_melt_from_flags_equals_melt_from_text(spark):
    df = _frame(spark, [(1, "b, a", 2.0), (2, "", 3.0)], "listing_id long, Type string, Median_Price double")
    a = sorted(map(tuple, E.melt_types(df).collect()))
    b = sorted(map(tuple, E.melt_types(E.multi_hot(df)).collect()))
    assert a == b == [(1, 2.0, "a"), (1, 2.0, "b")]


def test_iqr_keeps_values_on_a_fence(spark):
    # quartiles 2 and 4, fences -1 and 7
    values = [2.0, 2.0, 3.0, 4.0, 4.0, 7.0, -1.0, 7.01, None]
    quartiles = pd.Series(values).quantile([0.25, 0.75])
    lo, hi = quartiles[0.25] - 1.5 * (quartiles[0.75] - quartiles[0.25]), quartiles[0.75] + 1.5 * (quartiles[0.75] - quartiles[0.25])
    df = C.iqr_filter(_frame(spark, [(v,) for v in values], "x double"), "x")
    assert sorted(_column(df, "x")) == sorted(v for v in values if v is not None and lo <= v <= hi)
    edge = C.iqr_filter(_frame(spark, [(v,) for v in (0.0, 0.0, 1.0, 1.0, 2.5)], "x double"), "x")
    assert 2.5 in _column(edge, "x")  # exactly 1 + 1.5 * 1


def test_iqr_of_an_empty_column(spark):
    assert C.iqr_filter(_frame(spark, [(None,)], "x double"), "x").count() == 0


def test_rare_state_and_area(spark):
    rows = [("a", "X")] * 5 + [("b", "Y"), (None, "X")]
    df = C.bucket_rare_area(C.bucket_rare_state(_frame(spark, rows, "Area string, State string")))
    found = sorted(((r.Area or "", r.State) for r in df.collect()))
    assert found == sorted([("a", "X")] * 5 + [("Other_Other_State", "Other_State"), ("", "X")])


def test_rare_type_takes_missing_ones(spark):
    rows = [("a",)] * 30 + [("b",)] * 29 + [(None,)]
    df = C.bucket_rare_type(_frame(spark, rows, "Type string"))
    assert df.groupBy("Type_Plot").count().toPandas().set_index("Type_Plot")["count"].to_dict() == {"a": 30, "Others": 30}


def test_imputation_ignores_dropped_rows(spark):
    rows = [(1.0, 10.0), (1.0, 20.0), (None, 1e9), (1.0, None)]
    df = C.impute_median(C.drop_null_target(_frame(spark, rows, "Median_Price double, Transactions double")))
    assert sorted(_column(df, S.TX)) == [10.0, 15.0, 20.0]


def test_density_needs_a_positive_total(spark):
    df = _frame(spark, [("a", 0.0), ("b", None)], "Area string, Transactions double")
    assert C.area_density(df).columns == ["Area", "Transactions"]
    shares = C.area_density(_frame(spark, [("a", 3.0), ("b", None), (None, 1.0)], "Area string, Transactions double"))
    assert {r.Area: r[S.DENSITY] for r in shares.collect()} == {"a": 0.75, "b": 0.0, None: None}


def test_size_of_a_zero_divisor_is_null(spark):
    df = C.size_feature(_frame(spark, [(10.0, 0.0), (10.0, 4.0)], "Median_Price double, Median_PSF double"))
    assert _column(df, S.SIZE) == [None, 2.5]
    assert _column(df, S.LOG_SIZE)[1] == pytest.approx(math.log1p(2.5))
    assert S.PSF not in df.columns


def test_operators_skip_missing_columns(spark):
    df = _frame(spark, [(1,)], "x int")
    for operator in (C.drop_identifier, C.standardize_text, C.canonicalize_tenure, C.size_feature, C.area_density,
                     C.impute_median, C.bucket_rare_area, E.multi_hot, E.normalize_separator):
        assert operator(df).columns == ["x"]


def _reference_frame(raw):
    """The documented steps on a small pandas table."""
    df = raw.dropna(subset=[S.TARGET]).copy()
    df[S.TX] = df[S.TX].fillna(df[S.TX].median())
    for c in S.TEXT_COLUMNS:
        df[c] = df[c].str.strip().str.title().replace(r"\s+", " ", regex=True)
    df["Tenure"] = df["Tenure"].replace(C.TENURE_MERGES)
    df[S.SIZE] = df[S.TARGET] / df[S.PSF]
    df[S.DENSITY] = df.groupby("Area")[S.TX].transform("sum") / df[S.TX].sum()
    for c in (S.TARGET, S.TX):
        q1, q3 = df[c].quantile(0.25), df[c].quantile(0.75)
        df = df[df[c].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
    n = df["State"].map(df["State"].value_counts())
    df["State"] = df["State"].where(n >= 2, "Other_State")
    n = df["Area"].map(df["Area"].value_counts())
    df["Area"] = df["Area"].where(n >= 5, "Other_" + df["State"])
    return df


def test_preprocess_agrees_with_pandas(spark, folder):
    from lotwise.fixtures import listings

    raw = listings(spark, folder)
    raw = raw.withColumn("State", F.when(F.col(S.ID) == 1, F.lit("Lonely")).otherwise(F.col("State")))
    ours = preprocess(raw).toPandas().set_index(S.ID).sort_index()
    theirs = _reference_frame(raw.toPandas()).set_index(S.ID).sort_index()
    assert ours.index.equals(theirs.index)
    for c in ["Area", "State", "Tenure", S.TARGET, S.TX]:
        assert (ours[c] == theirs[c]).all(), c
    assert ours[S.DENSITY].to_numpy() == pytest.approx(theirs[S.DENSITY].to_numpy(), rel=1e-12)
    items = theirs["Type"].str.split(", ").map(len)
    assert (ours[S.flag_columns(list(ours.columns))].sum(axis=1) == items).all()


def test_items_of_any_list_are_those_of_the_normalised_text(spark):
    values = ["a, b", "A b, c d", "a,b", "a ,b", "a ,  b", "a,\u00a0b", "a, , b", ",a", "a, ", " a, b ", "a,, b", "", ",", "b, a, b", "a\tb, c", "é, è", "a  b, c", None]
    rows = _frame(spark, [(i, v) for i, v in enumerate(values)], "id int, Type string").repartition(1)
    normal = F.array_remove(F.array_distinct(F.split(X.normalize_separator(F.col("Type")), ", ", -1)), "")
    for r in rows.select("Type", X.tokens(F.col("Type")).alias("found"), normal.alias("expected")).collect():
        assert r["found"] == (r["expected"] or []), r["Type"]


def test_frequencies_and_flags_of_sets_that_were_cut_before(spark):
    rows = _frame(spark, [("s", "a", "x, y"), ("s", "b", "y,x, y"), (None, "b", None), ("t", "b", "")], "State string, Area string, Type string")
    cut = C.cut_set(rows)
    assert cut.schema["Type"].dataType.simpleString() == "array<string>"
    counts = {("State", "s", 2), ("State", "t", 1), ("Area", "a", 1), ("Area", "b", 3), ("Type", "x", 2), ("Type", "y", 2)}
    for df in (rows, cut):
        assert {tuple(r) for r in C.category_frequencies(df).collect()} == counts
    assert sorted(map(tuple, E.multi_hot(cut).collect()), key=repr) == sorted(map(tuple, E.multi_hot(rows).collect()), key=repr)


def test_preprocess_cuts_the_types_of_a_row_once(spark, monkeypatch):
    calls = []
    cut = X.tokens
    monkeypatch.setattr(X, "tokens", lambda text: calls.append(1) or cut(text))
    rows = [(i, f"lot {i}", "a", "s", "Freehold", "x, y", 10.0 + i, 1.0, 3.0) for i in range(12)]
    fields = "listing_id long, Township string, Area string, State string, Tenure string, Type string, Median_Price double, Median_PSF double, Transactions double"
    assert preprocess(_frame(spark, rows, fields)).select("Type_x", "Type_y").distinct().collect() == [(1, 1)]
    assert len(calls) == 1
