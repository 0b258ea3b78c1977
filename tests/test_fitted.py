"""Preprocessing that is fitted on the train rows alone."""

import pytest
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.fixtures import listings
from lotwise.plans.fitted import Preprocessor, fit_preprocessor, split_and_fit
from lotwise.plans.preprocess import clean_rows, preprocess
from lotwise.plans.training import prepare_split
from lotwise.sources.staging import stage


def _rows(df):
    columns = sorted(df.columns)
    return sorted(df.select(*[F.col(f"`{c}`") for c in columns]).collect(), key=repr)


def _fitted_numbers(fitted):
    tables = [sorted(map(tuple, t.collect())) for t in (fitted.shares, fitted.states, fitted.areas, fitted.types)]
    return fitted.median, fitted.price, fitted.transactions, tables


def test_fitted_on_all_rows_it_is_the_default(spark, folder):
    raw = listings(spark, folder)
    rows = stage(clean_rows(raw))
    ours, default = fit_preprocessor(rows).transform(rows), preprocess(raw)
    assert ours.columns == default.columns
    assert _rows(ours) == _rows(default)


def test_test_rows_enter_no_statistic(spark, folder, tmp_path):
    """Other prices, transactions, Areas and types in the test rows change nothing for the train rows."""
    raw = listings(spark, folder)
    split, fitted = split_and_fit(raw)
    cleaned = clean_rows(raw)
    in_test = split.where("split = 'test'").select(S.ID, F.lit(True).alias("_test"))
    changed = stage(
        raw.join(in_test, S.ID, "left")
        .withColumn(S.TARGET, F.when(F.col("_test"), F.col(S.TARGET) * 1000).otherwise(F.col(S.TARGET)))
        .withColumn(S.TX, F.when(F.col("_test"), F.lit(1e6)).otherwise(F.col(S.TX)))
        .withColumn("Area", F.when(F.col("_test"), F.lit("Nowhere")).otherwise(F.col("Area")))
        .withColumn("Type", F.when(F.col("_test"), F.lit("Castle")).otherwise(F.col("Type")))
        .select(*raw.columns)
    )
    other_split, other = split_and_fit(changed)
    assert _fitted_numbers(other) == _fitted_numbers(fitted)
    train = "split = 'train'"
    assert _rows(other_split.where(train)) == _rows(split.where(train))
    assert other_split.where("split = 'test'").isEmpty()  # all beyond the fences of the train rows
    assert f"{S.TYPE_PREFIX}Castle" not in other_split.columns

    fitted.save(str(tmp_path / "p"))
    again = Preprocessor.load(spark, str(tmp_path / "p"))
    assert _fitted_numbers(again) == _fitted_numbers(fitted)
    assert _rows(again.transform(cleaned)) == _rows(split.drop("split"))


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, 100.0 + i, float(i % 4), "A" if i < 12 else "B", "X", "Flat", 5.0) for i in range(20)]
    return spark.createDataFrame(rows, f"{S.ID} long, {S.TARGET} double, {S.TX} double, Area string, State string, Type string, {S.PSF} double")


def test_values_the_fit_rows_lack(spark, small):
    fitted = fit_preprocessor(clean_rows(small))
    new = [
        (1, 105.0, None, "A", "X", "Flat", 5.0),
        (2, 105.0, 1.0, "New", "X", "Tower, Flat", 5.0),
        (3, 105.0, 1.0, "New", "Y", None, 5.0),
        (4, 105.0, 1.0, None, None, "Flat", 5.0),
        (5, 9e9, 1.0, "A", "X", "Flat", 5.0),
    ]
    rows = {r[S.ID]: r for r in fitted.transform(clean_rows(spark.createDataFrame(new, small.schema))).collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert rows[1][S.TX] == 1.5 and rows[1]["Area"] == "A"
    assert (rows[2]["Area"], rows[2][S.DENSITY], rows[2]["Type_Flat"]) == ("Other_X", 0.0, 1)
    assert (rows[3]["State"], rows[3]["Area"]) == ("Other_State", "Other_Other_State")
    assert (rows[4]["State"], rows[4]["Area"], rows[4][S.DENSITY]) == (None, None, None)


def test_a_table_without_numbers_keeps_no_row(spark, small, tmp_path):
    fitted = fit_preprocessor(clean_rows(small.where("false")))
    assert fitted.transform(clean_rows(small)).isEmpty()
    fitted.save(str(tmp_path / "p"))
    assert Preprocessor.load(spark, str(tmp_path / "p")).transactions is None


def test_a_state_with_one_row_keeps_the_strata(spark, small, recwarn):
    lonely = small.withColumn("State", F.when(F.col(S.ID) < 2, F.concat(F.lit("L"), F.col(S.ID).cast("string"))).otherwise(F.col("State")))
    split, _ = split_and_fit(lonely)
    assert not [w for w in recwarn if "stratified" in str(w.message)]
    assert split.where("State in ('L0', 'L1')").isEmpty()


def test_only_two_choices(small):
    with pytest.raises(ValueError):
        prepare_split(small, fit_on="test")
