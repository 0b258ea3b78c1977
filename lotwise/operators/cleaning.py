"""Cleaning and feature operators. Columns that a table does not have are skipped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lotwise import schema as S
from lotwise.functions import text as X
from lotwise.functions.numeric import nan_as_null
from lotwise.operators.quantiles import quantile_values
from lotwise.sources.staging import stage

# Fixed values.
TENURE_MERGES = {
    "Freehold, Leasehold": "Freehold and Leasehold",
    "Leasehold, Freehold": "Freehold and Leasehold",
}
OTHER_STATE = "Other_State"
OTHER_AREA_PREFIX = "Other_"
OTHER_TYPE = "Others"
MIN_STATE_ROWS = 2
MIN_AREA_ROWS = 5
MIN_TYPE_ROWS = 30


def drop_null_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.where(nan_as_null(F.col(target)).isNotNull())


def impute_median(df: DataFrame, column: str = S.TX, approx: bool = False) -> DataFrame:
    """Fill NULL and NaN with the median of the column; a column without numbers stays NULL."""
    if column not in df.columns:
        return df
    median = quantile_values(df, [column], [0.5], approx).get(column)
    if median is None:
        return df.withColumn(column, nan_as_null(F.col(column)))
    return df.withColumn(column, F.coalesce(nan_as_null(F.col(column)), F.lit(median[0])))


def fences(q1: float, q3: float) -> tuple[float, float]:
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def iqr_filter(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """Keep rows inside the fences, ends included; NULLs go."""
    quartiles = quantile_values(df, [column], [0.25, 0.75], approx).get(column)
    if quartiles is None:
        return df.where(F.lit(False))
    return df.where(F.col(column).between(*fences(*quartiles)))


def iqr_filter_chain(df: DataFrame, columns: Sequence[str] = (S.TARGET, S.TX), approx: bool = False) -> DataFrame:
    """One filter after the other, each with fences of the rows still there."""
    for column in columns:
        df = iqr_filter(df, column, approx)
    return df


def standardize_text(df: DataFrame, columns: Sequence[str] = tuple(S.TEXT_COLUMNS)) -> DataFrame:
    return df.withColumns({c: X.standardize(F.col(c)) for c in columns if c in df.columns})


def drop_identifier(df: DataFrame, column: str = "Township") -> DataFrame:
    return df.drop(column)


def canonicalize_tenure(df: DataFrame) -> DataFrame:
    return df.replace(TENURE_MERGES, subset=["Tenure"]) if "Tenure" in df.columns else df


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def set_items(df: DataFrame, column: str = "Type") -> Column:
    """Items of a set column: of its text, or the column itself where :func:`cut_set` cut it before."""
    return F.col(column) if isinstance(df.schema[column].dataType, ArrayType) else X.tokens(F.col(column))


def cut_set(df: DataFrame, column: str = "Type") -> DataFrame:
    """The text of a set column replaced by its items, so a staged table is cut once for all that read them."""
    return df.withColumn(column, set_items(df, column)) if column in df.columns else df


def category_frequencies(df: DataFrame, columns: Sequence[str] = ("State", "Area"), set_column: str = "Type") -> DataFrame:
    """Staged (column, value, n) of several text columns and of the items of a set.

    Each column is counted by itself, so a scan reads that column only, and equal sets are counted before they are taken apart.
    """
    parts = [value_frequencies(df, c).select(F.lit(c).alias("column"), F.col(c).alias("value"), "n") for c in columns if c in df.columns]
    if set_column in df.columns:
        sets = df.groupBy(set_items(df, set_column).alias("items")).agg(F.count(F.lit(1)).alias("n"))
        items = sets.select(F.explode("items").alias("value"), "n").where(F.col("value").isNotNull())
        items = items.groupBy("value").agg(F.sum("n").alias("n"))
        parts.append(items.select(F.lit(set_column).alias("column"), "value", "n"))
    return stage(reduce(DataFrame.unionByName, parts))


def rare_values(df: DataFrame, column: str, min_count: int) -> DataFrame:
    """Staged table of the values seen fewer than ``min_count`` times."""
    return stage(value_frequencies(df, column).where(F.col("n") < min_count).select(column))


def rare_among(frequencies: DataFrame, column: str, min_count: int) -> DataFrame:
    """The same from the result of :func:`category_frequencies`."""
    rare = (F.col("column") == column) & (F.col("n") < min_count)
    return frequencies.where(rare).select(F.col("value").alias(column))


def _flag_rare(df: DataFrame, column: str, rare: DataFrame) -> DataFrame:
    return df.join(rare.withColumn("_rare", F.lit(True)), column, "left")


def bucket_rare_state(df: DataFrame, min_count: int = MIN_STATE_ROWS, rare: DataFrame | None = None) -> DataFrame:
    columns = df.columns
    if rare is None:
        rare = rare_values(df, "State", min_count)
    state = F.when(F.col("_rare"), F.lit(OTHER_STATE)).otherwise(F.col("State"))
    return _flag_rare(df, "State", rare).withColumn("State", state).select(*columns)


def bucket_rare_area(df: DataFrame, min_count: int = MIN_AREA_ROWS, rare: DataFrame | None = None) -> DataFrame:
    """Rarity counts the Area alone; the State of the row names the bucket."""
    columns = df.columns
    if not {"Area", "State"} <= set(columns):
        return df
    if rare is None:
        rare = rare_values(df, "Area", min_count)
    bucket = F.concat(F.lit(OTHER_AREA_PREFIX), F.col("State"))
    area = F.when(F.col("_rare"), bucket).otherwise(F.col("Area"))
    return _flag_rare(df, "Area", rare).withColumn("Area", area).select(*columns)


def bucket_rare_type(df: DataFrame, min_count: int = MIN_TYPE_ROWS, output: str = "Type_Plot") -> DataFrame:
    """Adds ``output``: the Type, or one bucket for rare and missing ones."""
    columns = df.columns
    rare = F.col("_rare") | F.col("Type").isNull()
    value = F.when(rare, F.lit(OTHER_TYPE)).otherwise(F.col("Type"))
    flagged = _flag_rare(df, "Type", rare_values(df, "Type", min_count))
    return flagged.withColumn(output, value).select(*columns, output)


def size_feature(df: DataFrame) -> DataFrame:
    """Size = price / price per area unit (NULL for a zero divisor), its log1p; the divisor goes."""
    if S.PSF not in df.columns:
        return df
    sized = df.withColumn(S.SIZE, F.try_divide(nan_as_null(F.col(S.TARGET)), nan_as_null(F.col(S.PSF))))
    return sized.withColumn(S.LOG_SIZE, F.log1p(S.SIZE)).drop(S.PSF)


def area_shares(df: DataFrame) -> DataFrame | None:
    """Share of every Area in all transactions; None when the total is not positive."""
    if not {"Area", S.TX} <= set(df.columns):
        return None
    sums = stage(df.groupBy("Area").agg(F.sum(nan_as_null(F.col(S.TX))).alias("_area_tx")))
    total = sums.agg(F.sum("_area_tx")).first()[0]
    if total is None or total <= 0:
        return None
    # An Area without any number has the sum 0.
    share = F.coalesce("_area_tx", F.lit(0.0)) / F.lit(total)
    return sums.where(F.col("Area").isNotNull()).select("Area", share.alias(S.DENSITY))


def add_density(df: DataFrame, shares: DataFrame | None) -> DataFrame:
    if shares is None:
        return df
    return df.join(shares, "Area", "left").select(*df.columns, S.DENSITY)


def area_density(df: DataFrame) -> DataFrame:
    return add_density(df, area_shares(df))


def filter_state(df: DataFrame, state: str) -> DataFrame:
    return df.where(F.col("State") == state)
