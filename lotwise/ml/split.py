"""Reproducible train/test split and folds from a hash of the row key."""

from __future__ import annotations

import warnings
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.operators.chartdata import ordered_index
from lotwise.operators.quantiles import order_statistics
from lotwise.sources.staging import stage

SEED = 42
TEST_SHARE = 0.2
# 13 hexadecimal digits are exact in a double.
_DIGITS = 13


def hash_number(key: str = S.ID, seed: int = SEED) -> Column:
    """A number in [0, 16^13) that looks random and only depends on key and seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")


def hash_split(df: DataFrame, test_share: float = TEST_SHARE, key: str = S.ID, seed: int = SEED) -> DataFrame:
    """Adds ``split`` by a fixed threshold: no shuffle, shares are right on average."""
    test = hash_number(key, seed) < F.lit(int(test_share * 16**_DIGITS))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def _stratum(by: str) -> Column:
    return F.coalesce(F.col(by).cast("string"), F.lit(""))


def train_test_split(
    df: DataFrame, by: str | None = "State", test_share: float = TEST_SHARE, key: str = S.ID, seed: int = SEED
) -> DataFrame:
    """Adds ``split``: exactly ceil(share * rows) test rows, divided over the strata.

    Each stratum gets the floor of its share and the largest remainders one row
    more. Its test rows are those with the smallest hashes; the limiting hash is
    found by counting, so a frequent stratum is never sorted in one task. A
    stratum with a single row turns stratification off. ``df`` is computed once
    and staged with its hashes.
    """
    return _split(stage(df.withColumn("_hash", hash_number(key, seed))), by, test_share)


def _split(df: DataFrame, by: str | None, test_share: float) -> DataFrame:
    stratum = F.lit("") if by is None else _stratum(by)
    sizes = stage(df.groupBy(stratum.alias("_stratum")).agg(F.count(F.lit(1)).alias("_size")))
    if by is not None and sizes.where("_size < 2").limit(1).count():
        warnings.warn(f"a value of {by} has a single row: the split is not stratified", stacklevel=3)
        return _split(df, None, test_share)
    rows = sizes.agg(F.sum("_size")).first()[0] or 0
    n_test = ceil(rows * test_share)
    exact = F.col("_size") * F.lit(n_test) / F.lit(max(rows, 1))
    quotas = sizes.withColumn("_quota", F.floor(exact)).withColumn("_rest", exact - F.floor(exact))
    left = n_test - (quotas.agg(F.sum("_quota")).first()[0] or 0)
    ranked = ordered_index(quotas.withColumn("_order", -F.col("_rest")), ["_order", "_stratum"])
    one_more = (F.col("index") < F.lit(left)).cast("long")
    quotas = stage(ranked.select("_stratum", (F.col("_quota") + one_more).alias("_quota")))

    def with_ranks(cells: DataFrame) -> DataFrame:
        return cells.join(quotas, "_stratum").withColumn("_ranks", F.array(F.col("_quota") - 1)).drop("_quota")

    points = df.select(stratum.alias("_stratum"), F.col("_hash").cast("double").alias("value"))
    limits = stage(order_statistics(points, ["_stratum"], with_ranks).select("_stratum", F.col("value").alias("_limit")))
    is_test = F.coalesce(F.col("_hash") <= F.col("_limit"), F.lit(False))
    return (
        df.withColumn("_stratum", stratum)
        .join(limits, "_stratum", "left")
        .select(*[F.col(f"`{c}`") for c in df.columns if c != "_hash"], F.when(is_test, "test").otherwise("train").alias("split"))
    )


def with_folds(df: DataFrame, folds: int = 5, key: str = S.ID, seed: int = SEED) -> DataFrame:
    """Adds ``fold``; the seed is shifted so that folds do not follow the split."""
    return df.withColumn("fold", (hash_number(key, seed + 1) % folds).cast("int"))
