"""Grouped summaries of the market and the State-Area lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.numeric import nan_as_null
from lotwise.operators.encoding import melt_types
from lotwise.operators.quantiles import exact_quantiles
from lotwise.sources.staging import stage

# What a request gets when its State and Area are not in the lookup.
DEFAULT_TX = 16.0
DEFAULT_DENSITY = 0.005


def group_median(df: DataFrame, by: list[str], column: str = S.TARGET) -> DataFrame:
    known = df
    for key in by:
        known = known.where(F.col(key).isNotNull())
    return exact_quantiles(known, [column], [0.5], by=by).select(*by, F.col("q")[0].alias("median"))


def top_k(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """The k largest by value, ties by key; planned as a top-k per partition and a merge."""
    return df.orderBy(F.desc(value), key).limit(k)


def group_median_topk(df: DataFrame, by: str = "State", column: str = S.TARGET, k: int = 10) -> DataFrame:
    return top_k(group_median(df, [by], column), "median", by, k)


def market_benchmark(df: DataFrame, state: str, type_name: str | None = None, predicted: float | None = None) -> DataFrame:
    """Median price per Type of a State, descending, with a prediction beside its own Type."""
    medians = group_median(df.where(F.col("State") == state), ["Type"])
    mark = F.when(F.col("Type") == F.lit(type_name), F.lit(predicted).cast("double"))
    return medians.withColumn("predicted", mark).orderBy(F.desc("median"), "Type")


def type_volume_topk(df: DataFrame, k: int = 8) -> DataFrame:
    """Transactions per item of the Type set, from its 0/1 columns."""
    flags = S.flag_columns(df.columns)
    sums = df.agg(
        *[
            F.struct(
                F.lit(c[len(S.TYPE_PREFIX):]).alias("Type"),
                F.coalesce(F.sum(F.col(f"`{c}`") * nan_as_null(F.col(S.TX))), F.lit(0.0)).alias("volume"),
            ).alias(f"s{i}")
            for i, c in enumerate(flags)
        ]
    )
    long = sums.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(flags))])))
    return top_k(long, "volume", "Type", k)


def top_types_filter(df: DataFrame, k: int = 8) -> DataFrame:
    """One row per listing and item, for the k most frequent items."""
    long = melt_types(df)
    counts = long.groupBy("Type").agg(F.count(F.lit(1)).alias("n"))
    # k rows.
    return long.join(F.broadcast(top_k(counts, "n", "Type", k)), "Type", "left_semi").select(*long.columns)


def lookup_table(df: DataFrame) -> DataFrame:
    """(State, Area, Transactions, density) from raw rows: median and share of the grand total."""
    total = df.agg(F.sum(nan_as_null(F.col(S.TX)))).first()[0]
    keys = ["State", "Area"]
    known = df.where(F.col("State").isNotNull() & F.col("Area").isNotNull())
    sums = known.groupBy(*keys).agg(F.coalesce(F.sum(nan_as_null(F.col(S.TX))), F.lit(0.0)).alias("_sum"))
    medians = group_median(known, keys, S.TX)
    if total is not None and total > 0:
        density = F.col("_sum") / F.lit(total)
    else:
        density = F.lit(DEFAULT_DENSITY)
    return sums.join(medians, keys, "left").select(
        *keys,
        F.coalesce("median", F.lit(DEFAULT_TX)).alias(S.TX),
        density.alias(S.DENSITY),
    )


def count_map_back(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Adds to each row how often its value occurs; NULL for a NULL."""
    counts = stage(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name)))
    return df.join(counts, column, "left").select(*df.columns, name)


def group_total(df: DataFrame, by: str = "Area", column: str = S.TX, name: str = "group_total") -> DataFrame:
    """Adds the total of the group to each row.

    Aggregation and join instead of an unordered window: the window would move
    all rows of a frequent value into one task.
    """
    sums = stage(
        df.where(F.col(by).isNotNull()).groupBy(by).agg(F.coalesce(F.sum(nan_as_null(F.col(column))), F.lit(0.0)).alias(name))
    )
    return df.join(sums, by, "left").select(*df.columns, name)


def rare_membership(df: DataFrame, column: str, min_count: int) -> DataFrame:
    """Adds whether the row's value is seen fewer than ``min_count`` times."""
    counted = count_map_back(df, column, "_n")
    return counted.select(*df.columns, F.coalesce(F.col("_n") < min_count, F.lit(False)).alias("is_rare"))


def share_of_total(df: DataFrame, column: str = S.TX, name: str = "share") -> DataFrame:
    """Adds value / total: a one-row total as a scalar subquery, run once."""
    total = df.agg(F.sum(nan_as_null(F.col(column)))).scalar()
    return df.withColumn(name, F.try_divide(nan_as_null(F.col(column)), total))
