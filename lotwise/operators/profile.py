"""Profiles of a table: counts, nulls, duplicates, moments, frequent values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.numeric import corrected_skewness, nan_as_null
from lotwise.operators.quantiles import quantile_values, quantiles
from lotwise.sources.listings import nan_to_null
from lotwise.sources.staging import small_table, stage

TOP_VALUES = 15
SMALL_GROUP_ROWS = 5
MANY_VALUES = 50
DESCRIBE_STATS = ["count", "unique", "top", "freq", "mean", "std", "min", "25%", "50%", "75%", "max"]


def profiled_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != S.ID]


def _is_missing(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    return nan_as_null(value).isNull() if S.is_numeric(df.schema[column].dataType) else value.isNull()


def per_column(df: DataFrame, columns: Sequence[str], stats: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """One row per column, all statistics of all columns taken in a single aggregation."""
    row = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), *[make(c).alias(name) for name, make in stats.items()]).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return row.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))])))


def text_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of every non-null text value."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier one in all profiled columns; NULLs are equal, and NaN is NULL."""
    groups = nan_to_null(df).groupBy(*profiled_columns(df)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def profile_summary(df: DataFrame) -> DataFrame:
    columns = profiled_columns(df)
    df = nan_to_null(df)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    missing = sum((_is_missing(df, c).cast("long") for c in columns), F.lit(0).cast("long"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.lit(len(columns)).cast("long").alias("n_columns"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.col("_n") * missing), F.lit(0)).alias("nulls"),
    )


def nunique(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column; NaN is NULL, and 0.0 equals -0.0.

    Numbers go through the shuffle as numbers, apart from texts.
    """
    columns = profiled_columns(df)
    df = nan_to_null(df)
    if approx:
        return per_column(df, columns, {"n_unique": lambda c: F.approx_count_distinct(c)})
    floats = [f.name for f in df.schema if f.name in columns and f.dataType.typeName() in ("float", "double")]
    others = [c for c in columns if c not in floats]
    parts = []
    if floats:
        numbers = df.select(*[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(c) for c in floats])
        long = numbers.unpivot([], floats, "column", "value").where(F.col("value").isNotNull()).distinct()
        parts.append(long.groupBy("column").agg(F.count(F.lit(1)).alias("n")))
    if others:
        parts.append(text_value_counts(df, others).groupBy("column").agg(F.count(F.lit(1)).alias("n")))
    counted = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    names = small_table(df.sparkSession, [(c,) for c in columns], "column string")
    return names.join(counted, "column", "left").select("column", F.coalesce("n", F.lit(0)).alias("n_unique"))


def null_counts(df: DataFrame, only_positive: bool = False) -> DataFrame:
    counts = per_column(df, profiled_columns(df), {"nulls": lambda c: F.count_if(_is_missing(df, c))})
    return counts.where(F.col("nulls") > 0) if only_positive else counts


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def top_k_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values of each text column, ties by value.

    The rank filter also runs before the shuffle (window group limit), so each
    task sends k rows per column.
    """
    counts = text_value_counts(df, columns or S.text_columns(df.schema))
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def skew_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    def raw(c: str) -> Column:
        return nan_as_null(F.col(c))

    return per_column(
        df,
        columns or S.numeric_columns(df.schema),
        {
            "skew_raw": lambda c: corrected_skewness(raw(c)),
            "skew_log1p": lambda c: corrected_skewness(F.log1p(raw(c))),
        },
    )


def iqr_outlier_count(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Values outside the fences, and their share of all rows in percent."""
    columns = list(columns or S.numeric_columns(df.schema))
    quartiles = quantile_values(df, columns, [0.25, 0.75], approx)

    def outside(c: str) -> Column:
        if c not in quartiles:
            return F.count_if(F.lit(False))
        q1, q3 = quartiles[c]
        reach = 1.5 * (q3 - q1)
        value = nan_as_null(F.col(c))
        return F.count_if((value < q1 - reach) | (value > q3 + reach))

    counts = per_column(df, columns, {"outliers": outside, "n_rows": lambda c: F.count(F.lit(1))})
    percent = F.try_divide(F.col("outliers") * 100.0, F.col("n_rows"))
    return counts.select("column", "outliers", percent.alias("pct"))


def describe_all(df: DataFrame, approx: bool = False) -> DataFrame:
    """(stat, one column per input column): text columns as text, numbers as doubles."""
    columns = profiled_columns(df)
    numbers = [c for c in columns if S.is_numeric(df.schema[c].dataType)]
    texts = [c for c in columns if c not in numbers]
    parts: list[DataFrame] = []

    def long(frame: DataFrame, stats: Mapping[str, Column], kind: str) -> DataFrame:
        other = F.lit(None).cast("double" if kind == "text" else "string")
        entries = [
            F.struct(
                F.lit(stat).alias("stat"),
                (value.cast("string") if kind == "text" else other).alias("text"),
                (other if kind == "text" else value.cast("double")).alias("number"),
            )
            for stat, value in stats.items()
        ]
        return frame.select("column", F.inline(F.array(*entries)))

    if texts:
        # The smallest of (-n, value) is the most frequent value, ties by value.
        top = F.min(F.struct((-F.col("n")).alias("m"), F.col("value")))
        per_text = text_value_counts(df, texts).groupBy("column").agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("unique"), top.alias("top")
        )
        parts.append(
            long(
                per_text,
                {"count": F.col("n"), "unique": F.col("unique"), "top": F.col("top.value"), "freq": -F.col("top.m")},
                "text",
            )
        )
    if numbers:
        moments = per_column(
            df,
            numbers,
            {
                "n": lambda c: F.count(nan_as_null(F.col(c))),
                "mean": lambda c: F.avg(nan_as_null(F.col(c))),
                "std": lambda c: F.stddev_samp(nan_as_null(F.col(c))),
            },
        )
        parts.append(long(moments, {"count": F.col("n"), "mean": F.col("mean"), "std": F.col("std")}, "number"))
        order = quantiles(df, numbers, [0.0, 0.25, 0.5, 0.75, 1.0], approx=approx)
        names = ["min", "25%", "50%", "75%", "max"]
        parts.append(long(order, {s: F.col("q")[i] for i, s in enumerate(names)}, "number"))

    stats = small_table(df.sparkSession, [(s,) for s in DESCRIBE_STATS], "stat string")
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    wide = entries.groupBy("stat").agg(
        *[
            F.max(F.when(F.col("column") == c, F.col("number" if c in numbers else "text"))).alias(c)
            for c in columns
        ]
    )
    return stats.join(wide, "stat", "left").select("stat", *columns)


def fd_check(df: DataFrame, determinant: str = "Area", dependent: str = "State") -> DataFrame:
    """Whether each determinant value goes with a single dependent value."""
    pairs = df.where(F.col(determinant).isNotNull()).select(determinant, dependent).distinct()
    each = pairs.groupBy(determinant).agg(F.count(dependent).alias("n"))
    most = F.max("n")
    return each.agg(most.alias("max_dependents"), (most == 1).alias("holds"))


def group_size_profile(df: DataFrame, column: str = "Area", small: int = SMALL_GROUP_ROWS) -> DataFrame:
    """Distribution of the rows per value, and how many values have few rows."""
    sizes = stage(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    quarters = quantile_values(sizes, ["n"], [0.0, 0.25, 0.5, 0.75, 1.0]).get("n", [None] * 5)
    few = F.count_if(F.col("n") < small)
    names = ["min", "q1", "median", "q3", "max"]
    return sizes.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("std"),
        *[F.lit(q).cast("double").alias(s) for q, s in zip(quarters, names)],
        few.alias("n_small"),
        F.try_divide(few * 100.0, F.count(F.lit(1))).alias("pct_small"),
    )


def rare_category_pct(
    df: DataFrame, columns: Sequence[str] | None = None, many: int = MANY_VALUES, small: int = SMALL_GROUP_ROWS
) -> DataFrame:
    """Per text column with many values: the percentage of them with few rows."""
    counts = text_value_counts(df, columns or S.text_columns(df.schema)).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"), F.count_if(F.col("n") < small).alias("n_rare")
    )
    percent = F.col("n_rare") * 100.0 / F.col("n_unique")
    return counts.where(F.col("n_unique") > many).select("column", "n_unique", percent.alias("rare_pct"))
