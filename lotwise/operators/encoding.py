"""Multi-hot flags of a comma-separated set, and the selection of model columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions import text as X
from lotwise.operators.cleaning import set_items

# The type names a request may carry.
TYPE_NAMES = [
    "Apartment",
    "Bungalow",
    "Cluster House",
    "Condominium",
    "Flat",
    "Semi D",
    "Service Residence",
    "Terrace House",
    "Town House",
]


def normalize_separator(df: DataFrame, column: str = "Type") -> DataFrame:
    return df.withColumn(column, X.normalize_separator(F.col(column))) if column in df.columns else df


def column_names_of(items: DataFrame, column: str = "Type", at_most: int | None = None) -> list[str]:
    """Sorted values of a one-column frame of distinct items.

    They become column names, so they come to the driver. ``at_most`` lets a caller refuse a wider schema
    than it can use; `melt_types` gives the long form then.
    """
    names = [r[0] for r in (items if at_most is None else items.limit(at_most + 1)).collect()]
    if at_most is not None and len(names) > at_most:
        raise ValueError(f"{column} has more than {at_most} different items")
    return sorted(names)


def type_vocabulary(df: DataFrame, column: str = "Type") -> list[str]:
    return column_names_of(df.select(F.explode(set_items(df, column))).distinct(), column)


def multi_hot(df: DataFrame, column: str = "Type", vocabulary: Sequence[str] | None = None) -> DataFrame:
    """Replace a set column by one 0/1 column per item, sorted by name."""
    if column not in df.columns:
        return df
    names = type_vocabulary(df, column) if vocabulary is None else list(vocabulary)
    others = [c for c in df.columns if c != column]
    cut = df.withColumn("_items", set_items(df, column))
    flags = [F.array_contains("_items", v).cast("int").alias(f"{S.TYPE_PREFIX}{v}") for v in names]
    return cut.select(*[F.col(f"`{c}`") for c in others], *flags)


def multi_hot_fixed(df: DataFrame, column: str = "Type", vocabulary: Sequence[str] = tuple(TYPE_NAMES)) -> DataFrame:
    """Flags of a given vocabulary; without the column, missing flags become 0."""
    names = [f"{S.TYPE_PREFIX}{v}" for v in vocabulary]
    if column not in df.columns:
        return df.withColumns({c: F.lit(0) for c in names if c not in df.columns})
    others = [c for c in df.columns if c != column and c not in names]
    cut = df.withColumn("_items", F.coalesce(X.trimmed_tokens(F.col(column)), F.array().cast("array<string>")))
    flags = [
        F.array_contains("_items", v).cast("int").alias(c) for v, c in zip(vocabulary, names)
    ]
    return cut.select(*[F.col(c) for c in others], *flags)


def melt_types(df: DataFrame, keep: Sequence[str] = (S.ID, S.TARGET), column: str = "Type") -> DataFrame:
    """One row per listing and item, from the set column or from its flags."""
    kept = [F.col(c) for c in keep if c in df.columns]
    if column in df.columns:
        return df.select(*kept, F.explode(X.tokens(F.col(column))).alias(column))
    flags = S.flag_columns(df.columns)
    items = F.array_compact(
        F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c[len(S.TYPE_PREFIX):])) for c in flags])
    )
    return df.select(*kept, F.explode(items).alias(column))


def select_features(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], target: str | None = S.TARGET
) -> DataFrame:
    flags = [f"`{c}`" for c in S.flag_columns(df.columns)]
    keys = [S.ID] if S.ID in df.columns else []
    return df.select(*keys, *categorical, *numeric, *flags, *([target] if target else []))
