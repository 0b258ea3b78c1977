"""Association of column pairs: Pearson, Cramér's V and the correlation ratio.

Each measure takes one pass over the rows for all its pairs; what follows works
on counts or moments per category. Pairs with a NULL on either side are left
out, per pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.numeric import nan_as_null
from lotwise.sources.staging import small_table, stage

PAIR = ["col_i", "col_j"]


def pearson(a: str, b: str) -> Column:
    """Signed correlation; NULL when a side does not vary."""
    # corr() divides by zero for a constant, which is an error in ANSI mode.
    x, y = nan_as_null(F.col(a)), nan_as_null(F.col(b))
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pearson_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(pearson(a, b).alias("r"))


def _pearson_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    row = df.agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), F.col(f"r{i}").alias("value"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def mirror(upper: DataFrame) -> DataFrame:
    """Both orders of every pair of different columns."""
    others = [F.col(c) for c in upper.columns if c not in PAIR]
    sides = F.array(
        F.struct(F.col("col_i").alias("i"), F.col("col_j").alias("j")),
        F.struct(F.col("col_j").alias("i"), F.col("col_i").alias("j")),
    )
    return upper.select(F.explode(sides).alias("side"), *others).select(
        F.col("side.i").alias("col_i"), F.col("side.j").alias("col_j"), *others
    )


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_i, col_j, r) for all numeric pairs, the diagonal included."""
    columns = list(columns or S.numeric_columns(df.schema))
    diagonal = _pearson_pairs(df, [(c, c) for c in columns])
    upper = list(combinations(columns, 2))
    both = diagonal.unionByName(mirror(_pearson_pairs(df, upper))) if upper else diagonal
    return both.withColumnRenamed("value", "r")


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Non-empty cells of the cross table, in long form."""
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return known.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def pair_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_i, col_j, a, b, n): the cross tables of all pairs, in long form, from one pass.

    NULLs can only go after grouping: a row with one still counts for the other pairs.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    counts = df.groupingSets([[F.col(a), F.col(b)] for a, b in pairs], *columns).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id(*columns).alias("_set")
    )

    def labelled(pick) -> Column:
        """For each pair the picked column or name, chosen by the grouping set of the row."""
        value = None
        for pair in pairs:
            # grouping_id has a 1 for each column that is not in the set, first column highest.
            code = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in pair)
            hit = F.col("_set") == code
            value = F.when(hit, pick(pair)) if value is None else value.when(hit, pick(pair))
        return value

    return counts.select(
        labelled(lambda p: F.lit(p[0])).alias("col_i"),
        labelled(lambda p: F.lit(p[1])).alias("col_j"),
        labelled(lambda p: F.col(p[0])).alias("a"),
        labelled(lambda p: F.col(p[1])).alias("b"),
        "n",
    ).where(F.col("a").isNotNull() & F.col("b").isNotNull())


def cramers_v(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_i, col_j, value): bias-corrected V without continuity correction.

    chi² = n (Σ n_ij² / (n_i n_j) - 1) needs the non-empty cells only.
    """
    cells = stage(pair_counts(df, pairs))
    rows = cells.groupBy(*PAIR, "a").agg(F.sum("n").alias("n_a"))
    cols = cells.groupBy(*PAIR, "b").agg(F.sum("n").alias("n_b"))
    share = F.col("n").cast("double") * F.col("n") / (F.col("n_a").cast("double") * F.col("n_b"))
    overlap = (
        cells.join(rows, [*PAIR, "a"])
        .join(cols, [*PAIR, "b"])
        .groupBy(*PAIR)
        .agg(F.sum(share).alias("overlap"), F.sum("n").cast("double").alias("n"))
    )
    sizes = (
        rows.groupBy(*PAIR)
        .agg(F.count(F.lit(1)).cast("double").alias("r"))
        .join(cols.groupBy(*PAIR).agg(F.count(F.lit(1)).cast("double").alias("k")), PAIR)
    )
    n, r, k = F.col("n"), F.col("r"), F.col("k")
    phi2 = F.greatest(
        F.lit(0.0), F.col("overlap") - 1 - F.try_divide((k - 1) * (r - 1), n - 1)
    )
    r_fixed = r - F.try_divide((r - 1) * (r - 1), n - 1)
    k_fixed = k - F.try_divide((k - 1) * (k - 1), n - 1)
    base = F.least(k_fixed - 1, r_fixed - 1)
    # Outside of n > 1 and base > 0 the measure does not exist; greatest() would hide that NULL.
    value = F.when((n > 1) & (base > 0), F.sqrt(F.try_divide(phi2, base)))
    return overlap.join(sizes, PAIR).select(*PAIR, value.alias("value"))


def correlation_ratio(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_i, col_j, value) for (category, number) pairs: sqrt(between / total sum of squares)."""
    categories = list(dict.fromkeys(c for c, _ in pairs))
    numbers = list(dict.fromkeys(v for _, v in pairs))
    names = [f"v{i}" for i in range(len(numbers))]
    values = [nan_as_null(F.col(v)).alias(name) for v, name in zip(numbers, names)]
    long = df.select(*values, *categories).unpivot(names, categories, "col_i", "category")
    known = long.where(F.col("category").isNotNull())
    moments = known.groupBy("col_i", "category").agg(
        *[
            F.struct(
                F.lit(v).alias("col_j"),
                F.count(f"v{i}").alias("n"),
                F.avg(f"v{i}").alias("mean"),
                F.var_pop(f"v{i}").alias("spread"),
            ).alias(f"m{i}")
            for i, v in enumerate(numbers)
        ]
    )
    groups = stage(
        moments.select("col_i", F.inline(F.array(*[F.col(f"m{i}") for i in range(len(numbers))]))).where("n > 0")
    )
    grand = groups.groupBy(*PAIR).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    shift = F.col("mean") - F.col("grand")
    between = F.sum(F.col("n") * shift * shift)
    within = F.sum(F.col("n") * F.col("spread"))
    value = F.sqrt(F.try_divide(between, between + within))
    wanted = small_table(df.sparkSession, list(pairs), "col_i string, col_j string")
    ratios = groups.join(grand, PAIR).groupBy(*PAIR).agg(value.alias("value"))
    return ratios.join(wanted, PAIR, "left_semi")


def association_matrix(df: DataFrame, exclude: Sequence[str] = ("Township", S.ID)) -> DataFrame:
    """(col_i, col_j, measure, value): symmetric, with ones on the diagonal."""
    columns = [c for c in df.columns if c not in exclude]
    numbers = [c for c in columns if S.is_numeric(df.schema[c].dataType)]
    texts = [c for c in columns if c not in numbers]
    measured: list[tuple[DataFrame, str]] = []
    if len(numbers) > 1:
        measured.append((_pearson_pairs(df, list(combinations(numbers, 2))), "pearson"))
    if len(texts) > 1:
        measured.append((cramers_v(df, list(combinations(texts, 2))), "cramers_v"))
    if texts and numbers:
        measured.append((correlation_ratio(df, list(product(texts, numbers))), "correlation_ratio"))

    matrix = small_table(df.sparkSession, [(c, c, "identity", 1.0) for c in columns], "col_i string, col_j string, measure string, value double"
    )
    for upper, name in measured:
        labelled = upper.select(*PAIR, F.lit(name).alias("measure"), "value")
        matrix = matrix.unionByName(mirror(labelled))
    return matrix


def association_wide(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix as one row and one column per table column."""
    return matrix.groupBy("col_i").pivot("col_j", list(columns)).agg(F.first("value"))
