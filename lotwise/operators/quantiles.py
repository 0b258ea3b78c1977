"""Exact order statistics and quantiles of any number of rows, per column and group.

``percentile`` keeps a map of all distinct values of a group in one task, so it
cannot serve a column of a trillion prices. Here each pass only counts:

1. count the rows of every logarithmic cell (partial counts are combined before
   the shuffle; the number of cells does not depend on the data) and find the
   few cells that hold a wanted rank;
2. if such a cell holds more than one value between its ends, scan again, keep
   only the rows of those cells, and count them in a finer linear grid;
3. order the distinct values of the one fine cell that holds the rank.

Every step is a hash aggregation over (group, cell), so a group with a third of
all rows is spread over many tasks.

The route is the same for every size of input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.numeric import interpolate, log_cell, nan_as_null
from lotwise.sources.staging import stage

FINE_CELLS = 65536


def melt_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row (by..., column, value) per non-null number."""
    keys = [F.col(c) for c in by]
    if len(columns) == 1:
        value = nan_as_null(F.col(columns[0])).alias("value")
        long = df.select(*keys, F.lit(columns[0]).alias("column"), value)
    else:
        numbers = df.select(*keys, *[nan_as_null(F.col(c)).alias(f"_v_{c}") for c in columns])
        long = numbers.unpivot(list(by), [f"_v_{c}" for c in columns], "column", "value")
        long = long.select(*keys, F.substring("column", 4, 2**31 - 1).alias("column"), "value")
    return long.where(F.col("value").isNotNull())


def _count_cells(points: DataFrame, keys: list[str], cell: Column) -> DataFrame:
    """Rows, value range and number of preceding rows of every cell of a group."""
    cells = points.withColumn("_cell", cell).groupBy(*keys, "_cell").agg(
        F.sum("_n").alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi")
    )
    running = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))


def _ranks_inside(ranks: Column, before: Column, n: Column) -> Column:
    return F.filter(ranks, lambda r: (r >= before) & (r < before + n))


def _known(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Ranks whose value follows from the ends of their cell."""
    last = F.col("_before") + F.col("_n") - 1
    value = F.when((F.col("_rank") == F.col("_before")) | (F.col("_lo") == F.col("_hi")), F.col("_lo")).when(
        F.col("_rank") == last, F.col("_hi")
    )
    exploded = cells.withColumn("_rank", F.explode("_ranks"))
    return exploded.select(*keys, "_rank", value.alias("value")).where(F.col("value").isNotNull())


def _open(cells: DataFrame) -> DataFrame:
    """Cells with a wanted rank strictly between two different ends."""
    inner = F.filter(
        "_ranks", lambda r: (r > F.col("_before")) & (r < F.col("_before") + F.col("_n") - 1)
    )
    return (
        cells.where(F.col("_lo") < F.col("_hi")).withColumn("_ranks", inner).where(F.size("_ranks") > 0)
    )


def order_statistics(
    points: DataFrame, keys: Sequence[str], with_ranks: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(keys..., _rank, value): the values at 0-based ranks of the ascending order.

    ``points`` has the columns keys... and value. ``with_ranks`` receives a
    frame with keys... and ``_total`` and adds ``_ranks``, the wanted ranks.
    """
    keys = list(keys)
    points = points.select(*keys, "value")
    whole = Window.partitionBy(*keys)
    coarse = _count_cells(points.withColumn("_n", F.lit(1)), keys, log_cell(F.col("value")))
    coarse = with_ranks(coarse.withColumn("_total", F.sum("_n").over(whole)))
    coarse = coarse.withColumn("_ranks", _ranks_inside(F.col("_ranks"), F.col("_before"), F.col("_n")))
    coarse = stage(
        coarse.where(F.size("_ranks") > 0).select(*keys, "_cell", "_n", "_lo", "_hi", "_before", "_ranks")
    )
    found = _known(coarse, keys)
    open_coarse = _open(coarse)
    if open_coarse.isEmpty():
        return found

    parents = open_coarse.select(
        *[F.col(k).alias(f"_p_{k}") for k in keys],
        F.col("_cell").alias("_coarse"),
        F.col("_lo").alias("_from"),
        F.col("_hi").alias("_to"),
        F.col("_before").alias("_offset"),
        F.col("_ranks").alias("_wanted"),
    )
    matches = [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys]
    inside = (
        points.withColumn("_c", log_cell(F.col("value")))
        .join(parents, matches + [F.col("_c") == F.col("_coarse")])
        .groupBy(*keys, "_coarse", "value", "_from", "_to", "_offset", "_wanted")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    inside = stage(inside)
    sub_keys = [*keys, "_coarse", "_from", "_to", "_offset", "_wanted"]
    position = (F.col("value") - F.col("_from")) / (F.col("_to") - F.col("_from"))
    fine_cell = F.floor(position * FINE_CELLS).cast("int")
    fine = _count_cells(inside, sub_keys, fine_cell).withColumn("_before", F.col("_before") + F.col("_offset"))
    fine = fine.withColumn("_ranks", _ranks_inside(F.col("_wanted"), F.col("_before"), F.col("_n")))
    fine = stage(fine.where(F.size("_ranks") > 0).drop("_wanted"))
    found = found.unionByName(_known(fine, keys))
    open_fine = _open(fine)
    if open_fine.isEmpty():
        return found

    parents = open_fine.select(
        *[F.col(k).alias(f"_p_{k}") for k in keys],
        F.col("_coarse").alias("_p_coarse"),
        F.col("_cell").alias("_p_cell"),
        F.col("_before").alias("_start"),
        "_ranks",
    )
    matches.extend([F.col("_coarse") == F.col("_p_coarse"), fine_cell == F.col("_p_cell")])
    running = (
        Window.partitionBy(*keys, "_coarse", "_p_cell")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    last = inside.join(parents, matches).withColumn(
        "_before", F.col("_start") + F.sum("_n").over(running) - F.col("_n")
    )
    last = last.select(
        *keys,
        F.explode(_ranks_inside(F.col("_ranks"), F.col("_before"), F.col("_n"))).alias("_rank"),
        "value",
    )
    return found.unionByName(last)


def _quantile_ranks(probs: Sequence[float]) -> Callable[[DataFrame], DataFrame]:
    def add(df: DataFrame) -> DataFrame:
        last = F.col("_total") - 1
        ranks = []
        for p in probs:
            low = F.floor(last * F.lit(float(p)))
            ranks += [low, F.least(low + 1, last)]
        return df.withColumn("_ranks", F.array_distinct(F.array(*ranks)))

    return add


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """(by..., column, n, q): linearly interpolated quantiles, ``q`` aligned with ``probs``.

    NULL and NaN are left out; a group without numbers has no row.
    """
    keys = [*by, "column"]
    points = melt_numeric(df, columns, by)
    wanted = _quantile_ranks(probs)

    # Rank `total - 1` is asked for as well: it tells the number of rows.
    def with_last(cells: DataFrame) -> DataFrame:
        ranks = F.array_distinct(F.concat("_ranks", F.array(F.col("_total") - 1)))
        return wanted(cells).withColumn("_ranks", ranks)

    stats = order_statistics(points, keys, with_last)
    # At most two entries per probability and one for the count.
    by_rank = stats.groupBy(*keys).agg(
        F.map_from_entries(F.collect_set(F.struct("_rank", "value"))).alias("_values"),
        (F.max("_rank") + 1).alias("n"),
    )
    last = F.col("n") - 1
    quantiles = []
    for p in probs:
        position = last * F.lit(float(p))
        low = F.floor(position)
        quantiles.append(
            interpolate(
                F.col("_values")[low], F.col("_values")[F.least(low + 1, last)], position - low
            )
        )
    return by_rank.select(*keys, "n", F.array(*quantiles).alias("q"))


def approx_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """Same shape as :func:`exact_quantiles` from one pass of a mergeable sketch."""
    return (
        melt_numeric(df, columns, by)
        .groupBy(*by, "column")
        .agg(
            F.count("value").alias("n"),
            F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("q"),
        )
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    return (approx_quantiles if approx else exact_quantiles)(df, columns, probs, by)


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], approx: bool = False
) -> dict[str, list[float]]:
    """Quantiles of whole columns as plain numbers, one short list per column.

    Used as fitted parameters: a filter on literals reaches the Parquet scan.
    """
    rows = quantiles(df, columns, probs, approx=approx).collect()
    return {r["column"]: list(r["q"]) for r in rows}
