"""The tables behind the charts: histograms, density curves, box statistics, scatters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.numeric import nan_as_null
from lotwise.operators.quantiles import exact_quantiles, quantile_values
from lotwise.sources.staging import small_table, stage

RAW_BINS = 30
TARGET_BINS = 40
CLEAN_BINS = 50
CURVE_POINTS = 200
# exp(-z²/2) is 0 in double precision beyond this many bandwidths.
KERNEL_REACH = 38.7


def _value(column: str, log: bool) -> Column:
    value = nan_as_null(F.col(column))
    return F.log1p(value) if log else value


class View(NamedTuple):
    """One histogram and its curve: a column, its number of bins, and whether log1p is taken first."""

    name: str
    column: str
    bins: int = RAW_BINS
    log: bool = False


class Extent(NamedTuple):
    """Count, ends and sample standard deviation of the values of a view."""

    n: int
    low: float
    high: float
    std: float | None


def view_extents(df: DataFrame, views: Sequence[View]) -> dict[str, Extent]:
    """The extents of all views from one aggregation; views without values are left out."""
    if len({v.name for v in views}) < len(views):
        raise ValueError("views need different names")
    if not views:
        return {}
    row = df.agg(
        *[
            F.struct(F.count(x), F.min(x), F.max(x), F.stddev_samp(x)).alias(f"v{i}")
            for i, x in enumerate(_value(v.column, v.log) for v in views)
        ]
    ).first()
    return {v.name: Extent(*found) for v, found in zip(views, row) if found[0]}


def _edges(extent: Extent, bins: int) -> tuple[float, float]:
    """Lower end and width of the bins; a constant gets bins around it."""
    low, high = (extent.low - 0.5, extent.high + 0.5) if extent.low == extent.high else (extent.low, extent.high)
    return low, (high - low) / bins


def _cells(view: View, extent: Extent, place: int, points: int | None) -> list[Column]:
    """What a row adds to a view, to the cells from ``first`` to ``last``: one to its bin, or its kernel to grid points if ``points`` is given."""
    v = _value(view.column, view.log)

    def entry(is_curve: bool, low: float, step: float, bandwidth: float, first: Column, last: Column) -> Column:
        numbers = [F.lit(low).alias("low"), F.lit(step).alias("step"), F.lit(bandwidth).alias("bandwidth")]
        ends = [first.cast("int").alias("first"), last.cast("int").alias("last")]
        return F.struct(F.lit(place).alias("place"), F.lit(is_curve).alias("is_curve"), v.cast("double").alias("v"), *numbers, *ends)

    if points is None:
        low, width = _edges(extent, view.bins)
        index = F.least(F.floor((v - F.lit(low)) / F.lit(width)), F.lit(view.bins - 1))
        return [entry(False, low, width, 1.0, index, index)]
    if not extent.std:
        return []
    bandwidth = extent.std * extent.n ** (-0.2)
    step = (extent.high - extent.low) / (points - 1)
    reach = KERNEL_REACH * bandwidth
    first = F.greatest(F.ceil((v - (extent.low + reach)) / step), F.lit(0))
    last = F.least(F.floor((v - (extent.low - reach)) / step), F.lit(points - 1))
    return [entry(True, extent.low, step, bandwidth, first, last)]


def _sums(df: DataFrame, entries: list[Column]) -> DataFrame:
    """(place, is_curve, cell, n, s) of the cells that rows add to: one scan, one row per cell out of a task."""
    if not entries:
        return small_table(df.sparkSession, [], "place int, is_curve boolean, cell int, n bigint, s double")
    long = df.select(F.inline(F.array(*entries))).where("v is not null and first <= last")
    long = long.select("place", "is_curve", "v", "low", "step", "bandwidth", F.explode(F.sequence("first", "last")).alias("cell"))
    z = (F.col("low") + F.col("cell") * F.col("step") - F.col("v")) / F.col("bandwidth")
    kernel = F.when(F.col("is_curve"), F.exp(z * z * -0.5))
    return long.groupBy("place", "is_curve", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum(kernel).alias("s"))


def _bins_of(df: DataFrame, views: Sequence[View], extents: dict[str, Extent], sums: DataFrame) -> DataFrame:
    rows = []
    for place, view in enumerate(views):
        if view.name in extents:
            low, width = _edges(extents[view.name], view.bins)
            rows += [(place, i, view.name, low + i * width, low + (i + 1) * width) for i in range(view.bins)]
    grid = small_table(df.sparkSession, rows, "place int, cell int, chart string, low double, high double")
    counts = sums.where("not is_curve").select("place", "cell", "n")
    return grid.join(counts, ["place", "cell"], "left").select(
        "chart", F.col("cell").alias("bin"), "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def _curves_of(
    df: DataFrame, views: Sequence[View], extents: dict[str, Extent], sums: DataFrame, points: int
) -> DataFrame:
    rows = []
    for place, view in enumerate(views):
        extent = extents.get(view.name)
        if extent and extent.std:
            step = (extent.high - extent.low) / (points - 1)
            unit = extent.n * (extent.std * extent.n ** (-0.2)) * 2.5066282746310002  # sqrt(2 pi)
            scale = extent.n * (extent.high - extent.low) / view.bins
            rows += [(place, i, view.name, extent.low + i * step, unit, scale) for i in range(points)]
    grid = small_table(df.sparkSession, rows, "place int, cell int, chart string, x double, unit double, scale double")
    kernels = sums.where("is_curve").select("place", "cell", "s")
    density = F.coalesce("s", F.lit(0.0)) / F.col("unit")
    return grid.join(kernels, ["place", "cell"], "left").select(
        "chart", F.col("cell").alias("point"), "x", density.alias("density"), (density * F.col("scale")).alias("height")
    )


def _entries(views: Sequence[View], extents: dict[str, Extent], points: int | None) -> list[Column]:
    return [e for i, v in enumerate(views) if v.name in extents for e in _cells(v, extents[v.name], i, points)]


def histograms(df: DataFrame, views: Sequence[View], extents: dict[str, Extent] | None = None) -> DataFrame:
    """(chart, bin, low, high, n) of all views in two scans: the extents, then the rows of every bin."""
    extents = view_extents(df, views) if extents is None else extents
    return _bins_of(df, views, extents, _sums(df, _entries(views, extents, None)))


def kde_curves(
    df: DataFrame, views: Sequence[View], extents: dict[str, Extent] | None = None, points: int = CURVE_POINTS
) -> DataFrame:
    """(chart, point, x, density, height) of all views in two scans: Gaussian density with Scott's bandwidth.

    A value adds only to the grid points its kernel reaches, and the partial sums leave each task as one row per
    grid point. ``height`` has the scale of a histogram with the bins of the view. A view of fewer than two
    different values has no curve.
    """
    extents = view_extents(df, views) if extents is None else extents
    return _curves_of(df, views, extents, _sums(df, _entries(views, extents, points)), points)


def histograms_and_curves(df: DataFrame, views: Sequence[View], points: int = CURVE_POINTS) -> tuple[DataFrame, DataFrame]:
    """Both tables from the same two scans; the sums, a few rows for each view, are staged."""
    extents = view_extents(df, views)
    sums = stage(_sums(df, _entries(views, extents, None) + _entries(views, extents, points)))
    return _bins_of(df, views, extents, sums), _curves_of(df, views, extents, sums, points)


def histogram(df: DataFrame, column: str, bins: int = RAW_BINS, log: bool = False) -> DataFrame:
    """(bin, low, high, n) of equal-width bins from the smallest to the largest value, empty ones too."""
    return histograms(df, [View(column, column, bins, log)]).drop("chart")


def kde_curve(
    df: DataFrame, column: str, bins: int = RAW_BINS, log: bool = False, points: int = CURVE_POINTS
) -> DataFrame:
    """(point, x, density, height) of one column, see :func:`kde_curves`."""
    return kde_curves(df, [View(column, column, bins, log)], points=points).drop("chart")


_BOX = ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]


def _box(value: Column, q1: Column, q3: Column) -> list[Column]:
    """Whiskers end at the furthest value inside the fences, never inside the box."""
    reach = (q3 - q1) * 1.5
    inside = F.when(value.between(q1 - reach, q3 + reach), value)
    return [
        F.count(value).alias("n"),
        F.min(inside).alias("_in_low"),
        F.max(inside).alias("_in_high"),
        (F.count(value) - F.count(inside)).alias("outliers"),
    ]


def _box_columns() -> list[Column]:
    low = F.least("q1", "_in_low").alias("whisker_low")
    high = F.greatest("q3", "_in_high").alias("whisker_high")
    return [F.col("n"), F.col("q1"), F.col("median"), F.col("q3"), low, high, F.col("outliers")]


def box_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n, q1, median, q3, whisker_low, whisker_high, outliers) of whole columns."""
    columns = list(columns or S.numeric_columns(df.schema))
    quarters = quantile_values(df, columns, [0.25, 0.5, 0.75])
    columns = [c for c in columns if c in quarters]
    row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[F.lit(q).alias(name) for q, name in zip(quarters[c], ("q1", "median", "q3"))],
                *_box(nan_as_null(F.col(c)), F.lit(quarters[c][0]), F.lit(quarters[c][2])),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return row.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))]))).select(
        "column", *_box_columns()
    )


def box_stats_by_group(df: DataFrame, by: str, column: str = S.TARGET, log: bool = False) -> DataFrame:
    """Box statistics per group; ``position`` orders the groups by the median of the raw values."""
    known = df.where(F.col(by).isNotNull()).select(
        F.col(by).alias("category"), F.col(column).alias("raw"), _value(column, log).alias("value")
    )
    wanted = ["raw", "value"] if log else ["value"]
    found = stage(exact_quantiles(known, wanted, [0.25, 0.5, 0.75], by=["category"]))
    quarters = found.where(F.col("column") == "value").select(
        "category", *[F.col("q")[i].alias(s) for i, s in enumerate(("q1", "median", "q3"))]
    )
    medians = found.where(F.col("column") == wanted[0]).select("category", F.col("q")[1].alias("m"))
    ranked = ordered_index(medians, ["m", "category"]).select(
        "category", (F.col("index") + 1).cast("int").alias("position")
    )
    boxes = known.join(quarters, "category").groupBy("category", "q1", "median", "q3").agg(
        *_box(F.col("value"), F.col("q1"), F.col("q3"))
    )
    return boxes.join(ranked, "category").select("category", "position", *_box_columns())


def ordered_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Adds the 0-based position of each row in a global order of unique keys.

    Range-partitioned and sorted once, then staged so that positions inside a
    partition and the partition's offset describe the same layout. Ties in the
    leading column are split by the following ones, so a value that a third of
    the rows share spreads over many partitions.
    """
    row = F.monotonically_increasing_id()
    ranged = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", row)
    )
    # The identifier holds the partition above bit 33 and the position below it.
    part = F.shiftright("_row", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_row").bitwiseAND((1 << 33) - 1) + F.col("_offset")
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, position.alias(name))
    )


def price_trend(df: DataFrame, actual: str = "actual", predicted: str = "predicted", key: str = S.ID) -> DataFrame:
    """Actual and predicted values along the order of the actual ones."""
    return ordered_index(df.select(key, actual, predicted), [actual, key])


def scatter_points(df: DataFrame, x: str = S.TX, y: str = S.TARGET) -> DataFrame:
    """All points of a scatter chart with the logarithm of y."""
    keys = [S.ID] if S.ID in df.columns else []
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.select(*keys, F.col(x).alias("x"), F.col(y).alias("y"), F.log1p(y).alias("log_y"))


def scatter_grid(df: DataFrame, x: str = S.TX, y: str = S.TARGET, bins: int = 50) -> DataFrame:
    """Counts on a square grid: the scatter chart of more points than a chart can show."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    x0, x1, y0, y1 = known.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if x0 is None:
        return small_table(df.sparkSession, [], "x_bin int, y_bin int, n bigint")

    def cell(column: str, low: float, high: float) -> Column:
        width = (high - low) / bins or 1.0
        return F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")

    return known.groupBy(cell(x, x0, x1).alias("x_bin"), cell(y, y0, y1).alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
