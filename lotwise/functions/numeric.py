"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells per e-fold of the logarithmic grid: a cell spans about 0.1% of its values.
CELLS_PER_EFOLD = 1024
# ln of the smallest positive double is -744.4, so the shifted logarithm is positive.
_LOG_SHIFT = 745.0


def log_cell(value: Column) -> Column:
    """Order-preserving cell number of any double but NaN.

    ln, product and floor never swap two values, so all values of a lower cell
    are below all values of a higher one. The number of cells is bounded by the
    range of doubles and does not depend on the data.
    """

    def magnitude(v: Column) -> Column:
        # The bound only concerns infinity, which gets a cell of its own.
        log = F.least(F.ln(v), F.lit(710.0))
        return (F.floor((log + _LOG_SHIFT) * CELLS_PER_EFOLD) + 1).cast("int")

    return (
        F.when(value > 0, magnitude(value))
        .when(value < 0, -magnitude(-value))
        .otherwise(F.lit(0))
    )


def nan_as_null(value: Column) -> Column:
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def corrected_skewness(value: Column) -> Column:
    """Bias-corrected sample skewness: NULL below 3 values, 0 for a constant."""
    n = F.count(value).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    spread = F.var_pop(value)
    return F.when(n >= 3, F.when(spread == 0, F.lit(0.0)).otherwise(F.skewness(value) * factor))


def interpolate(low: Column, high: Column, fraction: Column) -> Column:
    """Linear interpolation between two neighbouring order statistics."""
    return low + (high - low) * fraction
