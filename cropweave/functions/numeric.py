"""Numeric column helpers with explicit missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_to_null(value: Column | str) -> Column:
    """NaN becomes NULL, so that averages and comparisons skip it."""
    return F.nanvl(F.col(value) if isinstance(value, str) else value, F.lit(None))


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value while keeping NULL (``least``/``greatest`` alone would not)."""
    bounded = value
    if upper is not None:
        bounded = F.least(bounded, F.lit(float(upper)))
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(float(lower)))
    return F.when(value.isNotNull(), bounded)


def to_double(text: Column | str) -> Column:
    """Parse a number; anything unreadable is NULL instead of an error."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("double")


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL when a side is constant."""
    x_paired = F.when(y.isNotNull(), x)
    y_paired = F.when(x.isNotNull(), y)
    return F.try_divide(
        F.covar_pop(x, y), F.stddev_pop(x_paired) * F.stddev_pop(y_paired)
    )
