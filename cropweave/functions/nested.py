"""Higher-order functions over T x F sequences (array of step arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sequence_length(sequence: Column | str) -> Column:
    return F.size(_col(sequence))


def step_width(sequence: Column | str) -> Column:
    return F.size(F.try_element_at(_col(sequence), F.lit(1)))


def sequence_means(sequence: Column | str, width: int) -> Column:
    """Mean of every feature over the steps; NULL where any step is missing."""
    steps = _col(sequence)
    zeros = F.array(*[F.lit(0.0)] * width)
    totals = F.aggregate(
        steps,
        zeros,
        lambda total, step: F.zip_with(total, step, lambda a, b: a + b),
    )
    return F.transform(totals, lambda total: total / F.size(steps))


def flatten_steps(sequence: Column | str) -> Column:
    """One array of T*F values, step after step."""
    return F.flatten(_col(sequence))
