"""Weekly sequence samples per state and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import sequence_length, step_width
from cropweave.operators.grain import daily_state_means, weekly_state_means
from cropweave.operators.seasons import (
    aligned_season_weeks,
    growing_season,
    renumber_weeks,
)


def season_weeks(
    days: DataFrame,
    features: Sequence[str] = schemas.SEQUENCE_FEATURES,
    label: str = schemas.LABEL,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Aligned weekly means by state: daily means first, then weeks, numbered 1..n."""
    measures = [name for name in (*features, label) if name != "Year"]
    season = growing_season(days, years=years).dropna(subset=["State"])
    states = daily_state_means(season.select("Date", "State", *measures), measures)
    weekly = weekly_state_means(aligned_season_weeks(states), measures)
    return renumber_weeks(weekly, ("Year", "State"))


def collect_sequences(
    weeks: DataFrame,
    features: Sequence[str] = schemas.SEQUENCE_FEATURES,
    label: str = schemas.LABEL,
) -> DataFrame:
    """One sample per (Year, State): steps in week order, label of the last week.

    A group is at most one season of weeks.
    """
    step = F.array(*[F.col(name).cast("double") for name in features])
    steps = F.array_sort(F.collect_list(F.struct("Week", step.alias("step"))))
    return weeks.groupBy("Year", "State").agg(
        F.transform(steps, lambda row: row["step"]).alias("features"),
        F.max_by(label, "Week").alias("target"),
    )


def sequence_samples(
    days: DataFrame,
    features: Sequence[str] = schemas.SEQUENCE_FEATURES,
    label: str = schemas.LABEL,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Sequence samples from the daily modelling table, of some ``years`` if asked."""
    return collect_sequences(season_weeks(days, features, label, years), features, label)


def sequence_shapes(samples: DataFrame) -> DataFrame:
    """How many samples have which number of steps and features."""
    return samples.groupBy(
        sequence_length("features").alias("timesteps"),
        step_width("features").alias("n_features"),
    ).agg(F.count(F.lit(1)).alias("samples"))


def require_sequences(samples: DataFrame) -> tuple[int, int]:
    """(timesteps, features) that all samples share; an error if none or several."""
    shapes = sequence_shapes(samples).take(2)
    if not shapes:
        raise ValueError("no sequence samples: the season holds no rows")
    if len(shapes) > 1:
        raise ValueError("sequence samples differ in length")
    return shapes[0]["timesteps"], shapes[0]["n_features"]


def pad_sequences(samples: DataFrame, timesteps: int, width: int) -> DataFrame:
    """All samples with exactly ``timesteps`` steps; missing ones come first, as steps of NULLs.

    A season that began late keeps its last week last. A longer sample is an error, as
    cutting it would lose weeks.
    """
    lacking = F.lit(timesteps) - F.size("features")
    nothing = F.array(*[F.lit(None).cast("double")] * width)
    padded = F.concat(F.array_repeat(nothing, lacking), "features")
    said = F.concat(F.lit(f"a sequence is longer than {timesteps} steps: "), F.size("features").cast("string"))
    longer = F.raise_error(said).cast("array<array<double>>")
    return samples.withColumn("features", F.when(lacking < 0, longer).otherwise(padded))
