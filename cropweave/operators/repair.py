"""Gap filling and cleansing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import title_case, to_double
from cropweave.operators.grain import history_means
from cropweave.operators.reshape import feature_columns
from cropweave.operators.sets import stack


def fill_from_history(
    wide: DataFrame,
    year: int,
    features: Sequence[str] | None = None,
    keys: Sequence[str] = ("State",),
) -> DataFrame:
    """Missing features of one year take the mean of earlier years of the same key.

    The averages carry the year they are meant for, so the join itself leaves all
    other years alone. Values that are present never change.
    """
    chosen = list(features) if features is not None else feature_columns(wide)
    history = history_means(wide, chosen, year, keys).withColumnsRenamed(
        {name: f"_mean_{name}" for name in chosen}
    )
    matched = wide.join(history.withColumn("Year", F.lit(year)), [*keys, "Year"], "left")
    filled = [
        F.coalesce(F.col(name), F.col(f"_mean_{name}")).alias(name)
        if name in chosen
        else F.col(name)
        for name in wide.columns
    ]
    return matched.select(*filled)


def drop_missing_label(df: DataFrame, label: str = schemas.LABEL) -> DataFrame:
    return df.dropna(subset=[label])


def only_period(
    records: DataFrame, period: str = "YEAR", column: str = "reference_period_desc"
) -> DataFrame:
    return records.filter(F.col(column) == period)


def cleanse_yields(
    *parts: DataFrame, county: bool = False, period: str | None = None
) -> DataFrame:
    """Survey records to (Year, State[, County], yield).

    Years must be numbers; values that are not are dropped. Names are title case, so
    they meet the names of the weather panel. ``period`` keeps one reference period.
    """
    records = stack(*parts)
    if period is not None:
        records = only_period(records, period)
    names = ["State", "County"] if county else ["State"]
    renamed = records.withColumnsRenamed(schemas.SURVEY_RENAMES)
    typed = renamed.select(
        F.col("Year").cast("int").alias("Year"),
        *[title_case(name).alias(name) for name in names],
        to_double(schemas.LABEL).alias(schemas.LABEL),
    )
    return drop_missing_label(typed)
