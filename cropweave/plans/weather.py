"""Weather features and the modelling data set."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cropweave import schemas
from cropweave.functions import calendar_columns, growing_degree_days, heat_stress
from cropweave.operators.grain import daily_state_means
from cropweave.operators.joins import attach_yields
from cropweave.operators.seasons import extend_to_year_end


def add_agronomy(df: DataFrame) -> DataFrame:
    return df.withColumns({"GDD": growing_degree_days(), "Heat_Stress": heat_stress()})


def process_weather(weather: DataFrame) -> DataFrame:
    """The county panel, extended to the end of its year, with degree days and stress."""
    return extend_to_year_end(weather).transform(add_agronomy)


def modeling_days(weather: DataFrame, yields: DataFrame) -> DataFrame:
    """One row per (Date, State): mean features, calendar columns, yield if known."""
    features = daily_state_means(
        process_weather(weather), [*schemas.MEASURES, "GDD", "Heat_Stress"]
    )
    dated = calendar_columns(features, "Year", "Month", "Day")
    labels = yields.select("Year", "State", schemas.LABEL)
    return attach_yields(dated, labels, ["Year", "State"], "left")
