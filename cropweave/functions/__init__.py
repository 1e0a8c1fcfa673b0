"""Column functions. All of them are plain Catalyst expressions, no Python UDFs."""

from cropweave.functions.agronomy import (
    growing_degree_days,
    heat_stress,
    mean_temperature,
    rain_shortfall,
    soil_moisture,
    squared,
    year_trend,
)
from cropweave.functions.dates import (
    calendar_columns,
    dates_after,
    in_months,
    last_day_of_year,
    month_ranges,
)
from cropweave.functions.nested import (
    flatten_steps,
    sequence_length,
    sequence_means,
    step_width,
)
from cropweave.functions.numeric import clip, guarded_corr, missing_to_null, to_double
from cropweave.functions.text import capitalize, feature_head, feature_name, title_case

__all__ = [
    "calendar_columns",
    "capitalize",
    "clip",
    "dates_after",
    "feature_head",
    "feature_name",
    "flatten_steps",
    "growing_degree_days",
    "guarded_corr",
    "heat_stress",
    "in_months",
    "last_day_of_year",
    "mean_temperature",
    "missing_to_null",
    "month_ranges",
    "rain_shortfall",
    "sequence_length",
    "sequence_means",
    "soil_moisture",
    "squared",
    "step_width",
    "title_case",
    "to_double",
    "year_trend",
]
