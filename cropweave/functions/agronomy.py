"""Agronomic column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropweave.functions.numeric import clip

# Degree-day base and cap (C), heat threshold (C), June rain below
# which a shortfall counts and its long-run normal, origin of the trend, and the
# assumed share planted by mid-May (percent).
GDD_BASE = 10.0
GDD_CAP = 30.0
HEAT_THRESHOLD = 32.0
SHORTFALL_THRESHOLD = 2.51
SHORTFALL_NORMAL = 4.33
TREND_ORIGIN = 2000
PLANTING_PROGRESS = 80.0


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def growing_degree_days(
    tmax: Column | str = "tmax",
    tmin: Column | str = "tmin",
    t_base: float = GDD_BASE,
    t_cap: float = GDD_CAP,
) -> Column:
    """Heat above ``t_base`` with the daily maximum capped; NULL if either is NULL."""
    mean = (clip(_col(tmax), upper=t_cap) + _col(tmin)) / F.lit(2.0)
    return clip(mean - F.lit(float(t_base)), lower=0.0)


def heat_stress(tmax: Column | str = "tmax", threshold: float = HEAT_THRESHOLD) -> Column:
    """1 above the threshold, otherwise 0; a missing maximum counts as 0."""
    return F.coalesce((_col(tmax) > F.lit(float(threshold))).cast("int"), F.lit(0))


def soil_moisture(upper: Column | str = "swvl1", lower: Column | str = "swvl2") -> Column:
    return F.lit(0.5) * (_col(upper) + _col(lower))


def mean_temperature(tmax: Column | str = "tmax", tmin: Column | str = "tmin") -> Column:
    return F.lit(0.5) * (_col(tmax) + _col(tmin))


def squared(value: Column | str) -> Column:
    return _col(value) * _col(value)


def rain_shortfall(
    precip: Column | str,
    threshold: float = SHORTFALL_THRESHOLD,
    normal: float = SHORTFALL_NORMAL,
) -> Column:
    """Distance to the normal in dry months; 0 in others and when rain is missing."""
    rain = _col(precip)
    return F.when(rain < F.lit(threshold), F.lit(normal) - rain).otherwise(F.lit(0.0))


def year_trend(year: Column | str = "Year", origin: int = TREND_ORIGIN) -> Column:
    return _col(year) - F.lit(origin)
