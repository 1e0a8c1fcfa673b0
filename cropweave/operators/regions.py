"""Region dimension, crop calendar and polygon lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.sources.geojson import as_multi_polygons

# Fixed values: (crop, first month, last month); a season may wrap the year.
CROP_SEASONS = [
    ("HRW", 8, 7),
    ("SRW", 8, 7),
    ("HRS", 3, 10),
    ("corn", 10, 9),
]

# Fixed values: (country, crop, states that grow it).
CROP_STATES = [
    (
        "US",
        "HRW",
        [
            "Colorado", "Kansas", "Montana", "Nebraska", "Oklahoma", "South Dakota",
            "Texas",
        ],
    ),
    (
        "US",
        "SRW",
        [
            "Alabama", "Arkansas", "Georgia", "Illinois", "Indiana", "Kentucky",
            "Michigan", "Mississippi", "Missouri", "North Carolina", "Ohio",
            "South Carolina", "Tennessee", "Virginia",
        ],
    ),
    ("US", "HRS", ["Minnesota", "Montana", "North Dakota", "South Dakota"]),
    (
        "US",
        "corn",
        [
            "Illinois", "Indiana", "Iowa", "Minnesota", "Missouri", "Nebraska",
            "North Dakota", "Ohio", "South Dakota",
        ],
    ),
]


def crop_calendar(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CROP_SEASONS, schemas.CROP_CALENDAR)


def crop_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CROP_STATES, schemas.CROP_STATES)


def state_names(features: DataFrame) -> DataFrame:
    """(FIPS code, name) of every state feature."""
    return features.select(
        F.col("feature.properties.STATE").alias("State_FIPS"),
        F.col("feature.properties.NAME").alias("State_Name"),
    )


def build_regions(counties: DataFrame, states: DataFrame) -> DataFrame:
    """County features with the name of their state added to the properties.

    A county whose state is unknown stays, with a missing name.
    """
    names = state_names(states)
    counties = as_multi_polygons(counties)
    code = F.col("feature.properties.STATE")
    enriched = F.col("feature").withField("properties.State_Name", F.col("State_Name"))
    return counties.join(names, code == F.col("State_FIPS"), "left").select(
        enriched.alias("feature")
    )


def region_table(regions: DataFrame) -> DataFrame:
    """(State, County, Coordinates) of the enriched features; coordinates are multi-polygons."""
    return regions.select(
        F.col("feature.properties.State_Name").alias("State"),
        F.col("feature.properties.NAME").alias("County"),
        F.col("feature.geometry.coordinates").alias("Coordinates"),
    )


def in_crop_states(
    table: DataFrame, states_by_crop: DataFrame, crop: str
) -> DataFrame:
    """Regions of the states that grow one crop."""
    states = states_by_crop.filter(F.col("crop") == crop).select(
        F.explode("states").alias("State")
    )
    return table.join(states.distinct(), "State", "left_semi")


def expand_crop_regions(
    table: DataFrame, states_by_crop: DataFrame, calendar: DataFrame
) -> DataFrame:
    """One row per (country, state, county, crop) with the crop's season."""
    grown = states_by_crop.select("country", "crop", F.explode("states").alias("State"))
    return (
        grown.join(calendar, "crop")
        .join(table.select("State", "County"), "State")
        .select("country", "State", "County", "crop", "month_start", "month_end")
    )


def lookup_polygons(
    pairs: DataFrame, table: DataFrame, on_missing: str = "error"
) -> DataFrame:
    """Coordinates and number of rings for (State, County) pairs, all in one join.

    A pair without a polygon fails the job, or keeps NULLs with
    ``on_missing='null'``; so does a region whose geometry was lost.
    """
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing is 'error' or 'null'")
    joined = pairs.join(table, ["State", "County"], "left")
    whole = F.col("Coordinates")
    rings: Column = F.when(whole.isNotNull(), F.size(F.flatten(whole)))
    if on_missing == "error":
        absent = F.concat_ws(", ", "State", "County")
        rings = F.when(
            whole.isNull(),
            F.raise_error(F.concat(F.lit("no polygon for "), absent)),
        ).otherwise(rings)
    return joined.select(*pairs.columns, "Coordinates", rings.alias("n_rings"))


def pairs_without_polygon(pairs: DataFrame, table: DataFrame) -> DataFrame:
    return pairs.join(table, ["State", "County"], "left_anti")
