"""Declared schemas and canonical column names for every input the library reads."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw measurement columns as they arrive, and the names used everywhere else.
WEATHER_RENAMES = {"date": "Date", "adm1_name": "State", "adm2_name": "County"}
SURVEY_RENAMES = {
    "year": "Year",
    "state_name": "State",
    "county_name": "County",
    "Value": "Yield_bu_acre",
}

# Names and numbers that the data sets and results must have.
REGION_KEYS = ("State", "County")
MEASURES = ("tmax", "tmin", "precip", "swvl1", "swvl2")
MONTHLY_MEASURES = (*MEASURES, "GDD")
SEQUENCE_FEATURES = (*MEASURES, "GDD", "Heat_Stress", "Year")
LABEL = "Yield_bu_acre"

SEASON_START_MONTH = 4
SEASON_END_MONTH = 11
SEASON_WEEKS = 31

WEATHER = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("adm1_name", T.StringType()),
        T.StructField("adm2_name", T.StringType()),
        T.StructField("aoi_id", T.StringType()),
        *(T.StructField(name, T.DoubleType()) for name in MEASURES),
    ]
)

SURVEY_RECORD = T.StructType(
    [
        T.StructField("year", T.StringType()),
        T.StructField("state_name", T.StringType()),
        T.StructField("county_name", T.StringType()),
        T.StructField("Value", T.StringType()),
        T.StructField("reference_period_desc", T.StringType()),
    ]
)
SURVEY_PAYLOAD = T.StructType([T.StructField("data", T.ArrayType(SURVEY_RECORD))])

RING = T.ArrayType(T.ArrayType(T.DoubleType()))
POLYGON = T.ArrayType(RING)
MULTI_POLYGON = T.ArrayType(POLYGON)


def _feature(properties: list[str], coordinates: T.DataType) -> T.StructType:
    fields = [
        T.StructField(
            name, T.DoubleType() if name == "CENSUSAREA" else T.StringType()
        )
        for name in properties
    ]
    return T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("id", T.StringType()),
            T.StructField(
                "geometry",
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("coordinates", coordinates),
                    ]
                ),
            ),
            T.StructField("properties", T.StructType(fields)),
        ]
    )


# Property names of the county collections.
COUNTY_PROPERTIES = ["CENSUSAREA", "COUNTY", "GEO_ID", "LSAD", "NAME", "STATE"]


def feature_collection(
    extra_properties: tuple[str, ...] = (), coordinates: T.DataType | None = None
) -> T.StructType:
    """Schema of one collection document.

    ``coordinates`` is JSON text unless a type is given: polygons and multi-polygons nest
    differently and come mixed.
    """
    feature = _feature(
        [*COUNTY_PROPERTIES, *extra_properties], coordinates or T.StringType()
    )
    return T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("features", T.ArrayType(feature)),
        ]
    )


GRID_CUBE = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("time", T.ArrayType(T.DoubleType())),
        T.StructField("lat", T.ArrayType(T.DoubleType())),
        T.StructField("lon", T.ArrayType(T.DoubleType())),
        T.StructField(
            "precip", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
        ),
    ]
)

CROP_CALENDAR = T.StructType(
    [
        T.StructField("crop", T.StringType()),
        T.StructField("month_start", T.IntegerType()),
        T.StructField("month_end", T.IntegerType()),
    ]
)
CROP_STATES = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("crop", T.StringType()),
        T.StructField("states", T.ArrayType(T.StringType())),
    ]
)
