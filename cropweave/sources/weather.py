"""Daily weather scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave import schemas
from cropweave.functions import in_months, missing_to_null, month_ranges


def read_weather(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType = schemas.WEATHER,
    on_missing: str = "error",
    months: tuple[int, int] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Read the panel with canonical names.

    ``columns`` names raw columns to keep. ``on_missing='empty'`` gives an empty
    frame of the same schema when the path does not exist. ``months`` keeps those
    months; with ``years`` the test becomes date ranges, which reach the Parquet
    reader.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError("on_missing is 'error' or 'empty'")
    try:
        raw = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if on_missing == "error" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], schema)
    if columns is not None:
        raw = raw.select(*columns)
    if months is not None:
        date = F.col("date")
        raw = raw.filter(
            month_ranges(date, *months, years) if years else in_months(date, *months)
        )
    return canonical_weather(raw)


def canonical_weather(raw: DataFrame) -> DataFrame:
    """Canonical names, a ``DATE`` date, and NULL as the only missing marker."""
    floats = [
        field.name
        for field in raw.schema
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
    ]
    renamed = raw.withColumnsRenamed(schemas.WEATHER_RENAMES)
    changes = {name: missing_to_null(name) for name in floats}
    if "Date" in renamed.columns:
        changes["Date"] = F.to_date("Date")
    return renamed.withColumns(changes)
