"""Gridded cubes to rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_grid(
    cubes: DataFrame,
    keys: tuple[str, ...] = ("year",),
    value: str = "precip",
    base_date: dt.date | None = None,
    slice_partitions: int | None = None,
) -> DataFrame:
    """One row per cell of a (time x lat x lon) cube; a missing cell is 0.

    Time slices are separated first and dealt out anew before they are expanded to
    cells, so that one big cube does not stay in one task: into even partitions of the
    size that Spark aims at, or into ``slice_partitions``. With ``base_date`` the time value is also decoded as days since then.
    """
    slices = cubes.select(
        *keys, "lat", "lon", F.explode(F.arrays_zip("time", value)).alias("slice")
    )
    if slice_partitions:
        slices = slices.repartition(slice_partitions)
    else:
        slices = slices.hint("rebalance")
    rows = slices.select(
        *keys,
        "lon",
        F.col("slice.time").cast("int").alias("time_value"),
        F.posexplode(F.arrays_zip("lat", f"slice.{value}")).alias("_lat", "_row"),
    )
    cells = rows.select(
        *keys,
        "time_value",
        F.col("_row.lat").alias("lat"),
        F.explode(F.arrays_zip("lon", f"_row.{value}")).alias("_cell"),
    )
    flat = cells.select(
        *keys,
        "time_value",
        "lat",
        F.col("_cell.lon").alias("lon"),
        F.coalesce(
            F.nanvl(F.col(f"_cell.{value}"), F.lit(None)), F.lit(0.0)
        ).alias(value),
    )
    if base_date is not None:
        flat = flat.withColumn("Date", F.date_add(F.lit(base_date), F.col("time_value")))
    return flat
