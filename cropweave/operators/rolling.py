"""Trailing sums over the last n rows of a region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.operators.ordinals import with_ordinals

RAIN_WINDOWS = {"RP7": 7, "RP15": 15, "RP30": 30}
BUCKET_ROWS = 100_000


def trailing_sums(
    df: DataFrame,
    value: str = "precip",
    windows: Mapping[str, int] = RAIN_WINDOWS,
    keys: Sequence[str] = schemas.REGION_KEYS,
    order: str | Sequence[str] = "Date",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Sum of the last n rows; NULL until n non-missing values are in the window.

    ``order`` is one column or several; rows that tie in all of them are taken in one
    settled order. Null keys are a region of their own. A region is never windowed as a
    whole: all rows are numbered by keys and order, numbers are cut into buckets of
    ``bucket_rows``, and the last ``max(n)-1`` rows of a bucket are copied into the next
    one, which is all that a window there can reach. A region with most of the rows is
    spread over as many buckets as it needs, and the result does not depend on the cuts.
    """
    order = [order] if isinstance(order, str) else list(order)
    reach = max(windows.values()) - 1
    size = max(bucket_rows, reach, 1)
    ordinal = F.col("_ordinal")
    bucket = F.floor(ordinal / size)
    numbered = with_ordinals(df, [*keys, *order])
    buckets = F.when(
        F.pmod(ordinal, F.lit(size)) >= size - reach, F.array(bucket, bucket + 1)
    ).otherwise(F.array(bucket))
    placed = numbered.withColumn("_bucket", F.explode(buckets))
    in_bucket = W.partitionBy(*keys, "_bucket").orderBy("_ordinal")
    sums = {}
    for name, n in windows.items():
        frame = in_bucket.rowsBetween(-(n - 1), 0)
        sums[name] = F.when(F.count(value).over(frame) == n, F.sum(value).over(frame))
    return (
        placed.withColumns(sums)
        .filter(F.col("_bucket") == bucket)
        .drop("_ordinal", "_bucket")
    )
