"""Orders, previews and top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_by_abs(
    df: DataFrame, value: str, label: str = "feature", k: int | None = None
) -> DataFrame:
    """Largest absolute values first; ties by label, missing values last."""
    return _ranked(df, F.abs(value).desc_nulls_last(), label, k)


def top_by(
    df: DataFrame, value: str, label: str = "feature", k: int | None = None
) -> DataFrame:
    """Largest signed values first."""
    return _ranked(df, F.col(value).desc_nulls_last(), label, k)


def _ranked(df: DataFrame, by: Column, label: str, k: int | None) -> DataFrame:
    ordered = df.orderBy(by, label)
    return ordered.limit(k) if k is not None else ordered


def preview(df: DataFrame, *keys: str, n: int = 5, last: bool = False) -> DataFrame:
    """First (or last) ``n`` rows in key order."""
    order = [F.col(key).desc() if last else F.col(key).asc() for key in keys]
    return df.orderBy(*order).limit(n)


def leading_names(ranked: DataFrame, label: str = "feature") -> list[str]:
    """Names of a top-k report, for building a column list on the driver."""
    return [row[label] for row in ranked.select(label).collect()]
