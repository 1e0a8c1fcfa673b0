"""Text helpers for region names and feature names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def title_case(value: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    Unlike ``initcap`` this also starts a word after an apostrophe or a digit.
    """
    pieces = F.split(_col(value), r"(?<=\P{L})")
    return F.array_join(F.transform(pieces, capitalize), "")


def capitalize(value: Column | str) -> Column:
    """Only the first letter in upper case."""
    text = _col(value)
    return F.concat(
        F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2)))
    )


def feature_name(measure: Column | str, period: Column | str, prefix: str = "") -> Column:
    """``tmax_7`` for months, ``tmax_W7`` with the prefix ``W``."""
    number = _col(period).cast("string")
    return F.concat_ws("_", _col(measure), F.concat(F.lit(prefix), number))


def feature_head(name: Column | str) -> Column:
    return F.substring_index(_col(name), "_", 1)
