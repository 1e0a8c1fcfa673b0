"""Registration of queries and small helpers shared by all of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6
# Averages over 2^k rows often end exactly in a five behind the last digit kept.
# Adding this much moves them off the edge, so that both engines round alike.
NUDGE = 1e-10


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles: sums of doubles differ in the last digit between engines."""
    return df.select(
        *[
            F.round(F.col(field.name) + NUDGE, digits).alias(field.name)
            if isinstance(field.dataType, T.DoubleType)
            else F.col(field.name)
            for field in df.schema
        ]
    )


def quoted(name: str) -> str:
    return f'"{name}"'


def rounded_sql(value: str, digits: int = DIGITS) -> str:
    """The same rounding in SQL; adding zero removes a negative zero."""
    return f"ROUND({value} + {NUDGE}, {digits}) + 0e0"


def q(*names: str) -> str:
    """Quoted column list."""
    return ", ".join(f'"{name}"' for name in names)


def r(*names: str, digits: int = DIGITS) -> str:
    """Column list with doubles rounded."""
    return ", ".join(f"{rounded_sql(quoted(n), digits)} AS {quoted(n)}" for n in names)


def averages(names: Sequence[str]) -> str:
    return ", ".join(f'AVG("{name}") AS "{name}"' for name in names)
