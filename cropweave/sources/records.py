"""Expansion of keys into records by a user function."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def expand_records(
    keys: DataFrame,
    emit: Callable[[dict], Iterable[dict]],
    schema: T.StructType,
    partitions: int | None = None,
    batch_rows: int = 10_000,
) -> DataFrame:
    """Run ``emit`` for every key row on the executors and return its records.

    Records leave in Arrow batches of at most ``batch_rows`` rows, so a key with
    very many records does not have to fit in memory. Keys and records keep their
    declared types: whole numbers stay whole beside missing ones.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (record for batch in batches for key in batch.to_pylist() for record in emit(key))
        while chunk := list(islice(stream, batch_rows)):
            yield pa.RecordBatch.from_pylist(chunk, schema=arrow)

    spread = keys.repartition(partitions) if partitions else keys
    return spread.mapInArrow(run, schema)
