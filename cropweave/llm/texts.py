"""Arrow batches of texts as byte arrays and bounded slices, shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes handled at a time inside a task; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


_HELD: dict[str, Callable[[], None]] = {}


def claim(owner: str, forget: Callable[[], None]) -> None:
    """Let one operator at a time keep what its tasks remember in a reused worker.

    Called by a task that fills a cache; what another operator has left there is forgotten.
    """
    for name in [x for x in _HELD if x != owner]:
        _HELD.pop(name)()
    if owner not in _HELD:
        _HELD[owner] = forget
        gc.collect()


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offset of every row; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if places is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    start, stop = int(offsets[0]), int(offsets[-1])
    if data is None or start == stop:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, stop - start, start), offsets - start


def strings(column: pa.Array) -> list[str]:
    """The texts of a column; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def sliced(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = byte_view(batch.column(column))[1]
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all pieces, one piece after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)


def kept_columns(docs: DataFrame, **kinds: str) -> DataFrame:
    """The named columns alone, cast to the given types; other columns don't matter."""
    return docs.select(*[docs[name].cast(kind).alias(name) for name, kind in kinds.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores behind it until no column of ``df`` has it."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    """A batch of the schema from lists, numpy arrays or Arrow arrays, in its order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    want = to_arrow_schema(schema)
    arrays = []
    for values, field in zip(columns, want, strict=True):
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=want)
