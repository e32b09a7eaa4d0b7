"""Batch helpers shared by the operators: whole texts, in slices of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 2 << 20
#: Between the JVM and Python, so that a batch of long texts stays small.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows whose ``column`` holds about ``size`` bytes (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + 64)
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


_AT_END: list[Callable[[], None]] = []


def at_task_end(fn: Callable[[], None]) -> Callable[[], None]:
    """Has ``fn`` called when a task ends, to drop what a module keeps."""
    _AT_END.append(fn)
    return fn


def release() -> None:
    """Gives freed memory back at the end of a task; Spark keeps the worker process for other stages."""
    for fn in _AT_END:
        fn()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def map_texts(df: DataFrame, columns: dict[str, Column | str], schema: str | StructType,
              fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], text: str = "text",
              size: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over only the named columns, with ``fn`` fed slices bounded by bytes of ``text``.

    Sets the session's Arrow batch size, by rows and bytes.
    """
    for k, v in BATCH_CONF.items():
        df.sparkSession.conf.set(k, v)
    narrow = df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(k) for k, c in columns.items()])

    def run(batches):
        yield from fn(slices(batches, text, size))
        release()

    return narrow.mapInArrow(run, schema)


def list_column(values: np.ndarray, ends: list[int] | np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array of ``values`` cut at ``ends`` (cumulative counts, without the leading 0)."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns(df: DataFrame, keep: list[str], text_col: str, fields: list[StructField],
                 fn: Callable[[list[str | None]], list[pa.Array]]) -> DataFrame:
    """``keep`` columns of ``df`` (types unchanged) and new columns that ``fn`` makes from each slice's whole texts."""
    names = {f"k{i}": F.col(f"`{c}`") for i, c in enumerate(keep)} | {"text": F.col(f"`{text_col}`")}
    schema = StructType([StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)] + fields)
    out = [f.name for f in schema]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], *fn(b.column("text").to_pylist())], out)

    made = map_texts(df, names, schema, run)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[f.name for f in fields])
