"""Python work on Arrow batches of bounded bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SLICE_BYTES = 4 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(session: SparkSession) -> Iterator[None]:
    """Arrow batches of what is planned and run here have about ``SLICE_BYTES``, not Spark's 64 MB.

    Spark builds each whole outside its heap, in buffers that double as they fill, once per task.
    """
    before = session.conf.get(BATCH_BYTES)
    session.conf.set(BATCH_BYTES, str(SLICE_BYTES))
    try:
        yield
    finally:
        session.conf.set(BATCH_BYTES, before)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``most`` bytes of text; a row is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    first = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def map_slices(
    df: DataFrame,
    text: str,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: StructType | str,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """``work`` on every slice of ``df``, row order within a partition kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, most):
                yield work(part)

    return df.mapInArrow(run, schema)


def replaced(batch: pa.RecordBatch, values: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with the named columns replaced, or added at its end."""
    columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)} | values
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
