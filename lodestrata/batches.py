"""How Python runs on a frame: Arrow batches of bounded rows and bytes."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestrata.session import workers_import

#: Rows and bytes in an Arrow batch: bound what a Python worker holds also when all texts are long.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: After so many bytes of batches a Python worker gives freed memory back.
RELEASE_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers of this session find the package and get batches of bounded rows and bytes."""
    workers_import(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def in_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema, ends: bool = False, release: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow with small batches. make() runs once in a task and returns what each batch goes through, and None at the partition's end if it `ends`."""
    small_batches(df.sparkSession)
    give = release or released

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            step, size = make(), 0
            for batch in batches:
                size += batch.nbytes
                yield from step(batch)
                if size > RELEASE_BYTES:
                    size = 0
                    batch = None
                    give()
            if ends:
                yield from step(None)
        finally:
            step = None
            give()

    return df.mapInArrow(run, schema)


def released() -> None:
    """Give freed memory back to the system: workers are used again by later stages, with the same executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system has it
        ctypes.CDLL(None).malloc_trim(0)
