"""How adapters run on a frame: Arrow batches in, typed rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.batches import in_batches

SHAPE = "id long, ordinal int, locator string, content_type string, text string"
_ARROW = pa.schema([("id", pa.int64()), ("ordinal", pa.int32()), ("locator", pa.string()), ("content_type", pa.string()), ("text", pa.string())])


def per_document(df: DataFrame, key: str, content: str, read: Callable, kind: pa.DataType) -> DataFrame:
    """A row for each (locator, content_type, text) that read() finds in a document; a failure is one row of type `error` and nothing else of that document."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if raw is None:
                    continue
                try:
                    found = read(raw)
                except Exception as x:  # a document's fault is that document's row
                    found = [("/", "error", getattr(x, "code", type(x).__name__))]
                rows += [(i, n, *f) for n, f in enumerate(found)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

        return step

    return in_batches(df.select(F.col(key).cast("long").alias("id"), content), make, SHAPE)
