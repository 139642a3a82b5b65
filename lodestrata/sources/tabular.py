"""JSON, JSON lines and CSV."""

from __future__ import annotations

import csv
import io
import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.charset import decoded
from lodestrata.sources.frames import per_document
from lodestrata.sources.office import Refused

LARGEST_JSON = 16 * 1024 * 1024
CELLS = 100_000


def _pairs(pairs):
    seen = dict(pairs)
    if len(seen) != len(pairs):
        raise ValueError("duplicate_key")
    return seen


def _no_constant(_):
    raise ValueError("not_a_number")


def json_fault(text: str | None) -> str | None:
    """Why a text is no strict JSON: a key twice, NaN or infinity, or a syntax error."""
    if text is None:
        return "missing"
    try:
        json.loads(text.removeprefix("\ufeff"), object_pairs_hook=_pairs, parse_constant=_no_constant)
    except ValueError as x:
        return str(x) if str(x) in ("duplicate_key", "not_a_number") else "syntax"
    except RecursionError:
        return "too_deep"
    return None


@F.pandas_udf(T.StringType())
def json_faults(texts: pd.Series) -> pd.Series:
    return texts.map(json_fault)


def read_json(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """path and the typed columns of strict JSON files; any fault raises. The typed read alone would keep the last of two equal keys."""
    raw = spark.read.format("binaryFile").load(paths)
    if found := raw.where(F.col("length") > LARGEST_JSON).select("path").limit(1).collect():
        raise ValueError(f"{found[0].path}: too large")
    text = raw.select("path", F.regexp_replace(F.col("content").cast("string"), r"^\uFEFF", "").alias("text"))
    if found := text.select("path", json_faults("text").alias("fault")).where("fault is not null").limit(1).collect():
        raise ValueError(f"{found[0].path}: {found[0].fault}")
    return text.select("path", F.from_json("text", schema, {"mode": "FAILFAST"}).alias("x")).select("path", "x.*")


def history(spark: SparkSession, path: str, schema: str, key: str = "run_id") -> DataFrame:
    """A JSON-lines log; blank lines don't count, a key twice raises."""
    log = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if found := log.groupBy(key).count().where("count > 1").limit(1).collect():
        raise ValueError(f"{found[0][0]} is logged twice")
    return log


def csv_rows(raw: bytes | str, delimiter: str = ",", headers: str = "none", charset: str | None = None) -> list[tuple[str, str, str]]:
    """(locator, content_type, text): each record as a JSON array, or as named cells where the first row holds the headers.

    The locator names the physical lines that a record spans. All values stay
    strings; ragged and single-column tables are told, never padded.
    """
    text = (decoded(raw, charset) if isinstance(raw, bytes) else raw).removeprefix("\ufeff")
    if "\0" in text:
        raise Refused("holds_nul")
    reader = csv.reader(io.StringIO(text, newline=""), delimiter=delimiter, strict=True)
    rows, first, names, cells, before, widths = [], True, None, 0, 0, set()
    for record in reader:
        start, before = before + 1, reader.line_num
        at = f"/lines={start}-{before}" if before > start else f"/line={start}"
        cells += len(record)
        if cells > CELLS:
            raise ValueError("too_many_cells")
        if not record:
            if first and headers == "first-row":
                raise ValueError("empty_header_row")
            continue
        widths.add(len(record))
        if headers == "first-row":
            if first:
                names = record
                if len(set(names)) < len(names):
                    rows.append((at, "warning", "duplicate_header"))
                if not all(n.strip() for n in names):
                    rows.append((at, "warning", "empty_header"))
                rows.append((at, "table_header", json.dumps(names, ensure_ascii=False, separators=(",", ":"))))
            else:
                rows.append((at, "table_row", json.dumps([{"column": i + 1, "header": names[i] if i < len(names) else None, "value": v} for i, v in enumerate(record)], ensure_ascii=False, separators=(",", ":"))))
        else:
            rows.append((at, "table_row", json.dumps(record, ensure_ascii=False, separators=(",", ":"))))
        first = False
    if len(widths) > 1:
        rows.append(("/", "warning", "ragged_rows"))
    if widths == {1}:
        rows.append(("/", "warning", "single_column"))
    return rows


def read_csv(df: DataFrame, key: str, content: str, delimiter: str = ",", headers: str = "none", charset: str | None = None) -> DataFrame:
    return per_document(df, key, content, lambda raw: csv_rows(raw, delimiter, headers, charset), pa.binary())
