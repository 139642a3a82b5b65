"""Dispatch of documents to adapters, and the text that their blocks make up."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.identity import segment_id
from lodestrata.functions.text import LINE_ENDS
from lodestrata.sources.charset import html_text
from lodestrata.sources.frames import SHAPE, _ARROW
from lodestrata.sources.html import read_html
from lodestrata.sources.images import read_png, read_svg
from lodestrata.sources.mail import read_eml
from lodestrata.sources.office import Refused, Row, read_docx, read_pptx, read_xlsx
from lodestrata.sources.tabular import csv_rows

LARGEST, CHARACTERS, SEGMENTS = 25 * 1024 * 1024, 2_000_000, 50_000


def _pdf(raw: bytes) -> list[Row]:
    try:
        import io

        import pypdf
    except ImportError:
        raise Refused("missing_dependency") from None
    return [(f"/page={n}", "page_text", t) for n, page in enumerate(pypdf.PdfReader(io.BytesIO(raw)).pages, 1) if (t := page.extract_text().strip())]


READERS: dict[str, Callable[[bytes], list[Row]]] = {
    ".html": lambda raw: read_html(html_text(raw)),
    ".csv": csv_rows,
    ".eml": read_eml,
    ".xlsx": read_xlsx,
    ".docx": read_docx,
    ".pptx": read_pptx,
    ".svg": read_svg,
    ".png": read_png,
    ".pdf": _pdf,
}


def extract(raw: bytes, name: str) -> list[Row]:
    """All blocks of a document or one error: a failure leaves nothing else."""
    reader = READERS.get("." + name.rpartition(".")[2].lower())
    try:
        if reader is None:
            raise Refused("unsupported_format")
        if len(raw) > LARGEST:
            raise Refused("input_too_large")
        rows = reader(raw)
        if len(rows) > SEGMENTS or sum(len(t) for _, _, t in rows) > CHARACTERS:
            raise Refused("output_too_large")
        return rows
    except Refused as x:
        return [("/", "error", x.code)]
    except Exception as x:  # a parser's fault is the document's
        return [("/", "error", f"unreadable_{type(x).__name__}")]


def extracted(files: DataFrame, key: str = "id", path: str = "relative_path", content: str = "content") -> DataFrame:
    """id, ordinal, locator, content_type and text of each block of each file."""

    def run(batches):
        for batch in batches:
            rows = [(i, n, *r) for i, p, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True) if raw is not None for n, r in enumerate(extract(raw, p))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return files.select(F.col(key).cast("long").alias("id"), path, content).mapInArrow(run, SHAPE)


def shown(text):
    """Control characters but the newline as escapes, other line ends as newlines."""
    text = F.regexp_replace(text, LINE_ENDS, "\n")
    for code in [*range(0x00, 0x0A), *range(0x0E, 0x20), 0x7F]:
        text = F.replace(text, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return text


def segments(blocks: DataFrame, header_lines: int = 0) -> DataFrame:
    """Blocks with the lines that they take in a document's derived text: a label line, the block's lines, an empty line.

    Plain arithmetic on running sums; errors and warnings take no lines.
    """
    rows = blocks.where("content_type not in ('error', 'warning')").withColumn("text", shown(F.col("text")))
    n = F.size(F.split("text", "\n", -1))
    order = Window.partitionBy("id").orderBy("ordinal")
    before = F.coalesce(F.sum(n + 2).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("label_line", (before + header_lines + 1).cast("int")).withColumn("start", F.col("label_line") + 1).withColumn("end", (F.col("label_line") + n).cast("int"))


def derived_text(placed: DataFrame) -> DataFrame:
    """id and the derived text of each document."""
    part = F.concat(F.lit("## Location: "), F.col("locator"), F.lit("\n"), F.col("text"), F.lit("\n"))
    # A document's text is bounded by CHARACTERS.
    return placed.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", part.alias("p")))), lambda x: x["p"]), "\n").alias("text"))


def identified(placed: DataFrame, evidence: str = "evidence_id", representation: str = "representation_sha256") -> DataFrame:
    return placed.withColumn("segment_id", segment_id(F.col(evidence), F.col(representation), F.col("locator"), F.col("start"), F.col("end"), F.sha2("text", 256)))
