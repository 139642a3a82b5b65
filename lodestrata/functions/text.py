"""Scalar functions on text. Those that need Python's own Unicode rules are Arrow-batched UDFs; all others stay in the JVM."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Line ends as Python's splitlines() knows them.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# Fixed value: what a token is.
_TOKEN = re.compile("[^\\W_][\\w\u0300-\u036f]*")


def split_lines(text: Column) -> Column:
    """Lines without their ends; a last end opens no further line, and an empty text has none."""
    parts = F.split(F.regexp_replace(text, r"^\uFEFF", ""), LINE_ENDS, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def quote(lines: Column, start: Column, end: Column) -> Column:
    """Lines start to end, counted from 1 and both included, as one text."""
    return F.array_join(F.slice(lines, start, end - start + 1), "\n")


def rendered_line(number: Column, text: Column) -> Column:
    return F.concat(F.format_string("L%06d | ", number), text, F.lit("\n"))


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


@F.pandas_udf(T.StringType())
def casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def fold_text(t: str) -> str:
    """Case and accents away: casefold, compatibility decomposition, no combining marks."""
    if t.isascii():
        return t.lower()
    return _combining().sub("", unicodedata.normalize("NFKD", t.casefold()))


@functools.cache
def _combining() -> re.Pattern:
    return re.compile(f"[{''.join(c for c in map(chr, range(0x300, sys.maxunicode + 1)) if unicodedata.combining(c))}]+")


@F.pandas_udf(T.StringType())
def fold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else fold_text(t))


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def tokens_of(t: str) -> list[dict]:
    return [{"token": fold_text(m.group()), "start": m.start(), "end": m.end()} for m in _TOKEN.finditer(t)]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def tokens(texts: pd.Series) -> pd.Series:
    """Folded words with their spans, in code points, the end exclusive."""
    return texts.map(lambda t: [] if t is None else tokens_of(t))


def escaped_html(text: Column) -> Column:
    """Without quotes: the text goes between tags."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escaped_markdown(text: Column) -> Column:
    text = escaped_html(text)
    for c in ("\\", "`", "[", "]", "*", "_", "|"):
        text = F.replace(text, F.lit(c), F.lit("\\" + c))
    return text


def mermaid_label(text: Column) -> Column:
    """Characters that a diagram would take for syntax as numbered entities, line ends as spaces; each character once."""
    text = F.translate(text, "#&\n\r", "\x01\x02  ")
    for c, code in (('"', "#quot;"), ("<", "#60;"), (">", "#62;"), ("\\", "#92;"), ("`", "#96;"), ("\x01", "#35;"), ("\x02", "#38;")):
        text = F.replace(text, F.lit(c), F.lit(code))
    return text


def column_number(letters: Column) -> Column:
    """Spreadsheet columns: A is 1, Z 26, AA 27."""
    return F.aggregate(F.split(letters, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(a * 26 + F.ascii(c) - 64))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def has_any(text: Column, terms: list[str]) -> Column:
    """Whether the folded text holds any of the terms; terms are folded here, the text by the caller."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return out


# Words in a quote that show that something is still open.
PENDING = ("propuesto", "propuesta", "pendiente", "a validar", "a definir", "por confirmar", "tbd", "proposed", "pending", "to be confirmed")
# Parts of file names that mark a text as written by a machine.
MACHINE_WRITTEN = ("notes by gemini", "notas de gemini", "notas por gemini", "gemini notes", "ai-generated", "ai generated")


def pending_words(text: Column, words: tuple[str, ...] = PENDING) -> Column:
    """The sorted words of the list that the text holds."""
    return F.array_sort(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(text), w)))


def machine_written(path: Column, marks: tuple[str, ...] = MACHINE_WRITTEN) -> Column:
    return F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(F.lower(basename(path)), m))
