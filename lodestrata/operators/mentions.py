"""Alias mentions: word sequences in lines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lodestrata.batches import in_batches
from lodestrata.functions.identity import mention_id
from lodestrata.functions.text import fold_text, tokens, tokens_of

# Fixed value: what a word of ASCII is.
_ASCII_WORD = re.compile("[a-z0-9]+")


def alias_keys(aliases: DataFrame) -> DataFrame:
    """aliases (alias, target) with `words`, the folded words of an alias; an alias without words or with blanks around it raises."""
    keyed = aliases.withColumn("words", F.transform(tokens("alias"), lambda t: t["token"]))
    bad = keyed.where((F.size("words") == 0) | (F.trim("alias") != F.col("alias")))
    if found := bad.limit(1).collect():
        raise ValueError(f"not an alias: {found[0].alias!r}")
    return keyed


def line_tokens(lines: DataFrame, text: str = "text") -> DataFrame:
    return lines.withColumn("tokens", tokens(text))


def ascii_words(text: str) -> list[dict]:
    """Words of ASCII letters and digits of a lower-case text, with their numbers from 1, the end exclusive."""
    return [{"token": w, "start": i, "end": i + 1} for i, w in enumerate(_ASCII_WORD.findall(text), 1)]


def mentions(tokenised: DataFrame, aliases: DataFrame, keys: list[str], most: int = 3000) -> DataFrame:
    """keys, start and end (code points), alias, target and classification of each match in a line.

    tokenised has a row for each line, with keys and tokens (token, start,
    end); aliases has alias, target and words.
    """
    return _found(tokenised, "tokens", aliases, keys, most, lambda known: lambda tokens: tokens or [])


def mentions_in(lines: DataFrame, aliases: DataFrame, keys: list[str], text: str = "text", words: Callable[[str], list[dict]] = tokens_of, fold: Callable[[str], str] = fold_text, most: int = 3000) -> DataFrame:
    """The same from a line's text, whose words are made only where the folded line holds the first word of an alias.

    words() gives the words of a text with their spans; they must be parts of
    what fold() makes of the whole text.
    """

    def make(known: dict[str, list]):
        first = re.compile("|".join(map(re.escape, sorted(known))) or "(?!)")
        return lambda line: words(line) if line and first.search(fold(line)) else []

    return _found(lines, text, aliases, keys, most, make)


def _found(df: DataFrame, column: str, aliases: DataFrame, keys: list[str], most: int, tokeniser: Callable) -> DataFrame:
    """Matches of each row, compared within the row; the at most `most` aliases go to each task."""
    rows = aliases.select("alias", "target", "words").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} aliases")
    known: dict[str, list] = {}
    for r in rows:
        if r.words:
            known.setdefault(r.words[0], []).append((list(r.words), r.alias, r.target))
    shape = T.StructType([*[df.schema[k] for k in keys], *T._parse_datatype_string("start int, end int, alias string, target string, classification string")])

    def make():
        tokens_in, types = tokeniser(known), to_arrow_schema(shape)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at, found = [], []
            for i, raw in enumerate(batch.column(0).to_pylist()):
                got = matches(tokens_in(raw), known)
                at += [i] * len(got)
                found += got
            if found:
                carried = [batch.column(k + 1).take(pa.array(at)) for k in range(len(keys))]
                made = [pa.array(c, types.field(len(keys) + k).type) for k, c in enumerate(zip(*found, strict=True))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(carried, types, strict=False)] + made, schema=types)

        return step

    return in_batches(df.select(column, *keys), make, shape)


def matches(tokens: list[dict], known: dict[str, list]) -> list[tuple[int, int, str, str, str]]:
    """start, end, alias, target and classification of each place where a line's tokens are an alias; known has aliases (words, alias, target) by their first word.

    Matches of which another target shares a character are ambiguous. Places
    ascend, so that a match is compared only with those that begin before its end.
    """
    found = []
    for i, t in enumerate(tokens):
        for words, alias, target in known.get(t["token"], ()):
            n = len(words)
            if n == 1 or [x["token"] for x in tokens[i : i + n]] == words:
                found.append((t["start"], tokens[i + n - 1]["end"], alias, target))
    other = [False] * len(found)
    for i, (_, end, _, target) in enumerate(found):
        for j in range(i + 1, len(found)):
            if found[j][0] >= end:
                break
            if found[j][3] != target:
                other[i] = other[j] = True
    return [(*f, "ambiguous_alias_overlap" if o else "explicit_alias_candidate") for f, o in zip(found, other, strict=True)]


def identified(found: DataFrame, evidence: str = "evidence_id", line: str = "line") -> DataFrame:
    return found.withColumn("mention_id", mention_id(F.col(evidence), F.col(line), F.col("start"), F.col("end"), F.col("target")))
