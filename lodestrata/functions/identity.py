"""Content-derived identities: digests over canonical JSON, and the short ids made from them."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a digest that a short id keeps.
SHORT = 24


def canonical_text(value: object) -> str:
    """Canonical JSON of a Python value: sorted keys, no spaces, UTF-8 unescaped, no NaN."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def digest_of(value: object) -> str:
    return hashlib.sha256(canonical_text(value).encode()).hexdigest()


def json_string(c: Column) -> Column:
    """A JSON string as canonical JSON writes it; null becomes the JSON null.

    to_json writes control characters with capital hex digits, the canonical
    form has small ones, so those are put right.
    """
    quoted = F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    control = F.when(quoted.rlike(r"\\u00[01][A-F]"), F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(quoted, r"(\\u00[01])A", "$1a"), r"(\\u00[01])B", "$1b"), r"(\\u00[01])C", "$1c"), r"(\\u00[01])D", "$1d"), r"(\\u00[01])E", "$1e"), r"(\\u00[01])F", "$1f")).otherwise(quoted)
    return F.coalesce(F.when(c.isNotNull(), control), F.lit("null"))


def json_array(*parts: tuple[str, Column] | Column) -> Column:
    """Canonical JSON of an array; ("int", column) and ("raw", column) are not quoted."""
    texts = []
    for p in parts:
        kind, c = p if isinstance(p, tuple) else ("text", p)
        texts.append(json_string(c) if kind == "text" else F.coalesce(c.cast("string"), F.lit("null")))
    return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))


def short_id(prefix: str, *parts: tuple[str, Column] | Column) -> Column:
    """PREFIX-xxxxxxxx: the prefix and the head of the digest of a canonical array."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(json_array(*parts), 256), 1, SHORT))


def logical_id(project: Column, source: Column, path: Column) -> Column:
    """The same across captures: project, source and path."""
    return short_id("F", project, source, path)


def evidence_id(project: Column, source: Column, path: Column, content_sha: Column, representation_sha: Column | None = None) -> Column:
    """Another one for other bytes."""
    return short_id("E", project, source, path, content_sha, *([] if representation_sha is None else [representation_sha]))


def representation_sha(content_sha: Column) -> Column:
    """Of a plain text source."""
    return F.sha2(json_array(F.lit("source_text-v1"), content_sha), 256)


def segment_id(evidence: Column, representation: Column, locator: Column, start: Column, end: Column, lines_sha: Column) -> Column:
    return short_id("S", evidence, representation, locator, ("int", start), ("int", end), lines_sha)


def mention_id(evidence: Column, line: Column, start: Column, end: Column, target: Column) -> Column:
    return short_id("M", evidence, ("int", line), ("int", start), ("int", end), target)


def manual_mention_id(source: Column, target: Column) -> Column:
    return short_id("M", F.lit("manual"), source, target)


def intake_id(origin: Column, run: Column, referral: Column) -> Column:
    return short_id("INT", origin, run, referral)


def ordered_digest(items: Column) -> Column:
    """Digest of an array of strings in the order given."""
    return F.sha2(F.concat(F.lit("["), F.array_join(F.transform(items, json_string), ","), F.lit("]")), 256)
