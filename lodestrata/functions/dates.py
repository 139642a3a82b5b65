"""Instants with a mandatory zone, partial dates with a precision, and dates in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SKEW_SECONDS = 600
_ZONE = r"(?:Z|[+-]\d{2}:\d{2})"


def instant(text: Column) -> Column:
    """A timestamp, or null where the text is no ISO instant with a zone."""
    ok = text.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}(?::\d{{2}}(?:\.\d{{1,6}})?)?{_ZONE}$")
    full = F.regexp_replace(text, rf"T(\d{{2}}:\d{{2}})({_ZONE})$", "T$1:00$2")
    return F.when(ok, full.try_cast("timestamp"))


def partial(text: Column) -> Column:
    """struct(value, precision, sort_ts): year, month, day, minute or second; null where it is none of them or no such date."""
    shape = (
        F.when(text.rlike(r"^\d{4}$"), F.lit("year"))
        .when(text.rlike(r"^\d{4}-\d{2}$"), F.lit("month"))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit("day"))
        .when(text.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}{_ZONE}$"), F.lit("minute"))
        .when(text.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(?:\.\d{{1,6}})?{_ZONE}$"), F.lit("second"))
    )
    ts = F.when(shape.isin("year", "month", "day"), text.try_cast("date").cast("timestamp")).otherwise(instant(text))
    return F.when(shape.isNotNull() & ts.isNotNull(), F.struct(text.alias("value"), shape.alias("precision"), ts.alias("sort_ts")))


def in_name(name: Column) -> Column:
    """struct(value, precision, basis) of the date in a path's file name: a minute with its zone, an ISO day, a day with underscores, in this order; what is no date falls through."""
    name = F.substring_index(name, "/", -1)
    # The shapes of dates in names, and what each is called.
    m = r"(?<!\d)(\d{4})_(\d{2})_(\d{2}) (\d{2})_(\d{2}) GMT([+-]\d{2})_(\d{2})(?!\d)"
    part = lambda i: F.regexp_extract(name, m, i)
    minute = F.when(part(1) != "", F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit("T"), part(4), F.lit(":"), part(5), F.lit(":00"), part(6), F.lit(":"), part(7)))
    iso = F.nullif(F.regexp_extract(name, r"(?<!\d)(\d{4}-\d{2}-\d{2})(?!\d)", 1), F.lit(""))
    low = F.nullif(F.replace(F.regexp_extract(name, r"(?<!\d)(\d{4}_\d{2}_\d{2})(?!\d)", 1), F.lit("_"), F.lit("-")), F.lit(""))
    as_minute = F.when(minute.try_cast("timestamp").isNotNull(), F.struct(minute.alias("value"), F.lit("minute").alias("precision"), F.lit("filename:gemini_notes").alias("basis")))
    day = lambda c, basis: F.when(c.try_cast("date").isNotNull(), F.struct(c.alias("value"), F.lit("day").alias("precision"), F.lit(basis).alias("basis")))
    return F.coalesce(as_minute, day(iso, "filename:iso_date"), day(low, "filename:underscore_date"))


def content_time(provenance: Column, name: Column) -> Column:
    """struct(value, precision, basis): what the provenance says, else the file name, else null."""
    named = in_name(name)
    declared = partial(provenance)
    return F.coalesce(
        F.when(declared.isNotNull(), F.struct(declared["value"].alias("value"), declared["precision"].alias("precision"), F.lit("provenance").alias("basis"))),
        named,
    )


def ahead_of_clock(ts: Column, now: Column, seconds: int = SKEW_SECONDS) -> Column:
    return ts > now + F.make_dt_interval(secs=F.lit(seconds))


def label(d: Column) -> Column:
    """How a date struct reads: its status, span, precision and basis; alternatives where they conflict.

    d has status, basis, value, end, precision, anchor_ref, anchor_value, note
    and alternatives (value, precision, evidence_refs); references count from
    0 and are shown from 1.
    """
    dash = F.lit(" \u2014 ")
    one = lambda x: F.concat(x["value"], F.lit(" ("), x["precision"], F.lit("; citations "), F.array_join(F.transform(x["evidence_refs"], lambda i: (i + 1).cast("string")), ", "), F.lit(")"))
    span = F.concat(d["value"], F.coalesce(F.concat(F.lit("\u2013"), d["end"]), F.lit("")))
    known = F.concat(d["status"], F.lit(": "), span, F.lit(" ("), d["precision"], F.lit("; "), d["basis"], F.lit(")"))
    known = F.when(d["basis"] == "relative_to_anchor", F.concat(known, F.lit("; anchor "), d["anchor_value"], F.lit(" (citation "), (d["anchor_ref"] + 1).cast("string"), F.lit(")"))).otherwise(known)
    known = F.concat(known, F.coalesce(F.concat(dash, d["note"]), F.lit("")))
    return F.when(d["status"] == "unknown", F.concat(F.lit("unknown"), dash, d["note"])).when(d["status"] == "conflicting", F.concat(F.lit("conflicting: "), F.array_join(F.transform(d["alternatives"], one), "; "), dash, d["note"])).otherwise(known)


def anchor_precision(value: Column) -> Column:
    n = F.length(value)
    return F.when(n == 4, "year").when(n == 7, "month").when(n == 10, "day").when(F.length(F.regexp_replace(value, rf"{_ZONE}$", "")) == 16, "minute").otherwise("second")
