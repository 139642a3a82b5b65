"""Personal data: patterns, and terms that disclose the entities the patterns find.

Protected entities are the values that the patterns find (an e-mail address,
an IP address, a card or phone number). A term is a word. Over the whole
corpus, with documents as events,

    IC(e) = log2(N / n(e))        what knowing the entity is worth
    PMI(t; e) = log2(N n(t, e) / (n(t) n(e)))   what the term tells about it

and the disclosure PMI / IC is 1 when the term never occurs without the
entity. A term whose disclosure of any entity reaches `remove` is removed, one
that reaches `generalise` is replaced by its shape, wherever it occurs: also
far from the entity and in documents without it, where it would reveal what is
masked elsewhere.

Copies of a document tell nothing about a term. A document's least hash of five
words tells copies and near copies from others, and an entity, and a pair, must
be seen in `contexts` documents that differ in it (told apart by 64 bits, so
that this is a lower bound), and not in many more that do not. An entity known
to more than one document in 2^worth is no secret.

Passes: one over the texts finds spans and, where there are any, the words;
entities and pairs are counted, so that only words which stand beside a
recurring entity are counted in all texts by the second pass; only words that
disclose something are looked for by the third. Workers get candidates as a set
of a fixed number of bits, and what it lets through wrongly falls out in joins.

Cases: null texts count as empty and give zero counts; ties of spans go by
start, then kind; repeated rows give equal rows; a null doc_id stays null; an
empty table gives no rows; further columns are ignored; the longest text needs
memory for itself and its words.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import LIKELY_BITS, arrow_schema, bit_set, in_batches, table, text_column
from lodestrata.session import written

KINDS = ("email", "ip", "card", "phone")
#: Words that a task remembers, and distinct terms counted in it before they are handed on.
HELD = 400_000
STRIP = ".,;:!?()[]{}\"'«»<>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start within a run of digits fares no better than one before it.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end and kind) of what the patterns find, by start and then kind."""
    out: list[tuple[int, int, int]] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return [(s, k, e) for s, k, e in out]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def words_of(text: str) -> list[str]:
    """Tokens between ASCII white space."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()] if _ODD.search(text) else text.split()


def term_of(token: str) -> str:
    """A token's term: in small letters, without marks; empty if it has two characters or fewer, or no letter."""
    term = token.strip(STRIP).lower()
    return term if len(term) > 2 and any(map(str.isalpha, term)) else ""


def places(text: str) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) for each token that has one."""
    for m in _TOKEN.finditer(text):
        if term := term_of(raw := m.group()):
            start = m.start() + len(raw) - len(raw.lstrip(STRIP))
            yield term, start, start + len(raw.strip(STRIP))


def outside(found: Iterable[tuple[str, int, int]], spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Those that no span of the patterns touches; both come by start."""
    at, reach = 0, 0
    ends = list(itertools.accumulate((e for _, _, e in spans), max))
    for term, a, b in found:
        while at < len(spans) and spans[at][0] < b:
            reach = ends[at]
            at += 1
        if reach <= a:
            yield term, a, b


def hashed(s: str | bytes) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(s)
    return h - (1 << 64) if h >> 63 else h


def event(text: str) -> int:
    """The least hash of five words in a row, which copies and most near copies share; of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return min(map(hashed, map(b" ".join, zip(*(words[i:] for i in range(5)), strict=False))), default=hashed(b" ".join(words)))


FOUND, FOUND_ARROW = arrow_schema(what="int", row="long", doc_id="long", k="long", n_email="long", n_ip="long", n_card="long", n_phone="long", base="string", event="long", entity="long", terms="array<long>")
COUNTED, COUNTED_ARROW = arrow_schema(term="long", n="long")
PLACED, PLACED_ARROW = arrow_schema(k="long", term="long", start="long", end="long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.col("doc_id"), text_column()).alias("k"), "text")


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types, strict=True)], schema=shape)


def _found(docs: DataFrame) -> DataFrame:
    """A row for each document (what 0), with its event and terms if it has entities, and one for each of its entities (1)."""

    def make():
        from pyspark import TaskContext

        part, state = TaskContext.get().partitionId() << 40, {"row": 0}

        def step(batch: pa.RecordBatch):
            rows = []
            for doc, k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                spans, row = base_spans(text), part + state["row"]
                state["row"] += 1
                n = Counter(x[1] for x in spans)
                which = event(text) if spans else None
                terms = [hashed(t) for t in {t for t, _, _ in outside(places(text), spans)}] if spans else None
                rows.append((0, row, doc, k, n[0], n[1], n[2], n[3], joined(spans), which, None, terms))
                rows += [(1, row, None, None, None, None, None, None, None, which, hashed(e), None) for e in {KINDS[k] + ":" + text[s:e].lower() for s, k, e in spans}]
            if rows:
                yield _batch(rows, FOUND_ARROW)

        return step

    return written(in_batches(_keyed(docs), make, FOUND), "found")


def _flags(bits: bytes) -> Callable[[str], int]:
    """The hash of a token's term if it is in the set of bits, else 0; remembered by token."""
    known: dict[str, int] = {}
    top = (1 << LIKELY_BITS) - 1

    def flag(token: str) -> int:
        got = known.get(token)
        if got is None:
            term = term_of(token)
            h = hashed(term) if term else 0
            got = h if term and bits[(h & top) >> 3] >> (h & 7) & 1 else 0
            if len(known) > HELD:
                known.clear()
            known[token] = got
        return got

    return flag


def _counted(docs: DataFrame, bits: bytes) -> DataFrame:
    """term and n: in how many rows it stands, for terms in the set of bits."""

    def make():
        flag, counts = _flags(bits), Counter()

        def held():
            if counts:
                yield _batch(list(counts.items()), COUNTED_ARROW)
                counts.clear()

        def step(batch: pa.RecordBatch | None):
            if batch is None:
                yield from held()
                return
            for text in batch.column(0).to_pylist():
                if text:
                    here = set(map(flag, set(words_of(text))))
                    here.discard(0)
                    counts.update(here)
                    if len(counts) > HELD:
                        yield from held()

        return step

    return in_batches(docs.select("text"), make, COUNTED, ends=True).groupBy("term").agg(F.sum("n").alias("n_t"))


def _places(docs: DataFrame, bits: bytes) -> DataFrame:
    """k, term, start and end of terms in the set of bits, outside the patterns' spans."""

    def make():
        flag = _flags(bits)

        def step(batch: pa.RecordBatch):
            rows = []
            for k, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if text and any(map(flag, set(words_of(text)))):
                    rows += [(k, hashed(t), a, b) for t, a, b in outside(places(text), base_spans(text)) if flag(t)]
            if rows:
                yield _batch(rows, PLACED_ARROW)

        return step

    return in_batches(_keyed(docs), make, PLACED)


def _differ(contexts: int, n: str) -> Column:
    """Whether so many of the documents counted in n differ, by the bits of their events, and not too few of them."""
    bits = F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("event"), F.lit(64)).cast("int"))))
    return (bits >= contexts) & ((bits >= 32) | (4 * bits >= F.count(n)))


def disclosing(docs: DataFrame, found: DataFrame, remove: float, generalise: float, contexts: int, worth: float) -> DataFrame:
    """term (a hash) and kind: `term` if it is to be removed, `broad` if generalised."""
    spark = docs.sparkSession
    total = found.where("what = 0").count()
    mentions = found.where("what = 1").select("row", "event", "entity")
    entities = mentions.groupBy("entity").agg(F.count("row").alias("n_e"), _differ(contexts, "row").alias("differ"))
    entities = written(entities.where(F.col("differ") & (F.log2(F.lit(float(total)) / F.col("n_e")) >= worth)).select("entity", "n_e"), "entities")
    beside = mentions.join(entities.hint("merge"), "entity").join(found.where("what = 0 and terms is not null").select("row", "terms").hint("merge"), "row")
    pairs = beside.select("entity", "n_e", "event", F.explode("terms").alias("term")).groupBy("entity", "n_e", "term").agg(F.count("event").alias("n_te"), _differ(contexts, "event").alias("differ"))
    pairs = written(pairs.where("differ").drop("differ"), "pairs")
    bits = bit_set(pairs.select("term"))
    if not any(bits):
        return spark.createDataFrame([], "term long, kind string")
    known = pairs.join(_counted(docs, bits), "term")
    n = F.lit(float(total))
    known = known.withColumn("d", F.log2(n * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / F.log2(n / F.col("n_e")))
    worst = known.groupBy("term").agg(F.max("d").alias("d")).where(F.col("d") >= generalise)
    return worst.select("term", F.when(F.col("d") >= remove, "term").otherwise("broad").alias("kind"))


def spans(docs: DataFrame, remove: float = 0.95, generalise: float = 0.75, contexts: int = 3, worth: float = 3.0) -> DataFrame:
    """For each row of docs: doc_id, k (hash of the row), n_email, n_ip, n_card, n_phone, base and spans.

    base and spans are kind:start:end joined by commas; spans also has `term`
    (to be removed) and `broad` (to be generalised).
    """
    t = _found(docs)
    risky = written(disclosing(docs, t, remove, generalise, contexts, worth), "disclosing")
    rows = t.where("what = 0").select("doc_id", "k", "n_email", "n_ip", "n_card", "n_phone", "base")
    bits = bit_set(risky.select("term"))
    if not any(bits):
        return rows.withColumn("spans", F.col("base"))
    hits = _places(docs, bits).join(risky.hint("merge"), "term")
    added = hits.groupBy("k").agg(F.collect_set(F.struct("start", F.lit(9).alias("rank"), "kind", "end")).alias("more"))  # of one text
    added = written(added, "terms").select(F.col("k").alias("k2"), "more")
    own = F.expr("filter(split(base, ','), x -> x <> '')")
    parsed = F.transform(own, lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(2)).cast("long").alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), F.split_part(x, F.lit(":"), F.lit(1))).cast("int").alias("rank"), F.split_part(x, F.lit(":"), F.lit(1)).alias("kind"), F.split_part(x, F.lit(":"), F.lit(3)).cast("long").alias("end")))
    every = F.array_sort(F.concat(parsed, F.col("more")))
    text = F.array_join(F.transform(every, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    both = rows.join(added.hint("merge"), F.col("k") == F.col("k2"), "left")
    return both.select(*rows.columns, F.when(F.col("more").isNull(), F.col("base")).otherwise(text).alias("spans"))


def sanitised(docs: DataFrame, **limits: float) -> DataFrame:
    """doc_id, text and spans, the text with each span replaced: a pattern's kind in brackets, nothing for a term, its shape for a generalised one."""
    found = spans(docs, **limits).groupBy(F.col("k").alias("k2")).agg(F.any_value("spans").alias("spans"))
    found = written(found, "spans")
    source = _keyed(docs).join(found.hint("merge"), F.col("k") == F.col("k2")).select("doc_id", "text", "spans")
    schema, shape = arrow_schema(doc_id="long", text="string", spans="string")

    def make():
        def step(batch: pa.RecordBatch):
            docs, texts, marks = batch.columns
            yield pa.RecordBatch.from_arrays([docs, pa.array([replaced(t or "", s) for t, s in zip(texts.to_pylist(), marks.to_pylist(), strict=True)]), marks], schema=shape)

        return step

    return in_batches(source, make, schema)


def shape(term: str) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join("0" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in term))


def replaced(text: str, marks: str) -> str:
    out, at = [], 0
    for mark in filter(None, marks.split(",")):
        kind, a, b = mark.split(":")
        a, b = int(a), int(b)
        if a >= at:
            out += [text[at:a], "" if kind == "term" else f"<{shape(text[a:b])}>" if kind == "broad" else f"[{kind.upper()}]"]
            at = b
    return "".join([*out, text[at:]])


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents"))
    n = F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", n.alias("n_found"))
