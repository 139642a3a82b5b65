"""Quality rules: fixed base rules, and a decision list learned from labels.

Statistics of each whole text are computed once. A list of conjunctions of
thresholds is learned by sequential covering from the statistics of labelled
documents: a rule grows, condition by condition, by the information it gains
on two thirds of the rows, is pruned from its end as long as that does not
hurt its precision on the other third, and is taken if it is precise enough there;
rows that it covers leave, and the next rule is grown on the rest. Rules that
find low quality become an ordered Spark conditional expression. Copies count
once, so that a group of copies cannot make a rule by itself.

The fit takes at most `rows` labelled documents, chosen by a hash of doc_id;
this bound is the fit's only one, and the list is applied to all rows.

Cases: a null text has no words and fails the base rules; labels that are null
or missing are not learned from; without labels of both kinds no rule is
learned and only the base rules hold; repeated rows give equal rows; a null
doc_id is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import arrow_schema, hashed_share, in_batches, table
from lodestrata.session import written

#: Labelled documents that a fit takes at most.
SAMPLE = 20_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_stops")
RATES = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: F.col("word_chars") / F.col("n_words"),
    "symbols": lambda: F.col("n_symbols") / F.col("n_words"),
    "dup_lines": lambda: F.col("n_dup_lines") / F.col("n_lines"),
    "repeats": lambda: F.col("n_repeat_words") / F.col("n_words"),
    "distinct": lambda: F.col("n_distinct") / F.col("n_words"),
    "upper": lambda: F.col("n_upper") / F.col("word_chars"),
    "digits": lambda: F.col("n_digits") / F.col("word_chars"),
    "stops": lambda: F.col("n_stops") / F.col("n_words"),
}

STATS, STATS_ARROW = arrow_schema(doc_id="long", k="long", **dict.fromkeys(COUNTS, "long"))


def repeated_words(words: list) -> int:
    """Words in windows of three that are found twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    n, covered = 0, 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            n += i + 3 - max(i, covered)
            covered = i + 3
    return n


def statistics(text: str) -> tuple[int, ...]:
    """COUNTS of a whole text."""
    words = text.encode().split()  # on bytes: only the six ASCII white spaces
    lines = text.split("\n")
    seen: set[str] = set()
    dup = 0
    if len(lines) > 1:
        for line in lines:
            if line in seen:
                dup += bool(line.strip(SPACES))
            else:
                seen.add(line)
    kinds = Counter(words)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        dup,
        repeated_words(words),
        len(lines),
        len(kinds),
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        sum(map(text.count, "0123456789")),
        sum(map(text.count, ".,;:!?")),
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, k (a hash of the text) and COUNTS for each row."""

    def make():
        def step(batch: pa.RecordBatch):
            rows = [statistics(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))], schema=STATS_ARROW)

        return step

    return in_batches(docs.select("doc_id", F.xxhash64("text").alias("k"), "text"), make, STATS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


Rule = list[tuple[str, str, float]]


def _covers(rule: Rule, x: dict[str, float]) -> bool:
    return all(x[f] >= t if op == ">=" else x[f] < t for f, op, t in rule)


def _thresholds(values: list[float], n: int = 64) -> list[float]:
    v = sorted(set(values))
    return v if len(v) <= n else sorted({v[i * (len(v) - 1) // n] for i in range(1, n + 1)})


def learn(rows: list[dict[str, float]], precision: float = 0.9, least: int = 8, most: int = 16) -> list[Rule]:
    """Rules that find rows whose `bad` is 1, in the order in which they were found."""
    rules: list[Rule] = []
    grow, prune = [x for i, x in enumerate(rows) if i % 3], [x for i, x in enumerate(rows) if i % 3 == 0]
    features = [f for f in (rows[0] if rows else ()) if f != "bad"]
    while len(rules) < most and sum(x["bad"] for x in grow) >= least:
        rule, left = [], grow
        while len(rule) < 4 and any(not x["bad"] for x in left):
            p0, n0 = sum(x["bad"] for x in left), sum(1 - x["bad"] for x in left)
            best = (0.0, None)
            for f in features:
                pairs = sorted((x[f], x["bad"]) for x in left)
                cuts, p, n, i = _thresholds([v for v, _ in pairs]), 0, 0, 0
                for t in cuts:
                    while i < len(pairs) and pairs[i][0] < t:
                        p, n, i = p + pairs[i][1], n + 1 - pairs[i][1], i + 1
                    for op, pp, nn in (("<", p, n), (">=", p0 - p, n0 - n)):
                        if pp >= least:
                            gain = pp * (math.log2(pp / (pp + nn)) - math.log2(p0 / (p0 + n0)))
                            if gain > best[0] + 1e-9:
                                best = (gain, (f, op, t))
            if not best[1]:
                break
            f, op, t = best[1]
            before = max((x[f] for x in left if x[f] < t), default=t)
            rule.append((f, op, (before + t) / 2))  # halfway to the next value seen
            left = [x for x in left if _covers(rule[-1:], x)]

        def worth(r: Rule) -> float:
            hit = [x["bad"] for x in prune if _covers(r, x)]
            return (sum(hit) + 1) / (len(hit) + 2)

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        hit = [x["bad"] for x in rows if rule and _covers(rule, x)]
        apart = [x["bad"] for x in prune if rule and _covers(rule, x)]  # rows that did not grow it
        if sum(hit) < least or not apart or sum(apart) < precision * len(apart):
            break
        rules.append(rule)
        grow, prune, rows = ([x for x in part if not _covers(rule, x)] for part in (grow, prune, rows))
    return rules


def sample(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> list[dict[str, float]]:
    """Rates and `bad` of labelled documents, each text once, at most `rows`; those that the base rules drop teach nothing."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = stats.where(~base_failed()).join(known, "doc_id")
    once = joined.groupBy("k").agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), "quality", *COUNTS)).alias("x")).select("k", "x.*")
    once = written(once, "labelled")
    taken = once.where(hashed_share(F.col("h"), rows, once.count())).orderBy("h", "k").limit(rows)
    got = taken.select((F.col("quality") == 0).cast("int").alias("bad"), *[F.coalesce(rate(), F.lit(0.0)).alias(f) for f, rate in RATES.items()]).collect()
    return [r.asDict() for r in got]


def decision(rules: list[Rule]) -> Column:
    """True for rows that no rule of the list finds: an ordered conditional expression."""
    out = F.lit(True)
    for rule in reversed(rules):
        test = F.lit(True)
        for f, op, t in rule:
            rate = F.coalesce(RATES[f](), F.lit(0.0))
            test = test & (rate >= F.lit(t) if op == ">=" else rate < F.lit(t))
        out = F.when(test, F.lit(False)).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """doc_id, COUNTS, base_failed and kept for each row."""
    stats = written(measured(docs), "quality")
    rules = learn(sample(stats, labels, rows))
    failed = base_failed()
    return stats.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & decision(rules)).alias("kept"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
