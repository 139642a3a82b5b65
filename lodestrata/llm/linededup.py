r"""Line deduplication by winnowing, with DataFrame functions only.

A text's lines with words stand in order. From each line a window runs on
until it holds `min_words` words, and selects its least line hash: the lines so
selected are the text's fingerprints, and equal runs of min_words words or more
have a window in common, and with it a fingerprint, for certain. Fingerprints
that stand in one place only are out, and with them the windows that select
them. The places of the others are joined by what their windows hold with the
first place that holds the same, in order of doc_id and line. Matches with the
same partner and distance make up runs, which are extended both ways, line by
line, as long as they equal the partner's lines, by min_words - 1 lines at
most. The lines of later runs are deleted; every line deleted has an equal line
in an earlier place, so that one copy of each line stays.

Each text is hashed where it is read, and its lines are laid out in blocks of
min_words - 1, which extensions look up. Places by hash may be hot (a passage
that a third of all documents share): first places come from a pre-aggregated
minimum, and rows meet them in plain equi-joins, which Spark splits where a key
is skewed. No pairs within a group are made. Only texts that may lose lines are
shuffled. Lines are compared by 96 bits of hash.

Cases: null texts have no lines and stay null; lines without words count for
nothing and go only where they stand between deleted lines; rows that repeat
doc_id and text are one document and share its result; a null doc_id comes
after all others; a text whose lines all go becomes empty, its row stays; an
empty table gives no rows; further columns, whatever their names, are carried
by `deduplicated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import WORD, fresh, likely, table, text_column
from lodestrata.session import written

#: Words that a repeated run must hold.
MIN_WORDS = 50


def _key() -> Column:
    return F.xxhash64(F.col("doc_id"), text_column())


def blocks(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The lines with words of each document in blocks: k (document), doc_id, n (its lines), b and `lines`.

    A line has r (its number from 1), pos, h and g (hashes), and of the window
    from it m (lines), at and anchor (the fingerprint's place and hash), c1 and
    c2 (hashes), null where the text ends first.
    """
    # Each word becomes one letter, so that a line's length is its words.
    marks = F.translate(F.regexp_replace("text", WORD, "w"), " \t\x0b\x0c\r", "")
    both = F.arrays_zip(F.split("text", "\n", -1).alias("line"), F.split(marks, "\n", -1).alias("mark"))
    each = F.transform(both, lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x["line"]).alias("h"), F.hash(x["line"]).alias("g"), F.length(x["mark"]).alias("w")))
    whole = docs.where("text is not null").select(_key().alias("k"), "doc_id", F.filter(each, lambda x: x["w"] > 0).alias("lines"))
    whole = whole.groupBy("k").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("lines").alias("lines"))
    n, total = F.size("lines"), F.aggregate("lines", F.lit(0), lambda a, x: a + x["w"])
    # Counted in a step of its own: beside explode, each line's row would carry the whole array.
    counted = whole.select("k", "doc_id", n.alias("n"), total.alias("total"), "lines")
    rows = counted.select("k", "doc_id", "n", "total", F.explode("lines").alias("x")).select("k", "doc_id", "n", "total", "x.*")
    order = Window.partitionBy("k").orderBy("pos")
    rows = rows.select("*", F.row_number().over(order).alias("r"), (F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")).alias("before"))
    ahead = Window.partitionBy("k").orderBy("before").rangeBetween(0, min_words - 1)
    rows = rows.withColumn("held", F.collect_list(F.struct("h", "g")).over(ahead)).withColumn("hs", F.col("held.h"))
    full = lambda c: F.when(F.col("total") - F.col("before") >= min_words, c)
    least = F.array_min("hs")
    line = F.struct("r", "pos", "h", "g", full(F.size("held")).alias("m"), full(F.col("r") + F.array_position("hs", least).cast("int") - 1).alias("at"), full(least).alias("anchor"), full(F.xxhash64("hs")).alias("c1"), full(F.hash("held.g")).alias("c2"))
    return rows.groupBy("k", "doc_id", "n", F.expr(f"(r - 1) div {max(1, min_words - 1)}").alias("b")).agg(F.array_sort(F.collect_list(line)).alias("lines"))  # of min_words - 1 lines


def matches(t: DataFrame) -> DataFrame:
    """k, r, e (first and last line of a window), n, fk and d (the document with the first place that holds the same, and how far off), fn."""
    w = t.select("k", "doc_id", "n", F.explode("lines").alias("x")).where("x.m is not null").select("k", "doc_id", "n", "x.r", "x.m", "x.at", "x.anchor", "x.c1", "x.c2")
    place = F.xxhash64("k", "at")
    shared = w.groupBy("anchor").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("anchor")
    # Written, here and below, so that both sides of joins are plain exchanges, which Spark can split where a key is hot.
    shared = written(shared, "anchors")
    w = likely(w, F.col("anchor"), shared, "may").where("may").join(shared.hint("merge"), "anchor")
    w = written(w.select("k", "doc_id", "n", "r", "m", "c1", "c2"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "r", "m", "n")).alias("first")
    firsts = w.groupBy("c1", "c2").agg(first, F.count("*").alias("times")).where("times > 1").select("c1", "c2", "first.k", "first.r", "first.m", "first.n")
    firsts = written(firsts.toDF("c1", "c2", "fk", "fr", "fm", "fn"), "firsts")
    later = w.join(firsts.hint("merge"), ["c1", "c2"]).where("k <> fk or r > fr + fm - 1")
    return later.select("k", "r", (F.col("r") + F.col("m") - 1).alias("e"), "n", "fk", (F.col("fr") - F.col("r")).alias("d"), "fn")


def repeated_runs(t: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """k, start and end (numbers of lines) of the later runs, extended both ways."""
    same = Window.partitionBy("k", "fk", "d").orderBy("r")
    before = F.max("e").over(same.rowsBetween(Window.unboundedPreceding, -1))
    parts = matches(t).withColumn("new", F.coalesce((F.col("r") > before + 1).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(same))
    runs = parts.groupBy("k", "fk", "d", "run").agg(F.min("r").alias("r"), F.max("e").alias("e"), F.max("n").alias("n"), F.max("fn").alias("fn")).drop("run")
    runs = written(runs, "runs")
    most, r, e, d = max(1, min_words - 1), F.col("r"), F.col("e"), F.col("d")
    up, down = (e + 1, F.least(e + most, F.col("n"), F.col("fn") - d)), (F.greatest(r - most, F.lit(1), 1 - d), r - 1)
    look = lambda own, side, doc, ab, by: F.struct(F.lit(own).alias("own"), F.lit(side).alias("side"), F.col(doc).alias("doc"), (ab[0] + by).alias("a"), (ab[1] + by).alias("z"), by.cast("int").alias("by"))
    looks = F.array(*[look(own, side, doc, ab, by) for own, doc, by in ((True, "k", F.lit(0)), (False, "fk", d)) for side, ab in ((1, up), (-1, down))])
    wanted = runs.select("k", "fk", "d", "r", "e", F.explode(looks).alias("x")).where("x.a <= x.z").select("k", "fk", "d", "r", "e", "x.*")
    wanted = wanted.withColumn("b", F.explode(F.sequence(F.expr(f"(a - 1) div {most}"), F.expr(f"(z - 1) div {most}"))))
    own = t.select(F.col("k").alias("bk"), F.col("b").alias("bb"), F.col("lines.r").alias("rs"), F.col("lines.h").alias("hs"), F.col("lines.g").alias("gs"))
    met = wanted.join(own.hint("merge"), (F.col("doc") == F.col("bk")) & (F.col("b") == F.col("bb")))
    # The places' distances from the run, with their hashes.
    away = F.transform(F.arrays_zip("rs", "hs", "gs"), lambda x: F.struct(F.abs(x["rs"] - F.col("by") - F.when(F.col("side") > 0, e).otherwise(r)).alias("s"), x["hs"].alias("h"), x["gs"].alias("g"), x["rs"].alias("at")))
    met = met.select("k", "fk", "d", "r", "e", "own", "side", F.transform(F.filter(away, lambda x: x["at"].between(F.col("a"), F.col("z"))), lambda x: F.struct(x["s"].alias("s"), x["h"].alias("h"), x["g"].alias("g"))).alias("part"))
    of = lambda own, side: F.array_sort(F.flatten(F.collect_list(F.when((F.col("own") == own) & (F.col("side") == side), F.col("part")))))  # noqa: E731  at most `most` lines
    sides = met.groupBy("k", "fk", "d", "r", "e").agg(of(True, 1).alias("u"), of(False, 1).alias("fu"), of(True, -1).alias("v"), of(False, -1).alias("fv"))
    equal = lambda x, y: F.array_position(F.concat(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), F.array(F.lit(False))), F.lit(False)).cast("int") - 1
    grown = sides.select("k", (r - equal("v", "fv")).alias("start"), (e + equal("u", "fu")).alias("end"))
    return grown.unionByName(runs.where((up[0] > up[1]) & (down[0] > down[1])).select("k", r.alias("start"), e.alias("end")))


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """For each document that loses lines: k and `gone`, its ranges (a, b) of line positions from 0, ascending."""
    t = written(blocks(docs, min_words), "lines")
    runs = repeated_runs(t, min_words).groupBy("k").agg(F.collect_set(F.struct("start", "end")).alias("runs"))  # of one document
    lines = t.select("k", F.transform("lines", lambda x: F.struct(x["r"].alias("r"), x["pos"].alias("pos"))).alias("lines")).join(runs.hint("merge"), "k")
    hit = F.filter("lines", lambda x: F.exists("runs", lambda i: x["r"].between(i["start"], i["end"])))
    gone = lines.select("k", hit.alias("hit")).groupBy("k").agg(F.array_sort(F.flatten(F.collect_list("hit"))).alias("hit"))  # of one document
    first = F.filter("hit", lambda x, i: (i == 0) | (F.get("hit", i - 1)["r"] < x["r"] - 1))
    last = F.filter("hit", lambda x, i: (i == F.size("hit") - 1) | (F.get("hit", i + 1)["r"] > x["r"] + 1))
    return gone.select("k", F.zip_with(first, last, lambda x, y: F.struct(x["pos"].alias("a"), y["pos"].alias("b"))).alias("gone"))


def _with_gone(docs: DataFrame, min_words: int) -> tuple[DataFrame, str]:
    """docs with the ranges that go in a new column, and its name: only texts that may lose lines meet the deletions."""
    key, k, gone, may = fresh(docs, "__key", "__k", "__gone", "__may")
    lost = deletions(docs, min_words).select(F.col("k").alias(k), F.col("gone").alias(gone))
    lost = written(lost, "deletions")
    marked = likely(docs.withColumn(key, _key()), F.col(key), lost.select(k), may)
    met = marked.where(F.col(may)).join(lost.hint("merge"), F.col(key) == F.col(k), "left").select(*docs.columns, gone)
    rest = marked.where(~F.col(may)).select(*docs.columns, F.lit(None).cast(lost.schema[gone].dataType).alias(gone))
    return met.unionByName(rest), gone


def _kept_text(gone: str) -> Column:
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.exists(F.col(gone), lambda g: i.between(g["a"], g["b"])))
    return F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with later repeated runs of lines deleted from column text."""
    found, gone = _with_gone(docs, min_words)
    return found.withColumn("text", _kept_text(gone)).select(*docs.columns)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, gone = _with_gone(docs, MIN_WORDS)
    n = F.coalesce(F.aggregate(gone, F.lit(0), lambda a, g: a + g["b"] - g["a"] + 1), F.lit(0)).cast("long")
    ranges = F.coalesce(F.array_join(F.transform(gone, lambda g: F.concat_ws("-", g["a"].cast("string"), g["b"].cast("string"))), ","), F.lit(""))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    return found.select("doc_id", n_lines.alias("n_lines"), n.alias("n_deleted"), ranges.alias("deleted"), _kept_text(gone).alias("text"))


OP7_SQL = """
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, pos, line, row_number() OVER d AS r, count(*) OVER (PARTITION BY doc_id) AS n, sum(w) OVER d AS c, w
  FROM (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM raw) WHERE w > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
e AS (SELECT a.doc_id, a.r, a.n, min(b.r) AS e FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.r BETWEEN a.r AND a.r + 49 AND b.c - a.c + a.w >= 50 GROUP BY ALL),
w AS (SELECT e.doc_id, e.r, e.n, e.e, string_agg(l.line, chr(10) ORDER BY l.r) AS held FROM e JOIN l ON l.doc_id = e.doc_id AND l.r BETWEEN e.r AND e.e GROUP BY ALL),
f AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(r) OVER o AS fr, first_value(e) OVER o AS fe, first_value(n) OVER o AS fn FROM w WINDOW o AS (PARTITION BY held ORDER BY doc_id, r)),
m AS (SELECT doc_id, r, e, n, fd, fn, fr - r AS d FROM f WHERE doc_id <> fd OR r > fe),
s AS (SELECT *, coalesce((r > max(e) OVER (PARTITION BY doc_id, fd, d ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1)::INT, 1) AS new FROM m),
p AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, fd, d ORDER BY r ROWS UNBOUNDED PRECEDING) AS run FROM s),
runs AS (SELECT doc_id, fd, d, run, min(r) AS r, max(e) AS e, max(n) AS n, max(fn) AS fn FROM p GROUP BY ALL),
x AS (SELECT runs.*, i AS s, CASE WHEN i > 0 THEN e ELSE r END + i AS at FROM runs, (SELECT unnest(range(-49, 50)) AS i) WHERE i <> 0),
y AS (SELECT x.doc_id, x.fd, x.d, x.run, x.s, a.line IS NOT DISTINCT FROM b.line AND a.line IS NOT NULL AS same
  FROM x LEFT JOIN l a ON a.doc_id = x.doc_id AND a.r = x.at LEFT JOIN l b ON b.doc_id = x.fd AND b.r = x.at + x.d),
g AS (SELECT doc_id, fd, d, run, coalesce(min(CASE WHEN s > 0 AND NOT same THEN s END) - 1, 49) AS up, coalesce(min(CASE WHEN s < 0 AND NOT same THEN -s END) - 1, 49) AS down FROM y GROUP BY ALL),
iv AS (SELECT runs.doc_id, runs.r - g.down AS a, runs.e + g.up AS b FROM runs JOIN g USING (doc_id, fd, d, run)),
del AS (SELECT DISTINCT l.doc_id, l.r, l.pos FROM l JOIN iv ON l.doc_id = iv.doc_id AND l.r BETWEEN iv.a AND iv.b),
part AS (SELECT *, r - row_number() OVER (PARTITION BY doc_id ORDER BY r) AS part FROM del),
rg AS (SELECT doc_id, part, min(pos) AS a, max(pos) AS b FROM part GROUP BY ALL),
gone AS (SELECT doc_id, sum(b - a + 1)::BIGINT AS n_deleted, string_agg(a || '-' || b, ',' ORDER BY a) AS deleted FROM rg GROUP BY ALL),
txt AS (SELECT raw.doc_id, string_agg(raw.line, chr(10) ORDER BY raw.pos) AS text FROM raw WHERE NOT EXISTS (SELECT 1 FROM rg WHERE rg.doc_id = raw.doc_id AND raw.pos BETWEEN rg.a AND rg.b) GROUP BY ALL)
SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN 0 ELSE len(string_split(documents.text, chr(10))) END::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted, coalesce(deleted, '') AS deleted,
  CASE WHEN documents.text IS NOT NULL THEN coalesce(txt.text, '') END AS text
FROM documents LEFT JOIN gone USING (doc_id) LEFT JOIN txt USING (doc_id)
"""
