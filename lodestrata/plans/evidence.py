"""Queries on files, lines, spans, packets, mentions and differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import globs, identity, text
from lodestrata.operators import coverage, delta, intervals, mentions, packets, quotes, ranking, selection
from lodestrata.plans.registry import LINES, PYTHON_LINES, SECOND, documents, exploded, python_lines, query, second, table

FIELDS = "documents_f AS (SELECT doc_id, lower(string_split(text, chr(10))[1]) AS title, lower(text) AS body FROM documents)"


def _fields(docs):
    return docs.select("doc_id", F.lower(F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"), F.lower("text").alias("body"))


def _weights():
    return {"title": (F.col("title"), ranking.WEIGHTS["title"]), "statement": (F.col("body"), ranking.WEIGHTS["statement"])}


@query(f"""WITH {FIELDS}, s AS (SELECT doc_id, (CASE WHEN title LIKE '%the%' THEN 4 ELSE 0 END + CASE WHEN body LIKE '%the%' THEN 2 ELSE 0 END) AS a, (CASE WHEN title LIKE '%tion%' THEN 4 ELSE 0 END + CASE WHEN body LIKE '%tion%' THEN 2 ELSE 0 END) AS b FROM documents_f)
SELECT doc_id, (a + b)::BIGINT AS score, row_number() OVER (ORDER BY a + b DESC, doc_id) AS rank FROM s WHERE a > 0 AND b > 0 ORDER BY score DESC, doc_id LIMIT 50""")
def q_lexical_topk(spark, sf_dir):
    found = ranking.scored(_fields(documents(spark, sf_dir)), "doc_id", _weights(), ranking.terms_of("the tion the")).withColumn("hops", F.lit(0))
    from pyspark.sql import Window

    return ranking.top(found, "doc_id").select("doc_id", "score", F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")).cast("long").alias("rank"))


@query(f"""WITH {FIELDS}, t AS (SELECT unnest(['ation', 'er']) AS term),
h AS (SELECT doc_id, term, concat_ws('+', CASE WHEN title LIKE '%' || term || '%' THEN 'title' END, CASE WHEN body LIKE '%' || term || '%' THEN 'statement' END) AS f, (CASE WHEN title LIKE '%' || term || '%' THEN 4 ELSE 0 END + CASE WHEN body LIKE '%' || term || '%' THEN 2 ELSE 0 END) AS p FROM documents_f, t)
SELECT doc_id, string_agg(term || ':' || f || ':' || p, ';' ORDER BY term) AS reasons, sum(p)::BIGINT AS score FROM h WHERE p > 0 GROUP BY doc_id HAVING count(*) = 2""")
def q_lexical_explain(spark, sf_dir):
    found = ranking.scored(_fields(documents(spark, sf_dir)), "doc_id", _weights(), ranking.terms_of("er ation"))
    why = F.array_join(F.transform("reasons", lambda r: F.concat_ws(":", r["term"], F.array_join(r["fields"], "+"), r["points"].cast("string"))), ";")
    return found.select("doc_id", why.alias("reasons"), "score")


@query(f"""WITH {FIELDS}, t AS (SELECT unnest([1, 1, 2, 3]) AS query, unnest(['the', 'ing', 'tion', 'que']) AS term),
h AS (SELECT query, doc_id, (CASE WHEN title LIKE '%' || term || '%' THEN 4 ELSE 0 END + CASE WHEN body LIKE '%' || term || '%' THEN 2 ELSE 0 END) AS p FROM documents_f, t),
s AS (SELECT query, doc_id, sum(p)::BIGINT AS score FROM h WHERE p > 0 GROUP BY ALL HAVING count(*) = CASE WHEN query = 1 THEN 2 ELSE 1 END)
SELECT doc_id, (arg_max(query, score * 10 - query))::INT AS query, max(score) AS score FROM s GROUP BY doc_id""")
def q_lexical_batch(spark, sf_dir):
    asked = spark.createDataFrame([(1, ["the", "ing"]), (2, ["tion"]), (3, ["que"])], "query int, terms array<string>")
    return ranking.best(ranking.scored_batch(_fields(documents(spark, sf_dir)), "doc_id", _weights(), asked), "doc_id", "query")


@query("""SELECT doc_id, 'F-' || substr(sha256('["demo","' || source || '","' || doc_id || '"]'), 1, 24) AS logical_id,
'E-' || substr(sha256('["demo","' || source || '","' || doc_id || '","' || sha256(text) || '"]'), 1, 24) AS evidence_id, strlen(text)::BIGINT AS bytes FROM documents""")
def q_inventory_identity(spark, sf_dir):
    d = documents(spark, sf_dir)
    project, path = F.lit("demo"), F.col("doc_id").cast("string")
    return d.select("doc_id", identity.logical_id(project, F.col("source"), path).alias("logical_id"), identity.evidence_id(project, F.col("source"), path, F.sha2("text", 256)).alias("evidence_id"), F.octet_length("text").cast("long").alias("bytes"))


@query(f"WITH {PYTHON_LINES} SELECT doc_id, line_no::INT AS line_no, text FROM lines")
def q_line_explode(spark, sf_dir):
    return python_lines(documents(spark, sf_dir))


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://(.*)$', 1) AS path FROM pages
WHERE regexp_full_match(regexp_extract(url, '^[a-z]+://(.*)$', 1), '(?:[^/]+/)*[^/]*[0-9][^/]*') AND NOT regexp_full_match(regexp_extract(url, '^[a-z]+://(.*)$', 1), '[^/]*1[^/]*(?:/[^/]+)*')""")
def q_glob_filter(spark, sf_dir):
    path = F.regexp_extract("url", "^[a-z]+://(.*)$", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    digits = [f"**/*{i}*" for i in range(10)]
    return pages.where(globs.matches(F.col("path"), *digits) & ~globs.excluded(F.col("path"), "*1*/**"))


def _files(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.concat("lang", F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("relative_path"), F.lower("text").alias("folded"))


@query("SELECT doc_id FROM documents WHERE lang = 'de' OR lower(text) LIKE '%lyer%' OR lower(text) LIKE '%queoi%'")
def q_select_union(spark, sf_dir):
    return selection.chosen(_files(spark, sf_dir), globs=["de/**"], terms=["lyer", "queoi"], key="doc_id").select("doc_id")


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND source = 'src3' AND (lower(text) LIKE '%lyer%' OR lower(text) LIKE '%ating%')")
def q_select_intersection(spark, sf_dir):
    return selection.chosen(_files(spark, sf_dir), globs=["en/src3/*"], terms=["lyer", "ating"], composition="intersection", key="doc_id").select("doc_id")


@query(f"""WITH {SECOND} SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' WHEN sha256(o.text) = sha256(n.text) AND o.source = n.source THEN 'unchanged' ELSE 'modified' END AS change
FROM documents o FULL JOIN second n ON o.doc_id = n.doc_id""")
def q_delta_status(spark, sf_dir):
    d = documents(spark, sf_dir)
    sha = lambda x: x.select("doc_id", "source", F.sha2("text", 256).alias("sha256"))
    return delta.status(sha(d), sha(second(d)), "doc_id", ("sha256", "source"))


@query(f"""WITH {SECOND}, r AS (SELECT doc_id, source, sha256(text) AS h, count(*) OVER (PARTITION BY source, sha256(text)) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM second)),
a AS (SELECT doc_id, source, sha256(text) AS h FROM second WHERE doc_id NOT IN (SELECT doc_id FROM documents))
SELECT r.doc_id AS renamed_from, min(a.doc_id) AS renamed_to FROM r JOIN a ON r.source = a.source AND r.h = a.h WHERE r.n = 1 GROUP BY r.doc_id""")
def q_delta_rename(spark, sf_dir):
    d = documents(spark, sf_dir)
    sha = lambda x: x.select("doc_id", F.col("source").alias("source_id"), F.sha2("text", 256).alias("sha256"))
    return delta.renames(sha(d), sha(second(d)), "doc_id")


@query("SELECT d.doc_id, d.source, l.quality, l.toxic, l.doc_id IS NOT NULL AS has_provenance FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_provenance_left(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("known", F.lit(True))
    return documents(spark, sf_dir).select("doc_id", "source").join(labels, "doc_id", "left").select("doc_id", "source", "quality", "toxic", F.coalesce("known", F.lit(False)).alias("has_provenance"))


@query("SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0)")
def q_provenance_unused(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id").join(documents(spark, sf_dir).where("doc_id % 3 <> 0").select("doc_id"), "doc_id", "left_anti")


ISSUES = "issues AS (SELECT CASE WHEN n_chars < 100 THEN 'short_text' WHEN n_chars > 20000 THEN 'long_text' ELSE 'repeated_line' END AS code, source AS source_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id::VARCHAR END AS path FROM documents WHERE n_chars < 100 OR n_chars > 20000 OR doc_id % 7 = 0)"


def _issues(spark, sf_dir):
    code = F.when(F.col("n_chars") < 100, "short_text").when(F.col("n_chars") > 20000, "long_text").otherwise("repeated_line")
    return documents(spark, sf_dir).where("n_chars < 100 or n_chars > 20000 or doc_id % 7 = 0").select(code.alias("code"), F.col("source").alias("source_id"), F.when(F.col("doc_id") % 5 != 0, F.col("doc_id").cast("string")).alias("path"))


@query(f"WITH {ISSUES} SELECT code, count(*) AS n FROM issues GROUP BY code")
def q_warning_counts(spark, sf_dir):
    return _issues(spark, sf_dir).groupBy("code").agg(F.count("*").alias("n"))


@query(f"""WITH {ISSUES}, t AS (SELECT code, source_id AS s, coalesce(path, '') AS p FROM issues)
SELECT code, count(*) AS n, sha256('[' || string_agg('["' || code || '","' || s || '","' || p || '"]', ',' ORDER BY s, p) || ']') AS digest FROM t GROUP BY code""")
def q_issue_digest(spark, sf_dir):
    return coverage.warning_summary(_issues(spark, sf_dir))


@query("""SELECT code, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS doc_ids FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\\b[A-Z][a-z]{2,4}\\b')) AS code FROM documents WHERE lang = 'en' AND regexp_full_match(text, '[\\x00-\\x7F]*')) GROUP BY code""")
def q_by_code(spark, sf_dir):
    plain = documents(spark, sf_dir).where("lang = 'en'").where(F.col("text").rlike(r"\A[\x00-\x7F]*\z"))
    found = coverage.code_index(plain, r"\b[A-Z][a-z]{2,4}\b", "doc_id")
    return found.select("code", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("doc_ids"))


DISPOSED = "c AS (SELECT d.source, CASE WHEN l.toxic = 1 THEN 'triaged_out' WHEN l.quality = 1 AND d.doc_id % 4 = 0 THEN 'used' WHEN l.quality = 0 THEN 'deferred' WHEN l.quality = 1 THEN 'reviewed_no_record' END AS disposition, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _disposed(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("source", "lang", F.when(F.col("toxic") == 1, "triaged_out").when((F.col("quality") == 1) & (F.col("doc_id") % 4 == 0), "used").when(F.col("quality") == 0, "deferred").when(F.col("quality") == 1, "reviewed_no_record").alias("disposition"))


@query(f"""WITH {DISPOSED} SELECT source, lang, CASE min(CASE disposition WHEN 'used' THEN 1 WHEN 'deferred' THEN 2 WHEN 'triaged_out' THEN 3 WHEN 'reviewed_no_record' THEN 4 END) WHEN 1 THEN 'used' WHEN 2 THEN 'deferred' WHEN 3 THEN 'triaged_out' ELSE 'reviewed_no_record' END AS disposition FROM c GROUP BY source, lang""")
def q_rollup_priority(spark, sf_dir):
    return _disposed(spark, sf_dir).groupBy("source", "lang").agg(intervals.rollup(F.col("disposition")).alias("disposition"))


@query(f"""WITH {DISPOSED}, n AS (SELECT source, disposition, count(*) AS n FROM c WHERE disposition IS NOT NULL GROUP BY ALL) SELECT source, string_agg(disposition || '=' || n, ',' ORDER BY disposition) AS counts FROM n GROUP BY source""")
def q_disposition_counts(spark, sf_dir):
    c = coverage.counts(_disposed(spark, sf_dir).where("disposition is not null"), "disposition", ["source"])
    return c.select("source", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query("SELECT source, lang, count(*) AS files, sum(strlen(text))::BIGINT AS bytes, sum(strlen(text)) > 50000 AS over_budget FROM documents GROUP BY ALL")
def q_source_budgets(spark, sf_dir):
    size = F.sum(F.octet_length("text"))
    return documents(spark, sf_dir).groupBy("source", "lang").agg(F.count("*").alias("files"), size.cast("long").alias("bytes"), (size > 50000).alias("over_budget"))


def _fault(spark, sf_dir, kind):
    labels = table(spark, sf_dir, "labels").select("doc_id")
    declared = labels.unionByName(labels.where("doc_id % 9 = 0"))
    return coverage.faults(declared, documents(spark, sf_dir).where("doc_id % 10 <> 3").select("doc_id"), "doc_id").where(F.col("fault") == kind)


@query("SELECT doc_id, 'missing' AS fault FROM documents WHERE doc_id % 10 <> 3 AND doc_id NOT IN (SELECT doc_id FROM labels)")
def q_coverage_missing(spark, sf_dir):
    return _fault(spark, sf_dir, "missing")


@query("SELECT DISTINCT doc_id, 'unknown' AS fault FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 10 <> 3)")
def q_coverage_unknown(spark, sf_dir):
    return _fault(spark, sf_dir, "unknown")


@query("SELECT doc_id, 'duplicate' AS fault FROM labels WHERE doc_id % 9 = 0")
def q_coverage_dup(spark, sf_dir):
    return _fault(spark, sf_dir, "duplicate")


SPANS = "spans AS (SELECT l_suppkey AS k, (l_orderkey % 900 + 1)::INT AS a, (l_orderkey % 900 + 1 + l_linenumber)::INT AS b FROM lineitem)"


def _spans(spark, sf_dir):
    a = (F.col("l_orderkey") % 900 + 1).cast("int")
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), a.alias("start"), (a + F.col("l_linenumber")).cast("int").alias("end"))


@query(f"""WITH {SPANS}, o AS (SELECT *, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM spans),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR a > m + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM o)
SELECT k, min(a) AS "start", max(b) AS "end" FROM g GROUP BY k, g""")
def q_interval_merge(spark, sf_dir):
    return intervals.merged(_spans(spark, sf_dir), ["k"])


SEGS = "n AS (SELECT doc_id, len(string_split(text, chr(10)))::INT AS lines FROM documents), segs AS (SELECT doc_id, i * 10 + 1 AS a, least(i * 10 + 10, lines)::INT AS b FROM (SELECT doc_id, lines, unnest(range(((lines + 9) // 10)::INT))::INT AS i FROM n)), sel AS (SELECT doc_id, (doc_id % 5 + 2)::INT AS a, (doc_id % 5 + 2 + doc_id % 8)::INT AS b FROM documents)"


def _segments(spark, sf_dir):
    n = documents(spark, sf_dir).select("doc_id", F.size(F.split("text", "\n", -1)).alias("lines"))
    return n.select("doc_id", "lines", F.explode(F.sequence(F.lit(0), F.floor((F.col("lines") - 1) / 10))).alias("i")).select("doc_id", (F.col("i") * 10 + 1).cast("int").alias("start"), F.least(F.col("i") * 10 + 10, F.col("lines")).cast("int").alias("end"), F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("i").cast("string")).alias("segment_id"))


def _chosen(spark, sf_dir):
    a = F.col("doc_id") % 5 + 2
    return documents(spark, sf_dir).select("doc_id", a.cast("int").alias("start"), (a + F.col("doc_id") % 8).cast("int").alias("end"))


@query(f"""WITH {SEGS}, p AS (SELECT s.doc_id, s.a AS sa, s.b AS sb, unnest(list_distinct([s.a, greatest(r.a, s.a), CASE WHEN r.b < s.b THEN r.b + 1 ELSE s.a END])) AS a FROM segs s LEFT JOIN sel r ON s.doc_id = r.doc_id AND r.a <= s.b AND s.a <= r.b),
q AS (SELECT *, coalesce(lead(a) OVER (PARTITION BY doc_id, sa ORDER BY a) - 1, sb) AS b FROM (SELECT DISTINCT doc_id, sa, sb, coalesce(a, sa) AS a FROM p))
SELECT doc_id, sa AS seg_start, sb AS seg_end, a AS "start", b::INT AS "end", EXISTS (SELECT 1 FROM sel r WHERE r.doc_id = q.doc_id AND r.a <= q.a AND q.b <= r.b) AS selected FROM q""")
def q_interval_partition(spark, sf_dir):
    return intervals.partitioned(_segments(spark, sf_dir), _chosen(spark, sf_dir), ["doc_id"])


@query("""WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_quantity) AS q FROM lineitem GROUP BY ALL), d AS (SELECT k, n AS ordinal, n * 10 - 9 AS a, n * 10 + CASE WHEN q > 45 THEN 1 ELSE 0 END AS b, max(n) OVER (PARTITION BY k) * 10 AS e FROM l),
f AS (SELECT k, (a <> coalesce(lag(b) OVER o + 1, 1))::INT + (lead(a) OVER o IS NULL AND b <> e)::INT AS f FROM d WINDOW o AS (PARTITION BY k ORDER BY ordinal))
SELECT k, sum(f)::BIGINT AS faults FROM f GROUP BY k HAVING sum(f) > 0""")
def q_interval_cover_check(spark, sf_dir):
    from pyspark.sql import Window

    n = F.col("ordinal")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ordinal")).agg(F.max("l_quantity").alias("q"))
    rows = rows.select("k", "ordinal", (n * 10 - 9).alias("start"), (n * 10 + F.when(F.col("q") > 45, 1).otherwise(0)).alias("end"), F.lit(1).alias("seg_start"), (F.max(n).over(Window.partitionBy("k")) * 10).alias("seg_end"))
    return intervals.not_covering(rows, ["k"], "ordinal")


@query(f"""WITH {PYTHON_LINES}, l AS (SELECT doc_id, list([{{'a': line_no::INT, 'b': line_no::INT, 'chars': (300 + length(text) + 11)::INT}}] ORDER BY line_no) AS ls FROM lines GROUP BY doc_id),
f AS (SELECT doc_id, list_reduce(ls, lambda acc, x: CASE WHEN acc[len(acc)].chars + x[1].chars - 300 > 6000 THEN list_concat(acc, x) ELSE list_concat(acc[:len(acc) - 1], [{{'a': acc[len(acc)].a, 'b': x[1].b, 'chars': acc[len(acc)].chars + x[1].chars - 300}}]) END) AS ps FROM l),
p AS (SELECT doc_id, unnest(ps) AS p FROM f)
SELECT doc_id, row_number() OVER (ORDER BY doc_id, p.a) AS packet_no, p.a AS start_line, p.b AS end_line, p.chars AS chars FROM p""")
def q_packets_greedy(spark, sf_dir):
    return packets.packets(python_lines(documents(spark, sf_dir)), 6000, ["doc_id"], overhead=300, oversize="alone")


@query(f"""WITH {SEGS}, pts AS (SELECT doc_id, unnest([1, 7, 15, 400])::INT AS line FROM documents)
SELECT p.doc_id, p.line, coalesce(string_agg(s.doc_id || ':' || ((s.a - 1) // 10)::INT, ',' ORDER BY s.a), '') AS found FROM pts p LEFT JOIN segs s ON s.doc_id = p.doc_id AND p.line BETWEEN s.a AND s.b GROUP BY p.doc_id, p.line""")
def q_point_in_segment(spark, sf_dir):
    pts = documents(spark, sf_dir).select("doc_id", F.explode(F.array(*map(F.lit, (1, 7, 15, 400)))).alias("line"))
    return intervals.containing(pts, _segments(spark, sf_dir), ["doc_id"]).select("doc_id", "line", F.array_join("found", ",").alias("found"))


@query(f"WITH {SEGS} SELECT s.doc_id, s.a AS start, s.b AS \"end\", r.a AS b_start, r.b AS b_end FROM segs s JOIN sel r ON s.doc_id = r.doc_id AND s.a <= r.b AND r.a <= s.b")
def q_span_overlap(spark, sf_dir):
    return intervals.overlapping(_segments(spark, sf_dir).drop("segment_id"), _chosen(spark, sf_dir), ["doc_id"]).drop("b_doc_id")


@query(f"WITH {SEGS} SELECT r.doc_id, r.a AS start, r.b AS \"end\", arg_min(s.doc_id || ':' || ((s.a - 1) // 10)::INT, s.a) AS within FROM sel r LEFT JOIN segs s ON s.doc_id = r.doc_id AND s.a <= r.a AND r.b <= s.b GROUP BY ALL")
def q_span_within(spark, sf_dir):
    return intervals.within_first(_chosen(spark, sf_dir), _segments(spark, sf_dir), ["doc_id"])


QUOTES = f"{LINES}, q AS (SELECT a.doc_id AS file, a.doc_id * 1000 + a.line_no AS quote_id, a.line_no AS old_start, a.text || chr(10) || b.text AS quote, a.text AS t1, b.text AS t2 FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.line_no = a.line_no + 1), l2 AS (SELECT doc_id, 'inserted' AS text, 1 AS line_no FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, CASE WHEN line_no % 9 = 0 THEN text || '!' ELSE text END, line_no + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END FROM lines), places AS (SELECT q.quote_id, q.old_start, a.line_no AS start FROM q JOIN l2 a ON a.doc_id = q.file AND a.text = q.t1 JOIN l2 b ON b.doc_id = q.file AND b.text = q.t2 AND b.line_no = a.line_no + 1)"


def _quotes(spark, sf_dir):
    lines = exploded(documents(spark, sf_dir))
    nxt = lines.select("doc_id", (F.col("line_no") - 1).alias("line_no"), F.col("text").alias("t2"))
    q = lines.join(nxt, ["doc_id", "line_no"]).select(F.col("doc_id").alias("file"), (F.col("doc_id") * 1000 + F.col("line_no")).alias("quote_id"), F.col("line_no").alias("old_start"), F.concat("text", F.lit("\n"), "t2").alias("quote"))
    moved = lines.select(F.col("doc_id").alias("file"), (F.col("line_no") + F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0)).alias("line_no"), F.when(F.col("line_no") % 9 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"))
    new = documents(spark, sf_dir).where("doc_id % 2 = 0").select(F.col("doc_id").alias("file"), F.lit(1).alias("line_no"), F.lit("inserted").alias("text")).unionByName(moved)
    return q, new


@query(f"WITH {QUOTES} SELECT quote_id, start::INT AS start, (start + 1)::INT AS \"end\" FROM places")
def q_quote_places(spark, sf_dir):
    q, new = _quotes(spark, sf_dir)
    return quotes.located(q, new)


@query(f"""WITH {QUOTES}, b AS (SELECT quote_id, old_start, start, row_number() OVER (PARTITION BY quote_id ORDER BY abs(start - old_start), start) AS n FROM places)
SELECT q.quote_id, q.old_start::INT AS old_start, b.start::INT AS start, CASE WHEN b.start IS NULL THEN 'vanished' WHEN b.start = q.old_start THEN 'unchanged' ELSE 'moved' END AS status FROM q LEFT JOIN b ON b.quote_id = q.quote_id AND b.n = 1""")
def q_reanchor_nearest(spark, sf_dir):
    q, new = _quotes(spark, sf_dir)
    return quotes.anchored(q.select("quote_id", "old_start"), quotes.located(q, new, carried=("old_start",)))


@query(f"""WITH {QUOTES}, b AS (SELECT q.quote_id, CASE WHEN bool_or(a.quote_id IS NOT NULL AND a.start = q.old_start) THEN 'unchanged' WHEN bool_or(a.quote_id IS NOT NULL) THEN 'moved' ELSE 'vanished' END AS status FROM q LEFT JOIN places a ON a.quote_id = q.quote_id GROUP BY q.quote_id)
SELECT status, count(*) AS n FROM b GROUP BY status""")
def q_reanchor_histogram(spark, sf_dir):
    q, new = _quotes(spark, sf_dir)
    return quotes.anchorings(q, quotes.located(q, new)).groupBy("status").agg(F.count("*").alias("n"))


@query(f"""WITH {PYTHON_LINES}, c AS (SELECT doc_id, (doc_id % 4 + 1)::INT AS a, (doc_id % 4 + 1 + doc_id % 3)::INT AS b FROM documents), n AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id),
t AS (SELECT c.doc_id, c.a, c.b, string_agg(l.text, chr(10) ORDER BY l.line_no) AS held FROM c JOIN lines l ON l.doc_id = c.doc_id AND l.line_no BETWEEN c.a AND c.b GROUP BY ALL)
SELECT c.doc_id, c.a AS start, c.b AS \"end\", CASE WHEN c.doc_id % 19 = 0 THEN 'unknown_evidence' WHEN coalesce(n.n, 0) < c.b THEN 'bad_range' WHEN c.doc_id % 6 = 0 THEN 'wrong_quote' ELSE 'ok' END AS verdict FROM c LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)""")
def q_citation_exact(spark, sf_dir):
    d = documents(spark, sf_dir)
    lines = text.split_lines(F.col("text"))
    a = (F.col("doc_id") % 4 + 1).cast("int")
    b = (a + F.col("doc_id") % 3).cast("int")
    cites = d.select("doc_id", a.alias("start"), b.alias("end"), F.concat(text.quote(lines, a, b), F.when(F.col("doc_id") % 6 == 0, F.lit("x")).otherwise("")).alias("quote"))
    return quotes.checked(cites, d.where("doc_id % 19 <> 0").select("doc_id", lines.alias("lines")), "doc_id").drop("quote")


@query(f"WITH {LINES}, c AS (SELECT doc_id, (doc_id % 6 + 2)::INT AS a FROM documents) SELECT c.doc_id AS citation_id, l.line_no::INT AS line_no, l.text, l.line_no BETWEEN c.a AND c.a + 1 AS cited FROM c JOIN lines l ON l.doc_id = c.doc_id AND l.line_no BETWEEN c.a - 2 AND c.a + 3")
def q_citation_context(spark, sf_dir):
    a = (F.col("doc_id") % 6 + 2).cast("int")
    c = documents(spark, sf_dir).select(F.col("doc_id").alias("citation_id"), F.col("doc_id").alias("file"), a.alias("start"), (a + 1).alias("end"))
    return quotes.with_context(c, exploded(documents(spark, sf_dir)).withColumnRenamed("doc_id", "file"))


def _aliases(spark):
    rows = [("the", "p1"), ("and the", "p2"), ("inwh", "p1"), ("of the", "p3"), ("the the", "p4"), ("que", "p5"), ("de la", "p6"), ("la", "p7"), ("ing", "p8"), ("und die", "p9")]
    return spark.createDataFrame(rows, "alias string, target string").withColumn("words", F.split("alias", " "))


ASCII_TOKENS = f"{LINES}, w AS (SELECT doc_id, line_no, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM (SELECT doc_id, line_no, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM lines)), al AS (SELECT unnest(['the','and the','inwh','of the','the the','que','de la','la','ing','und die']) AS alias, unnest(['p1','p2','p1','p3','p4','p5','p6','p7','p8','p9']) AS target), m AS (SELECT w.doc_id, w.line_no, w.i AS a, w.i AS b, al.alias, al.target FROM w JOIN al ON w.token = al.alias UNION ALL SELECT w.doc_id, w.line_no, w.i, w.i + 1, al.alias, al.target FROM w JOIN w v ON w.doc_id = v.doc_id AND w.line_no = v.line_no AND v.i = w.i + 1 JOIN al ON w.token || ' ' || v.token = al.alias)"


def _ascii_mentions(spark, sf_dir):
    """Matches by numbers of words, so that SQL without spans can follow."""
    lines = exploded(documents(spark, sf_dir)).select("doc_id", "line_no", F.lower("text").alias("text"))
    return mentions.mentions_in(lines, _aliases(spark), ["doc_id", "line_no"], words=mentions.ascii_words, fold=str)


@query(f"WITH {ASCII_TOKENS} SELECT doc_id, alias, target, count(*) AS n FROM m GROUP BY ALL")
def q_alias_mentions(spark, sf_dir):
    return _ascii_mentions(spark, sf_dir).groupBy("doc_id", "alias", "target").agg(F.count("*").alias("n"))


@query(f"WITH {ASCII_TOKENS}, k AS (SELECT m.*, EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.line_no = m.line_no AND o.a <= m.b AND m.a <= o.b AND o.target <> m.target) AS amb FROM m) SELECT target, CASE WHEN amb THEN 'ambiguous_alias_overlap' ELSE 'explicit_alias_candidate' END AS classification, count(*) AS n FROM k GROUP BY ALL")
def q_alias_ambiguous(spark, sf_dir):
    return _ascii_mentions(spark, sf_dir).groupBy("target", "classification").agg(F.count("*").alias("n"))


@query()
def q_alias_unicode(spark, sf_dir):
    """Accents and case folded, with spans of characters and ids; beyond SQL, tested by hand."""
    lines = exploded(documents(spark, sf_dir)).withColumn("evidence_id", F.col("doc_id").cast("string"))
    known = mentions.alias_keys(spark.createDataFrame([("Éle", "p1"), ("Ciónes de", "p2"), ("und", "p3")], "alias string, target string"))
    found = mentions.mentions_in(lines, known, ["evidence_id", "line_no"])
    return mentions.identified(found, line="line_no")


@query("SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN doc_id % 4 = 0 THEN NULL ELSE n_chars END NULLS LAST, source, doc_id) AS place FROM documents")
def q_navigation_nulls_last(spark, sf_dir):
    from lodestrata.operators.views import placed

    d = documents(spark, sf_dir).select("doc_id", "source", F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("sort"))
    return placed(d, [F.asc_nulls_last("sort"), F.asc("source"), F.asc("doc_id")]).select("doc_id", "place")


@query(f"WITH {SECOND} SELECT n.doc_id, concat_ws(',', CASE WHEN o.lang <> n.lang THEN 'lang' END, CASE WHEN o.text <> n.text THEN 'text' END) AS fields FROM documents o JOIN second n ON o.doc_id = n.doc_id WHERE o.lang <> n.lang OR o.text <> n.text")
def q_changes_fields(spark, sf_dir):
    d = documents(spark, sf_dir)
    return delta.changed_fields(d.select("doc_id", "lang", "text", "source"), second(d), "doc_id", ["text", "lang", "source"]).select("doc_id", F.array_join("fields", ",").alias("fields"))


@query(f"""WITH {SECOND}, {LINES}, a AS (SELECT DISTINCT doc_id, text FROM lines), b AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS text FROM second),
x AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NULL AS up, b.doc_id IS NULL AS down FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.text = b.text)
SELECT doc_id, count(*) FILTER (up) AS added, count(*) FILTER (down) AS removed FROM x GROUP BY doc_id HAVING count(*) FILTER (up OR down) > 0""")
def q_quote_setdiff(spark, sf_dir):
    d = documents(spark, sf_dir)
    rows = lambda x: exploded(x).select("doc_id", "text")
    return delta.set_difference(rows(d), rows(second(d)), "doc_id")


@query("SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'), ' ') AS line, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html, printf('L%06d | ', doc_id) AS label FROM documents")
def q_rendering(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.collapsed(F.col("text")).alias("line"), text.escaped_html(F.col("text")).alias("html"), F.format_string("L%06d | ", "doc_id").alias("label"))
