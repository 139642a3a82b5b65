"""Queries on events, orders and runs, and streams over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import dates
from lodestrata.operators import coverage, delta, intake, views
from lodestrata.plans.registry import query, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY user_id")
def q_source_types_per_event(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("user_id").agg(F.array_join(coverage.sorted_set("event_type"), ",").alias("types"))


@query("WITH k AS (SELECT DISTINCT event_type AS k FROM events), u AS (SELECT user_id, list(DISTINCT event_type) AS have, bool_or(value > 400) AS r FROM events GROUP BY user_id) SELECT user_id, coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM k WHERE NOT list_contains(have, k)), '') AS missing, r AS has_relation FROM u")
def q_milestone(spark, sf_dir):
    e = _events(spark, sf_dir)
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())  # the kinds of an enumeration
    return coverage.milestone(e, "user_id", "event_type", kinds, F.col("value") > 400).select("user_id", F.array_join("missing", ",").alias("missing"), "has_relation")


@query("""SELECT o_orderkey AS event_id, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END NULLS LAST, o_orderkey, o_custkey, o_orderpriority) AS place FROM orders""")
def q_timeline(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "known").when(F.col("o_orderstatus") == "O", "unknown").otherwise("conflicting")
    e = o.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("record_id"), status.alias("status"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("sort_ts"), F.col("o_orderpriority").alias("text"))
    return views.timeline(e).select("event_id", "place")


NAMES = "n AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'call ' || strftime(o_orderdate, '%Y_%m_%d') || ' 12_00 GMT-05_00 notes' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || '-kickoff' WHEN 2 THEN 'x_' || strftime(o_orderdate, '%Y_%m_%d') || '.md' WHEN 3 THEN '2026-13-45 and ' || strftime(o_orderdate, '%Y_%m_%d') ELSE 'no date' END AS name, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"


@query(f"WITH {NAMES} SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN day || 'T12:00:00-05:00' WHEN 4 THEN NULL ELSE day END AS value, CASE o_orderkey % 5 WHEN 0 THEN 'minute' WHEN 4 THEN NULL ELSE 'day' END AS precision FROM n")
def q_content_date(spark, sf_dir):
    d = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 5
    name = F.when(k == 0, F.concat(F.lit("call "), d("yyyy_MM_dd"), F.lit(" 12_00 GMT-05_00 notes"))).when(k == 1, F.concat(d("yyyy-MM-dd"), F.lit("-kickoff"))).when(k == 2, F.concat(F.lit("x_"), d("yyyy_MM_dd"), F.lit(".md"))).when(k == 3, F.concat(F.lit("2026-13-45 and "), d("yyyy_MM_dd"))).otherwise("no date")
    found = dates.in_name(name)
    return table(spark, sf_dir, "orders").select("o_orderkey", found["value"].alias("value"), found["precision"].alias("precision"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' END AS precision, CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', o_orderdate) WHEN 1 THEN date_trunc('month', o_orderdate) WHEN 2 THEN date_trunc('day', o_orderdate) END::TIMESTAMP AS sort_ts FROM orders")
def q_partial_dates(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    value = F.when(k == 0, F.date_format("o_orderdate", "yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-99-dd"))
    p = dates.partial(value)
    return table(spark, sf_dir, "orders").select("o_orderkey", p["precision"].alias("precision"), p["sort_ts"].cast("timestamp_ntz").alias("sort_ts"))


@query("""WITH o AS (SELECT user_id, event_type, ts, event_id FROM events), c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was, event_id FROM o)
SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM c WHERE was IS NULL OR was <> event_type""")
def q_scd_intake(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    out = intake.slowly_changing(e, "user_id", "event_type", "at")
    return out.select("user_id", "event_type", F.col("valid_from.ts").alias("valid_from"), F.col("valid_to.ts").alias("valid_to"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) AS decisions FROM events GROUP BY user_id")
def q_last_decision(spark, sf_dir):
    e = _events(spark, sf_dir)
    return intake.last_decision(e.unionByName(e.where("event_id % 10 = 0")), "user_id", ["ts", "event_id"], ["event_type"])


@query("SELECT event_id AS item_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events")
def q_predecessor(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    return intake.predecessor(e, "user_id", "at", "event_id").select(F.col("event_id").alias("item_id"), "previous")


@query("SELECT user_id, max(event_id) AS run_id, max(value) AS top FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 GROUP BY user_id")
def q_latest_run(spark, sf_dir):
    b = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return _events(spark, sf_dir).groupBy("user_id").agg(b.alias("b")).select("user_id", F.col("b.event_id").alias("run_id"), F.col("b.value").alias("top"))


@query("WITH r AS (SELECT event_id, user_id, event_id % 50 AS s, ts, event_type <> 'error' AS ready FROM events), b AS (SELECT * FROM r WHERE event_id = 100) SELECT r.event_id AS run_id FROM r, b WHERE r.user_id = b.user_id AND (r.s, r.ts) > (b.s, b.ts) AND r.ready")
def q_newer_than_baseline(spark, sf_dir):
    runs = _events(spark, sf_dir).select(F.col("event_id").alias("run_id"), F.col("user_id").alias("project_id"), (F.col("event_id") % 50).alias("sequence"), F.col("ts").alias("created_at"), F.when(F.col("event_type") != "error", "ready").otherwise("blocked").alias("status"))
    return delta.newer_than(runs, 100).select("run_id")


@query("""WITH l AS (SELECT event_id, 'd' || event_id % 3 AS digest FROM events WHERE event_id % 6 <> 1), v AS (SELECT event_id, 'd' || CASE WHEN event_id % 11 = 0 THEN 9 ELSE event_id % 3 END AS digest, event_id // 4 AS family, event_id % 4 = 3 OR event_id % 16 = 1 AS cur, event_id % 13 <> 0 AS auth FROM events WHERE event_id % 7 <> 3),
a AS (SELECT DISTINCT family FROM v WHERE cur AND auth)
SELECT coalesce(v.event_id, l.event_id) AS item_id, CASE WHEN v.event_id IS NULL THEN 'unavailable' WHEN NOT auth THEN 'unauthorized' WHEN NOT cur AND a.family IS NOT NULL THEN 'superseded' WHEN NOT cur THEN 'withdrawn' WHEN l.digest <> v.digest THEN 'stale' ELSE 'current' END AS status FROM l FULL JOIN v ON l.event_id = v.event_id LEFT JOIN a ON a.family = v.family""")
def q_intake_states(spark, sf_dir):
    i = F.col("event_id")
    e = _events(spark, sf_dir)
    ledger = e.where("event_id % 6 <> 1").select(i.alias("item_id"), F.lit("current").alias("status"), F.concat(F.lit("d"), (i % 3).cast("string")).alias("digest"))
    seen = e.where("event_id % 7 <> 3").select(i.alias("item_id"), F.concat(F.lit("d"), F.when(i % 11 == 0, 9).otherwise(i % 3).cast("string")).alias("digest"), F.floor(i / 4).alias("family"), ((i % 4 == 3) | (i % 16 == 1)).alias("current"), (i % 13 != 0).alias("authorised"))
    return intake.discovered(ledger, seen).select("item_id", "status")


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def q_json_props(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def e_tumbling(spark, sf_dir):
    from lodestrata.streaming.events import replayed, tumbling

    return replayed(spark, f"{sf_dir}/events.parquet", lambda e: tumbling(e, "1 day"), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("SELECT (d - INTERVAL 1 day * i)::TIMESTAMP AS start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 day, ts) AS d FROM events), (SELECT unnest([0, 1]) AS i) GROUP BY ALL")
def e_sliding(spark, sf_dir):
    from lodestrata.streaming.events import replayed, sliding

    return replayed(spark, f"{sf_dir}/events.parquet", lambda e: sliding(e, "2 days", "1 day"), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("WITH g AS (SELECT user_id, ts, (ts > lag(ts) OVER w + INTERVAL 6 hour)::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(coalesce(new, 1)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 hour AS \"end\", count(*) AS n FROM s GROUP BY user_id, s")
def e_session(spark, sf_dir):
    from lodestrata.streaming.events import replayed, sessions

    return replayed(spark, f"{sf_dir}/events.parquet", lambda e: sessions(e, "6 hours"), "complete").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT event_id, user_id FROM events")
def e_dedup_watermark(spark, sf_dir):
    from lodestrata.streaming.events import deduplicated, replayed

    return replayed(spark, f"{sf_dir}/events.parquet", lambda e: deduplicated(e.unionByName(e), ["event_id", "ts"], "30 days").select("event_id", "user_id"), "append")


@query("SELECT event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY event_type")
def e_filesource_delta(spark, sf_dir):
    from lodestrata.streaming.events import latest_by_batches

    return latest_by_batches(spark, f"{sf_dir}/events.parquet")
