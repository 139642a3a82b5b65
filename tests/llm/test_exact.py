import hashlib
import random
import re

from lodestrata.llm import exact


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, x in enumerate(norm):
        groups.setdefault(x, []).append(i)
    out = []
    for x, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        out += [(rows[i][0], rows[best][0], len(members), hashlib.sha256(x.encode()).hexdigest()) for i in members]
    return sorted(out, key=str), len(groups)


def test_equals_brute_force(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["hot text", "hot  text", "a b", "ab ", "é", "é\t", " x", f"u{i % 50}"])) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "\n \x0b"), (903, " "), (903, " "), (None, "a b"), (904, "long " * 50_000), (905, "long " * 50_000 + " ")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int").repartition(4)
    for parts in ("4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = exact.classes(df).collect()
        want, groups = brute(rows)
        assert sorted(((x.doc_id, x.keep_id, x.group_size, x.sha) for x in got), key=str) == want
        assert sum(x.kept for x in got) == groups and all(x.doc_id == x.keep_id for x in got if x.kept)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    kept = exact.deduplicated(df)
    assert kept.columns == df.columns and kept.select("doc_id").distinct().count() == groups


def test_empty_table(spark):
    assert exact.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_names_that_clash_and_heads_that_are_equal(spark):
    head = "a" * 500
    rows = [(1, head + "x", "p", "q"), (2, head + " x", "p", "q"), (3, head + "y", "p", "q"), (4, "é" * 100, "p", "q"), (5, "é " * 100, "p", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string, __sha string")
    kept = exact.deduplicated(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
