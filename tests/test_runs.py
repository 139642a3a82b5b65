import pytest
from pyspark.sql import functions as F

from lodestrata.operators import context, runs
from lodestrata.sources import sinks


def test_only_what_changed_runs_again(spark, tmp_path):
    root = str(tmp_path / "run")
    stages = [("double", lambda s, t: t["numbers"].select((F.col("n") * 2).alias("n"))), ("sum", lambda s, t: t["double"].agg(F.sum("n").alias("n")))]
    numbers = spark.createDataFrame([(1,), (2,)], "n long")
    tables, ran = runs.run(spark, root, {"numbers": numbers}, stages)
    assert ran == ["double", "sum"] and tables["sum"].first().n == 6
    assert runs.run(spark, root, {"numbers": numbers.repartition(2)}, stages)[1] == []
    tables, ran = runs.run(spark, root, {"numbers": numbers.unionByName(numbers)}, stages)
    assert ran == ["double", "sum"] and tables["sum"].first().n == 12
    assert sorted(runs.receipts(spark, root)) == ["double", "sum"]


def test_half_written_tables_are_not_taken(spark, tmp_path):
    root = str(tmp_path / "run")
    numbers = spark.createDataFrame([(1,), (2,)], "n long")

    def broken(s, t):
        return t["numbers"].select(F.raise_error(F.lit("no")).cast("long").alias("n"))

    with pytest.raises(Exception, match="no"):
        runs.run(spark, root, {"numbers": numbers}, [("double", broken)])
    tables, ran = runs.run(spark, root, {"numbers": numbers}, [("double", lambda s, t: t["numbers"].select((F.col("n") * 2).alias("n")))])
    assert ran == ["double"] and tables["double"].count() == 2


def test_digests_know_columns_nulls_and_copies(spark):
    d = lambda rows: sinks.digest(spark.createDataFrame(rows, "a string, b string"))
    assert len({d(x) for x in ([("x", None)], [(None, "x")], [("x", "x")], [("x", None)] * 2, [])}) == 5
    assert d([("x", None), ("y", "z")]) == d([("y", "z"), ("x", None)])


def test_context_bundle(spark):
    scores = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (1, "b", 4)], "query int, key string, score long")
    edges = spark.createDataFrame([("a", "c"), ("b", "z")], "src string, dst string")
    entries = spark.createDataFrame([(k, "x" * 10) for k in "abcd"], "key string, payload string")
    got = context.bundle(scores, edges, entries, ["d"], max_bytes=35)
    assert [(r.key, r.place) for r in got.orderBy("place").collect()] == [("d", 1), ("a", 2), ("b", 3)]
    with pytest.raises(ValueError):
        context.bundle(scores, edges, entries, ["q"])
    with pytest.raises(ValueError):
        context.bundle(scores, edges, entries, ["d"], max_bytes=5)


def test_assertion_views(spark):
    a = spark.createDataFrame([("a", "equivalent_to", "b", "observed"), ("b", "equivalent_to", "c", "proposed"), ("a", "supersedes", "b", "observed"), ("b", "supersedes", "a", "interpretation"), ("a", "refines", "gone", "observed")], "owner string, type string, target string, status string")
    e = spark.createDataFrame([("a", "current"), ("b", "current"), ("c", "historical")], "key string, visibility string")
    v = context.assertion_views(a, e)
    assert [r.members for r in v["equivalents"].collect()] == [["a", "b"]]
    assert sorted((r.src, r.dst) for r in v["cycles"].collect()) == [("a", "b"), ("b", "a")]
    assert [(r.lo, r.hi, r.types) for r in v["opposing"].collect()] == [("a", "b", ["equivalent_to", "supersedes"])]
    assert {r.target_state for r in v["targets"].where("target = 'gone'").collect()} == {"unavailable"}


def test_scopes_delete_what_is_not_kept(spark):
    import os

    from lodestrata.session import scope, shared_dir, written

    folder = shared_dir(spark).removeprefix("file://") + "/written"
    numbers = spark.range(5)
    with scope(spark):
        kept = written(numbers, "kept", keep=True)
        written(numbers, "scratch")
        assert any(n.startswith("scratch-") for n in os.listdir(folder))
    assert not any(n.startswith("scratch-") for n in os.listdir(folder)) and kept.count() == 5


def test_a_stream_goes_on_from_its_last_version(spark, tmp_path):
    from lodestrata.streaming.events import latest_by_batches

    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), (F.col("id") % 3).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    source, out = f"{tmp_path}/events", f"{tmp_path}/out"
    rows(0, 10).coalesce(1).write.mode("append").parquet(source)
    assert [(r.n, r.last) for r in latest_by_batches(spark, source, out).collect()] == [(10, 9)]
    rows(10, 14).coalesce(1).write.mode("append").parquet(source)
    assert [(r.n, r.last) for r in latest_by_batches(spark, source, out).collect()] == [(14, 13)]
