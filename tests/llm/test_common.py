import pyarrow as pa
from pyspark.sql import functions as F

from lodestrata.llm import common
from lodestrata.llm.common import hashed_share, numbered


def test_a_share_holds_the_rows_of_least_hash(spark):
    df = spark.range(50_000).withColumn("h", F.xxhash64("id"))
    for rows in (100, 3000, 40_000):
        kept = df.where(hashed_share(F.col("h"), rows, 50_000))
        assert rows <= kept.count() <= max(1.3 * rows + 400, 50_000 * (rows == 40_000))
        assert kept.orderBy("h").limit(rows).agg(F.sum("id")).first() == df.orderBy("h").limit(rows).agg(F.sum("id")).first()
    assert df.where(hashed_share(F.col("h"), 10, 0)).count() == 50_000


def test_numbers_are_gapless_within_hot_groups(spark):
    df = spark.createDataFrame([(("hot" if i % 3 else f"g{i % 7}"), i, i % 2) for i in range(3000)] + [(None, 1, 1), (None, 1, 1)], "g string, i long, slot_of long").repartition(9)
    got = numbered(df, ["g"], ["i"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append(r)
    assert len(got) == 3002
    for rows in by.values():
        rows.sort(key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(rows))) and [r.i for r in rows] == sorted(r.i for r in rows)


def test_workers_give_memory_back_within_a_task(spark, monkeypatch):
    """Not only at a task's end: workers share the executor's memory while they run."""
    seen, calls = {}, []

    class Frame:
        sparkSession = spark

        def mapInArrow(self, run, schema):
            seen["run"] = run

    monkeypatch.setattr(common, "released", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * (6 << 20)])], ["text"])
    common.in_batches(Frame(), lambda: lambda b: [b], "text string")
    assert len(list(seen["run"](iter([batch] * 9)))) == 9
    assert len(calls) == 4  # after each third batch, and at the end
