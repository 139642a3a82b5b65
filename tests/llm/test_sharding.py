import random
import zlib

import pytest

from lodestrata.llm import sharding


def table(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = [(i, "é" * r.choice([3, 50, 50, 400, 2000]), r.choice(["en", "de"]), "hot" if r.random() < 0.4 else f"s{r.randrange(9)}", 0) for i in range(n)]
    rows = [(i, t, l, s, len(t)) for i, t, l, s, _ in rows] + [(n, None, None, None, None), (n + 1, "", "en", "hot", 0), (5, "again", "en", "hot", 5), (5, "again", "en", "hot", 5), (None, "none", "de", "hot", 4)]
    return rows, spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, shard string").repartition(5)


@pytest.mark.parametrize("shards", [16, 5, 1])
def test_all_rows_near_equal_bytes_and_gapless_slots(spark, shards):
    rows, df = table(spark)
    got = sharding.sharded(df, shards=shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(d), size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(shards))
    mean = sum(r.size for r in got) / shards
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r.size for r in part) - mean) <= 4 * 4001
        ids = [r.doc_id for r in sorted(part, key=lambda r: r.slot) if r.doc_id is not None]
        assert ids == sorted(ids)


def test_target_bytes(spark):
    rows, df = table(spark)
    got = sharding.sharded(df, target=200_000)
    most = got.groupBy("shard").sum("size").agg({"sum(size)": "max"}).first()[0]
    assert most <= 220_000


def test_one_value_and_empty(spark):
    df = spark.createDataFrame([(i, "same", "en", "s", 4) for i in range(64)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["count"] for r in sharding.sharded(df, shards=16).groupBy("shard").count().collect()) == [4] * 16
    assert sharding.sharded(df.where("false"), shards=16).count() == 0


def test_write_keeps_rows_and_columns(spark, tmp_path):
    rows, df = table(spark, 200)
    sharding.write_shards(df.drop("shard"), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and set(back.columns) == set(df.columns)


def test_more_leaves_than_nodes_are_refused_by_target_too(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NODES", 3)
    df = spark.createDataFrame([(i, "x" * 99, 99, "s", "en") for i in range(10)], "doc_id long, text string, n_chars long, source string, lang string")
    for asked in ({"shards": 4}, {"target": 250}):
        with pytest.raises(ValueError, match="at most 3 leaves"):
            sharding.sharded(df, **asked)
    assert sharding.sharded(df, target=500).count() == 10


def test_every_cut_is_a_weighted_median_of_the_widest_dimension(spark):
    """The tree against the definition, node by node, on values that share beginnings, are negative, fractional or missing."""
    r = random.Random(5)
    rows = [(i, "x" * r.choice([0, 10, 10, 300]), f"https://example.org/a/very/long/path/{r.randrange(40)}", r.choice([None, -5.5, -5.25, 0.125, 1e9]) if i % 3 else r.random(), r.choice([1, 10, 11, 19])) for i in range(500)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, url string, score double, src long, size long")
    t = sharding._prepared(df, ["url", "score", "src"])
    tree = sharding.plan(t, 3, 8, None)
    data = [x.asDict() for x in t.collect()]
    total = {}

    def ordered(values):
        known = sorted({v for v in values if v is not None})
        return {None: 0} | {v: i + 1 for i, v in enumerate(known)}

    by_id = {x[0]: x for x in rows}
    ranks = [ordered([x[j] for x in rows]) for j in (2, 3, 4)]
    for x in data:
        for i, j in enumerate((2, 3, 4)):
            assert x[f"k{i}"] >> sharding.HASH_BITS == ranks[i][by_id[x["doc_id"]][j]]

    def value(x, i):
        v = by_id[x["doc_id"]][2 + i]
        return float(ranks[0][v]) if i == 0 else None if v is None else float(v)

    def width(part, i):
        v = [value(x, i) for x in part if value(x, i) is not None]
        return max(v) - min(v) if v else 0.0

    whole = [width(data, i) for i in range(3)]

    def check(node, part):
        n = tree[node]
        if "left" not in n:
            total[n["shard"]] = sum(x["size"] for x in part)
            return
        widths = [width(part, i) / whole[i] for i in range(3)]
        assert n["dim"] == max(range(3), key=lambda i: widths[i])
        left = [x for x in part if x[f"k{n['dim']}"] < n["cut"]]
        right = [x for x in part if x[f"k{n['dim']}"] >= n["cut"]]
        assert abs(sum(x["size"] for x in left) - n["share"]) <= max(x["size"] for x in part)
        check(n["left"], left)
        check(n["right"], right)

    check(0, data)
    assert sorted(total) == list(range(8)) and max(total.values()) - min(total.values()) <= 4 * 301


def test_a_very_long_text_and_many_equal_rows(spark):
    rows = [(7, "same", "en", "s", 4)] * 300 + [(8, "long " * 400_000, "en", "s", 2_000_000)]
    df = spark.createDataFrame([(*x, "a") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, __id string")
    counts = {r.shard: r["count"] for r in sharding.sharded(df.where("doc_id = 7"), shards=4).groupBy("shard").count().collect()}
    assert len(counts) == 4 and max(counts.values()) - min(counts.values()) <= 8
    assert sharding.sharded(df, shards=4).count() == 301
