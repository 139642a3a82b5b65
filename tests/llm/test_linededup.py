import random
import re

from lodestrata.llm import linededup


def brute(rows, least):
    """Deleted line positions of each document, by comparing everything with everything."""
    docs = {}
    for d, t in rows:
        if t is not None:
            docs[d is None, d, t] = None
    order = sorted(docs, key=lambda x: (x[0], x[1] if x[1] is not None else 0))
    lines = {k: [(i, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate(k[2].split("\n"))] for k in order}
    lines = {k: [x for x in v if x[2]] for k, v in lines.items()}
    first, gone = {}, {k: set() for k in order}
    for k in order:
        runs = {}
        for r in range(len(lines[k])):
            m, s = 0, 0
            while r + m < len(lines[k]) and s < least:
                s += lines[k][r + m][2]
                m += 1
            if s < least:
                continue
            held = tuple(x[1] for x in lines[k][r : r + m])
            fk, fr, fm = first.setdefault(held, (k, r, m))
            if fk != k or r > fr + fm - 1:
                runs.setdefault((fk, fr - r), []).append((r, r + m - 1))
        for (fk, d), spans in runs.items():
            own, its = lines[k], lines[fk]
            same = lambda r: 0 <= r < len(own) and 0 <= r + d < len(its) and own[r][1] == its[r + d][1]  # noqa: B023, E731
            merged = []
            for a, b in sorted(spans):
                if merged and a <= merged[-1][1] + 1:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            for a, b in merged:
                lo, hi = a, b
                while same(lo - 1) and a - lo < least - 1:
                    lo -= 1
                while same(hi + 1) and hi - b < least - 1:
                    hi += 1
                gone[k] |= set(range(lo, hi + 1))
    out = {}
    for k in order:
        ranks, at = sorted(gone[k]), set()
        for i, r in enumerate(ranks):
            at.add(lines[k][r][0])
            if i and ranks[i - 1] == r - 1:
                at |= set(range(lines[k][r - 1][0], lines[k][r][0]))
        out[k] = "\n".join(x for i, x in enumerate(k[2].split("\n")) if i not in at)
    return out


def corpus(seed):
    r = random.Random(seed)
    line = lambda: " ".join(r.choice("abcdefgh") * 2 for _ in range(r.choice([1, 2, 3, 9])))
    pool = [line() for _ in range(40)]
    passages = [[r.choice(pool) for _ in range(r.randrange(2, 9))] for _ in range(12)]
    rows = []
    for i in range(60):
        t = []
        for _ in range(r.randrange(1, 5)):
            t += r.choice(passages) if r.random() < 0.7 else [r.choice(["", " ", line()])]
        rows.append((i, "\n".join(t)))
    return rows


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed) + [(100, None), (101, ""), (102, "\n\n"), (None, corpus(seed)[3][1]), (5, corpus(seed)[5][1]), (5, "other text\n" * 30), (103, "x y z\n" * 300)]
        df = spark.createDataFrame([(d, t, "keep", 1) for d, t in rows], "doc_id long, text string, k string, pos int").repartition(3)
        want = brute(rows, 10)
        got = linededup.deduplicated(df, 10)
        assert got.columns == df.columns
        got = [(r.doc_id, r.text) for r in got.collect()]
        assert sorted(got, key=str) == sorted(((d, None if t is None else want[d is None, d, t]) for d, t in rows), key=str)
        assert any(t != want[False, d, t] for d, t in rows if t and d is not None)


def test_a_copy_of_each_line_stays(spark):
    rows = corpus(4)
    got = linededup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    assert {x for _, t in rows for x in t.split("\n") if x.strip()} == {x for r in got for x in r.text.split("\n") if x.strip()}


def test_empty_table(spark):
    assert linededup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_names_that_clash_and_long_texts(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"one\n{passage}", 1, 2), (2, f"{passage}\ntwo", 3, 4), (3, "\n".join(f"line {i % 7000}" for i in range(20_000)), 5, 6), (4, None, 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __k long, __gone long")
    out = {r.doc_id: r for r in linededup.deduplicated(df).collect()}
    assert out[2].text == "two" and out[1].text == rows[0][1] and out[4].text is None and (out[2]["__k"], out[2]["__gone"]) == (3, 4)
    assert len(out[3].text.split("\n")) == 7000
