import random

import numpy as np
import pytest

from lodestrata.llm import simhash


def brute(rows, radius=4):
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                part[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, p, least.get(find(i))) for i, (d, p) in enumerate((d, simhash.fingerprint(t or "")) for d, t in rows)), key=str)


def texts(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    base = [[r.choice(words) for _ in range(r.choice([3, 40, 300]))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2])):
            t[r.randrange(len(t))] = r.choice(words)
        rows.append((i, " ".join(t)))
    return rows


ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "One two"), (904, "ONE  two"), (None, "one two"), (905, "É é"), (906, "x " * 70_000), (906, "x " * 70_000)]


@pytest.mark.parametrize("limit", [simhash.BRUTE, 2])
def test_components_equal_brute_force(spark, limit):
    rows = texts(160, 7) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.components(df, brute=limit).collect()), key=str)
    assert got == brute(rows)


def test_masks_cover_every_set_of_positions():
    masks = [m % (1 << 64) for m in simhash.covering_masks(4)]
    assert len(masks) == 31
    r = random.Random(3)
    for _ in range(20_000):
        bits = sum(1 << i for i in r.sample(range(64), 4))
        assert any(not bits & m for m in masks)


def test_representatives_keep_columns_and_one_of_each_group(spark):
    rows = texts(60, 9) + ODD
    df = spark.createDataFrame([(d, t, "en", d) for d, t in rows], "doc_id long, text string, fp string, k long")
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in brute(rows) if c is not None}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_masks_in_parts_cover():
    masks = simhash.tables(128, 3, 4)
    assert len(masks) == 93
    whole = lambda m: sum((w % (1 << 64)) << 64 * i for i, w in enumerate(m))
    r = random.Random(3)
    for _ in range(3000):
        bits = sum(1 << i for i in r.sample(range(128), 14))
        assert any(not bits & whole(m) for m in masks)


@pytest.mark.parametrize("limit", [simhash.BRUTE, 5])
def test_near_duplicates_by_similarity(spark, limit):
    r = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    rows, want = [], {}
    for group in range(25):
        base = [r.choice(words) for _ in range(r.choice([120, 300]))]
        for _ in range(r.randrange(1, 5)):
            t = list(base)
            for _ in range(len(t) // 120):
                t[r.randrange(len(t))] = r.choice(words)
            want[len(rows)] = group
            rows.append((len(rows), " ".join(t)))
    rows += [(2000, rows[0][1].upper()), (2001, None), (2002, ""), (2003, "one two"), (2003, "one two"), (2004, "two one"), (None, rows[3][1])]
    df = spark.createDataFrame([(d, t, "en", 1, 2) for d, t in rows], "doc_id long, text string, c string, k long, __k long")
    kept = simhash.near_representatives(df, brute=limit)
    assert kept.columns == df.columns
    got = sorted(x.doc_id for x in kept.collect())
    sets = [set(simhash.shingles(t or "", 5)) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [min(a, b) if x in (a, b) else x for x in part]
    first = {}
    for (d, _), p in zip(rows, part, strict=True):
        first[p] = min(first.get(p, 1e9), 1e9 if d is None else d)
    assert got == sorted(first.values())


def joined(sets, similarity=0.8):
    part = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [min(a, b) if x in (a, b) else x for x in part]
    return part


@pytest.mark.parametrize("limit", [simhash.BRUTE, 5])
def test_near_duplicates_whose_words_differ_much(spark, limit):
    """Texts of few kinds of words: a few new ones change most of a fingerprint over kinds, and few of the shingles. Whole passages recur, and links make chains."""
    r = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for group in range(16):
        base = [r.choice([f"a{group}", f"b{group}", "c", "d"]) for _ in range(160)]
        for copy in range(r.randrange(1, 5)):
            base = base + [f"n{group}x{copy}x{i}" for i in range(r.choice([4, 12, 30]))]
            rows.append((len(rows), " ".join(base + (passage if group % 2 else []))))
    rows += [(len(rows) + i, " ".join(["x"] * n)) for i, n in enumerate([5, 6, 900])] + [(900, " ".join(passage)), (901, " ".join(passage[:37])), (902, " ".join(passage[:30]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(x.doc_id for x in simhash.near_representatives(df, brute=limit).collect())
    part = joined([set(simhash.shingles(t, 5)) for _, t in rows])
    assert got == sorted({p: d for (d, _), p in reversed(list(zip(rows, part, strict=True)))}.values())


def test_first_shingles_meet():
    """Sets so similar share a first shingle, and as many as the bound that `_possible` uses says, whatever is frequent."""
    r, met = random.Random(8), 0
    for _ in range(3000):
        similarity = r.choice([0.5, 0.8, 0.9, 1.0])
        a = {r.randrange(-60, 60) for _ in range(r.randrange(1, 50))}
        b = {x for x in a if r.random() < 0.95} | {r.randrange(-60, 60) for _ in range(r.randrange(4))} or {0}
        if len(a & b) < similarity * len(a | b):
            continue
        often = np.array(sorted(r.sample(range(-60, 60), r.randrange(40))), np.int64)
        places = np.array(r.sample(range(1, len(often) + 1), len(often)), np.int64)
        (n1, rest1, *end1, first1), (n2, rest2, *end2, first2) = (simhash.first_of(np.array(sorted(x), np.int64), similarity, often, places) for x in (a, b))
        s, need = len(set(first1) & set(first2)), similarity / (1 + similarity) * (n1 + n2) - 1e-6
        assert s and (end1 > end2 or s + rest1 >= need) and (end2 > end1 or s + rest2 >= need)
        met += 1
    assert met > 500


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5), (2, "a b c d e", 6), (3, "x", 7)], "doc_id long, text string, __key long")
    assert sorted(simhash.representatives(df).collect()) == sorted(simhash.near_representatives(df).collect()) == [(1, "a b c d e", 5), (3, "x", 7)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.components(df).count() == 0 and simhash.representatives(df).count() == 0
