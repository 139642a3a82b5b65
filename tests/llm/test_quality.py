import random
import re
from collections import Counter

from lodestrata.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    at = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(at)


def texts():
    r = random.Random(11)
    bits = ["a", "b", "c", "aé", "#x", "$$", "\n", "\n\n", " ", "\t", "\x0b", " ", "\x1c", "Z9."]
    yield from ("", " ", "\n\n\n", "x " * 60_000)
    yield from ("".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randrange(80))) for _ in range(500))


def test_counts_equal_brute_force():
    for t in texts():
        assert quality.statistics(t)[:5] == plain(t), t


def corpus():
    r = random.Random(12)
    say = lambda n, s="": " ".join(f"w{r.randrange(4000)}{s}" for _ in range(n))
    good, bad = [(i, say(80)) for i in range(300)], [(1000 + i, say(80, r.choice(["$$$", "%%", ""]) if i % 9 else "&&")) for i in range(120)]
    bad = [(d, re.sub(r"(w\d+)( |$)", r"\1##\2", t)) for d, t in bad]
    return good, bad


def test_learned_list_keeps_clean_and_finds_junk(spark):
    good, bad = corpus()
    rows = good + bad + [(5000, None), (5001, ""), (None, good[0][1]), (5, good[5][1])]
    df = spark.createDataFrame([(d, t, 1.5) for d, t in rows], "doc_id long, text string, n_words double")
    labels = spark.createDataFrame([(d, 1) for d, _ in good[:200]] + [(d, 0) for d, _ in bad[:80]] + [(None, 0), (7, None)], "doc_id long, quality int")
    got = quality.judged(df, labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {d for d, _ in good} | {None}
    assert {r.doc_id for r in got if r.base_failed} == {5000, 5001}


def test_copies_make_no_rule_and_no_labels_no_rule(spark):
    good, _ = corpus()
    rows = good + [(9000 + i, "one odd text $ " + good[0][1]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(d, 1) for d, _ in good] + [(9000 + i, 0) for i in range(50)], "doc_id long, quality int")
    assert quality.judged(df, labels).where("kept").count() == len(rows)
    assert quality.judged(df, labels.where("false")).where("kept").count() == len(rows)
    assert quality.judged(df.where("false"), labels).count() == 0


def test_expression_equals_rules(spark):
    r = random.Random(13)
    stats = [{"symbols": r.random(), "stops": r.random(), "bad": 0} for _ in range(900)]
    for x in stats:
        x["bad"] = int(x["symbols"] > 0.7 and x["stops"] < 0.4)
    rules = quality.learn(stats)
    hit = [any(quality._covers(q, x) for q in rules) for x in stats]
    assert sum(h != bool(x["bad"]) for h, x in zip(hit, stats, strict=True)) <= 9
