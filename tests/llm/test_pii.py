import random
import re

import pytest

from lodestrata.llm import pii


def plain(text):
    """The contract's patterns as they stand."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        if 14 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_patterns_on_random_texts():
    r = random.Random(4)
    bits = ["a@b.c", "x.y+z@mail.example.com", "@", ".", "..", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4041894974608795", "4111 1111 1111 1111", "+1 (988) 555-2485", "+", "-", " ", "12", "é", "\n", "a@b@c.d.e", "%", "((", "9" * 30]
    for _ in range(4000):
        t = "".join(r.choice(bits) for _ in range(r.randrange(12)))
        assert pii.base_spans(t) == plain(t), t


def test_long_texts_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "a@" * 100_000, "+1" * 100_000):
        pii.base_spans(t)


def corpus():
    r = random.Random(2)
    words = [f"word{i}" for i in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, f"{say(20)} Quillfeather, boss@secret.example.org {say(20)} 10.0.0.{i}") for i in range(6)]
    rows += [(100 + i, say(40)) for i in range(60)] + [(200 + i, f"{say(10)} common mail{i}@x.org {say(10)} common") for i in range(10)]
    rows += [(300, None), (301, ""), (None, "+1 (988) 555-2485"), (302, "one@two.org copied passage"), (302, "one@two.org copied passage"), (303, "one@two.org copied passage"), (304, "one@two.org copied passage"), (305, "a " * 200_000 + "z@z.zz")]
    return rows


def test_terms_that_disclose_an_entity(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, row int, spans string")
    found = pii.spans(df).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for x in found:
        text = texts[x.doc_id] or ""
        marks = [m.split(":") for m in x.spans.split(",") if m]
        assert x.base == pii.joined(plain(text)) and [m for m in marks if m[0] in pii.KINDS] == [m.split(":") for m in x.base.split(",") if m]
        terms = [text[int(a) : int(b)] for k, a, b in marks if k not in pii.KINDS]
        assert ("Quillfeather" in terms) == (x.doc_id is not None and x.doc_id < 6)
        assert "common" not in terms and "copied" not in terms  # terms of everywhere, and copies, tell nothing
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "Quillfeather" not in clean[3] and "[EMAIL]" in clean[3] and "[IP]" in clean[3] and clean[100] == texts[100]


def test_counts_against_brute_force(spark):
    rows = [x for x in corpus() if x[0] is not None]
    import math

    texts = [t or "" for _, t in rows]
    spans = [pii.base_spans(t) for t in texts]
    terms = [[x for x in pii.places(t) if not any(x[1] < e and s < x[2] for s, _, e in own)] for t, own in zip(texts, spans, strict=True)]
    everywhere = [{w for w, _, _ in pii.places(t)} for t in texts]
    of_e = {}
    for i, own in enumerate(spans):
        for s, k, e in own:
            of_e.setdefault((k, texts[i][s:e].lower()), set()).add(i)

    def differ(docs):
        n = len({pii.event(texts[i]) % 64 for i in docs})
        return n >= 3 and (n >= 32 or 4 * n >= len(docs))

    worst = {}
    for docs in of_e.values():
        ic = math.log2(len(rows) / len(docs))
        if differ(docs) and ic >= 3:
            for w in {w for i in docs for w, _, _ in terms[i]}:
                both = {i for i in docs if any(x[0] == w for x in terms[i])}
                if differ(both):
                    d = math.log2(len(rows) * len(both) / (sum(w in x for x in everywhere) * len(docs))) / ic
                    worst[w] = max(worst.get(w, 0), d)
    want = {(rows[i][0], a, b, "term" if worst[w] >= 0.95 else "broad") for i, x in enumerate(terms) for w, a, b in x if worst.get(w, 0) >= 0.75}
    got = {(x.doc_id, int(m.split(":")[1]), int(m.split(":")[2]), m.split(":")[0]) for x in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect() for m in x.spans.split(",") if m and m.split(":")[0] not in pii.KINDS}
    assert got == want and want


def test_planted_terms_are_found_everywhere(spark):
    """Names that go with an address, near it, far from it and without it; with copies and near copies that must teach nothing."""
    r = random.Random(8)
    words = [f"wort{i}" for i in range(4000)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows, planted = [], []
    for p in range(30):
        for _ in range(4):
            rows.append((len(rows), f"{say(40)} Name{p}x {say(r.randrange(60))} person{p}@example.org {say(60)}"))
            planted.append((rows[-1][0], f"Name{p}x"))
        if p % 10 == 0:
            rows.append((len(rows), f"{say(50)}, name{p}X: {say(50)}"))
            planted.append((rows[-1][0], f"name{p}X"))
    copied = f"{say(80)} copied@example.org {say(80)}"
    rows += [(len(rows) + i, copied) for i in range(50)]
    near = copied.replace("copied@", "near@").split()
    for _ in range(60):
        w = list(near)
        for _ in range(3):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((len(rows), " ".join(w if "near@example.org" in w else near)))
    rows += [(len(rows) + i, say(100)) for i in range(600)]
    found = {x.doc_id: x.spans for x in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    marked = {(d, texts[d][int(m.split(":")[1]) : int(m.split(":")[2])]) for d, s in found.items() for m in s.split(",") if m.startswith(("term", "broad"))}
    assert marked >= set(planted)
    assert len({w.lower() for _, w in marked}) <= 30 + 6  # hardly a word of the copies


def test_empty_table(spark):
    assert pii.spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text, marks, want", [("a bob@x.yz c", "email:2:10", "a [EMAIL] c"), ("x Abba9 y", "broad:2:7", "x <Xxbxa0> y".replace("xbxa", "x")), ("x y", "", "x y")])
def test_replaced(text, marks, want):
    assert pii.replaced(text, marks) == want
