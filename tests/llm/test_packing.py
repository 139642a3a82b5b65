import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_plan(counts, capacity):
    got, bins = {}, 0
    for n, items in packing.plan(counts, capacity):
        assert sum(length * c for length, c in items) <= capacity
        assert sum(c for length, c in items if 3 * length > capacity) <= 2
        bins += n
        for length, c in items:
            got[length] = got.get(length, 0) + n * c
    assert got == {k: v for k, v in counts.items() if v}
    return bins


def test_plans_hold_all_and_waste_little():
    r = random.Random(1)
    for capacity in (10, 100, 2048):
        for _ in range(60):
            counts = {r.randrange(1, capacity + 1): r.choice([1, 2, 3, 1000]) for _ in range(r.randrange(1, 40))}
            bins = check_plan(counts, capacity)
            least = -(-sum(k * v for k, v in counts.items()) // capacity)
            least = max(least, sum(v for k, v in counts.items() if 2 * k > capacity))
            least = max(least, -(-sum(v for k, v in counts.items() if 3 * k > capacity) // 2))
            assert bins <= least * 1.5 + 1
    assert check_plan({6: 3, 4: 3}, 10) == 3 and check_plan({10: 7}, 10) == 7 and check_plan({1: 95}, 10) == 10 and check_plan({}, 10) == 0


def rows():
    r = random.Random(3)
    word = lambda: r.choice(["the", "Straße", "naïve", "x" * 40, "don't", "42", "--", "é", "ΑΣ", "<|endoftext|>", "a\x1cb", "c d", "é"])
    say = lambda n: "".join(word() + r.choice([" ", "\n", "  ", "\t", "  "]) for _ in range(n))
    return [(i, say(r.choice([0, 3, 200, 700, 3000]))) for i in range(60)] + [(90, None), (91, ""), (92, "  "), (None, "none"), (93, say(5)), (94, "the " * 2047), (95, "the " * 2048), (96, "same"), (96, "same"), (97, say(400_000))]


@pytest.fixture(scope="module")
def case(spark):
    data = rows()
    df = spark.createDataFrame([(d, t, 0) for d, t in data], "doc_id long, text string, length int").repartition(3)
    t = Tokenizer.from_file(PATH)
    return data, df, [t.encode(x or "", add_special_tokens=False).ids + [0] for _, x in data]


def test_pieces_and_places(case):
    data, df, ids = case
    got = packing.packed(packing.pieces(df, PATH)).collect()
    want = []
    for (d, _), x in zip(data, ids, strict=True):
        for i in range(0, len(x), 2048):
            part = x[i : i + 2048]
            want.append((d, i // 2048, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in by.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= 1.02 * sum(map(len, ids)) / 2048 + 2


def test_sequences_hold_the_ids(case):
    data, df, ids = case
    got = packing.sequences(df.where("doc_id < 97"), PATH).collect()
    assert all(len(r.ids) <= 2048 for r in got)
    assert sorted(i for r in got for i in r.ids) == sorted(i for (d, _), x in zip(data, ids, strict=True) if d is not None and d < 97 for i in x)


def test_empty_table(case):
    assert packing.packed(packing.pieces(case[1].where("false"), PATH)).count() == 0


def test_parts_of_words_give_the_ids_of_whole_texts(case):
    t = Tokenizer.from_file(PATH)
    model = packing.Words(PATH)
    assert model.fast
    known = packing.Known()
    vocabulary = [w.removesuffix("</w>") for w in t.get_vocab()][::7]
    odd = ["don't.", "a.b.", "...", "x..", "é.", "Word,", "#tag", "a$$$", "$$$", "O'Neil's,", "'s.", "5%", "<|endoftext|>.", "İx", "H\u0331", "ﬁ*", "a's*", "we're&&&"]
    for w in [*vocabulary, *odd]:
        for text in (w, f"{w} {w.upper()},", f"x{w}.y"):
            ids, sizes = model.ids(text.split(), known)
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids and sizes.sum() == len(ids), text


def least_bins(items, capacity):
    """The fewest bins, by trying every place for every item."""
    best = [len(items)]

    def put(i, gaps):
        if len(gaps) >= best[0]:
            return
        if i == len(items):
            best[0] = len(gaps)
            return
        for k in {g: j for j, g in enumerate(gaps)}.values():
            if gaps[k] >= items[i]:
                put(i + 1, [g - items[i] if j == k else g for j, g in enumerate(gaps)])
        put(i + 1, [*gaps, capacity - items[i]])

    put(0, [])
    return best[0]


def test_plans_against_the_fewest_bins():
    r = random.Random(17)
    more = 0
    for _ in range(400):
        capacity = r.choice([10, 12, 30])
        items = sorted((r.randrange(1, capacity + 1) for _ in range(r.randrange(1, 9))), reverse=True)
        bins = check_plan({n: items.count(n) for n in items}, capacity)
        least = least_bins(items, capacity)
        assert least <= bins <= least + 1
        more += bins > least
        large = [n for n in items if 3 * n > capacity]  # at most two of them fit a bin: greedy matching is exact
        if large:
            assert check_plan({n: large.count(n) for n in large}, capacity) == least_bins(large, capacity)
    assert more <= 20


def test_long_texts_in_slices_and_caches_that_start_anew(monkeypatch):
    """The same pieces whatever a block holds and a task remembers; in this process, so that both can be small."""
    import pyarrow as pa

    made = {}

    class Docs:
        def select(self, *_):
            return self

        def drop(self, *_):
            return self

    monkeypatch.setattr(packing, "in_batches", lambda df, make, schema, ends: made.setdefault("make", make) and df)
    monkeypatch.setattr(packing, "BLOCK", 300)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    packing.pieces(Docs(), PATH)
    data = [(i, t) for i, (d, t) in enumerate(rows()) if len(t or "") < 20_000] + [(1000, "x" * 1000), (1001, "\n".join(["déjà vu"] * 3000))]
    step, out = made["make"](), []
    for k in range(0, len(data), 7):
        ids, texts = zip(*data[k : k + 7], strict=True)
        out += [x for b in step(pa.record_batch([pa.array(ids), pa.array(texts, pa.string())], ["doc_id", "text"])) for x in b.to_pylist()]
    out += [x for b in step(None) for x in b.to_pylist()]
    t = Tokenizer.from_file(PATH)
    want = []
    for d, x in data:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        want += [(d, i // 2048, i, len(ids[i : i + 2048]), zlib.crc32(np.array(ids[i : i + 2048], "<u4").tobytes())) for i in range(0, len(ids), 2048)]
    assert sorted((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in out) == sorted(want)


def test_a_block_is_given_back_before_the_next(monkeypatch):
    seen, calls = {}, []

    class Frame:
        def select(self, *names):
            return self

        def drop(self, name):
            return self

    monkeypatch.setattr(packing, "released", lambda: calls.append(1))
    monkeypatch.setattr(packing, "in_batches", lambda df, make, schema, ends=False: seen.update(make=make) or df)
    monkeypatch.setattr(packing, "BLOCK", 1000)
    packing.pieces(Frame(), PATH)
    step = seen["make"]()
    texts = ["one two three " * 90] * 4 + ["", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    rows = [r for out in (*step(batch), *step(None)) for r in out.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(6)) and len({r["ids_crc32"] for r in rows}) == 2
    assert len(calls) >= 5
