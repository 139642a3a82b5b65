import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from lodestrata.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.model(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def samples():
    r = random.Random(5)
    pool = [chr(c) for c in range(1, 0x250)] + list("  \n\n\t\r\x1c\x85\xa0 　") * 10 + [chr(r.randrange(0x250, 0xD800)) for _ in range(100)] + [chr(r.randrange(0x10000, 0x1F9FF)) for _ in range(50)] + list("abcdefghij the ing'") * 30
    yield from ("".join(r.choice(pool) for _ in range(r.randrange(150))) for _ in range(400))
    yield from ("", "a", " ", "'ll's", "a" * 1000, "ab" * 600, " " * 900, "x" * 255 + "the" * 100, "<|endoftext|>", "der Straße " * 30_000)


def test_encodes_as_the_library_and_decodes_back(own, other):
    for s in samples():
        ids = own.encode(s)
        assert ids == other.encode_ordinary(s)
        assert own.decode(ids) == s.encode()


def test_heap_and_matrix_agree(own):
    r = random.Random(8)
    for _ in range(300):
        p = "".join(r.choice("abcdetinghs ") for _ in range(r.randrange(1, 60))).encode()
        ids = own._heap(p)
        assert [own.ranks[p]] if p in own.ranks else ids == own.encode_pieces([p])[0]


def test_frames(spark, other):
    texts = [None, *samples()]
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    digest = {r.doc_id: r for r in bpe.encoded(df, PATH, public_tokenizers.PATTERN, digest=True).collect()}
    for i, t in enumerate(texts):
        ids, r = other.encode_ordinary(t or ""), digest[i if i else None]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    full = bpe.encoded(df.limit(40), PATH, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decoded(full, PATH, public_tokenizers.PATTERN).collect()}
    assert all(back[r.doc_id] == bytes(r.decoded) for r in full.collect())
    assert bpe.encoded(df.where("false"), PATH, public_tokenizers.PATTERN, digest=True).count() == 0


def test_forgetting_changes_nothing(own, other, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    for s in list(samples())[:60]:
        for part in own.pieces(s):
            own.learn(iter(part))
            assert [int(i) for p in part for i in own.known[p].split()] == other.encode_ordinary("".join(part))


def test_long_texts_of_short_pieces_between_neighbours(spark, other):
    r = random.Random(13)
    hexes, numbers = "".join(r.choice("0123456789abcdef") for _ in range(300_000)), ",".join(str(r.randrange(10)) for _ in range(75_000))
    texts = ["short", hexes, "", "short too", numbers, None, "a " * 40_000, "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    digest = {r.doc_id: r for r in bpe.encoded(df, PATH, public_tokenizers.PATTERN, digest=True).collect()}
    full = {r.doc_id: r for r in bpe.encoded(df, PATH, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = other.encode_ordinary(t or "")
        assert digest[i].n_tokens == len(ids) and digest[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digest[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert full[i].ids == ids and bytes(full[i].decoded) == (t or "").encode()
