"""Byte-level BPE encoding and decoding in numpy.

Texts are split by the tokenizer's pattern; each distinct piece is encoded
once. Pieces of like byte length form a padded matrix in which every row
merges its leftmost pair of minimum rank in each round; ranks of pairs come
from a hash table in numpy, and finished rows and freed columns are compacted
away. Pieces beyond LONGEST bytes, for which a round a merge would be
quadratic, go by the same rule through a heap.

Cases: null and empty texts have no tokens and decode to nothing; repeated
rows and ties give equal rows; a null doc_id stays null; an empty table gives
no rows; further columns are ignored. A text of any length is taken in chunks
of pieces, so that only the text itself must fit in memory.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm.common import arrow_schema, in_batches, resident, table
from lodestrata.llm.merges import Merges

#: Pieces of more bytes than this are encoded by a heap.
LONGEST = 256
#: Encoded pieces that a worker remembers, and their bytes; beyond either it starts anew.
REMEMBERED, REMEMBERED_BYTES = 600_000, 48 << 20
#: Pieces of a text handled at a time.
CHUNK = 100_000


def vocabulary(path: str) -> list[bytes]:
    """The tokens of a rank file in order of their ranks, which are 0, 1, 2 and so on."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def splitter(pattern: str) -> tuple[re.Pattern, re.Pattern]:
    r"""The pattern for the re module, which is several times as fast: for texts within the BMP, and for all.

    Unicode editions differ in \p{L}, \p{N} and \s, so they become classes of
    the characters that tiktoken's own pattern engine takes for such.
    """
    import tiktoken

    everything = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}

    def ranges(prop: str, top: int) -> str:
        found = bytes(tiktoken.Encoding("class", pat_str=prop, mergeable_ranks=single, special_tokens={}).encode_ordinary(everything)).decode()
        codes, out = [c for c in map(ord, found) if c <= top], []
        for _, run in itertools.groupby(enumerate(codes), lambda x: x[1] - x[0]):
            run = [c for _, c in run]
            out.append(re.escape(chr(run[0])) + (f"-{re.escape(chr(run[-1]))}" if len(run) > 1 else ""))
        return "".join(out)

    def build(top: int) -> re.Pattern:
        letters, numbers, space = (ranges(p, top) for p in (r"\p{L}", r"\p{N}", r"\s"))
        p = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        p = p.replace(r"(?!\S)", f"(?![^{space}])").replace(r"\s", f"[{space}]")
        if "\\p" in p:
            raise ValueError("a class of the pattern is not known")
        return re.compile(p)

    return build(0xFFFF), build(0x10FFFF)


class ByteBPE:
    """Encoder and decoder for the vocabulary in a rank file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = vocabulary(path)
        self.ranks = {t: i for i, t in enumerate(self.tokens)}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.within, self.all = splitter(pattern)
        pairs = [(a, b, rank) for rank, token in enumerate(self.tokens) for i in range(1, len(token)) if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]
        self.merges = Merges(*map(list, zip(*pairs, strict=True))) if pairs else Merges([], [], [])
        self.decimal = list(map(str, range(len(self.tokens))))
        self.known: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.held = 0

    def _heap(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bytes_at = [self.tokens[i] for i in ids]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := self.ranks.get(bytes_at[i] + bytes_at[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], bytes_at[i], ids[j], after[i] = r, self.tokens[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list[list[int]] = [[] for _ in pieces]
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = [whole]
            elif len(p) > LONGEST:
                out[i] = self._heap(p)
        short = [i for i, p in enumerate(pieces) if p and not out[i]]
        flat, sizes = self.merges.merged([pieces[i] for i in short], self.byte_ids)
        ids, at = flat.tolist(), 0
        for i, n in zip(short, sizes.tolist(), strict=True):
            out[i] = ids[at : at + n]
            at += n
        return out

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a chunk at a time."""
        find = self.within if text.isascii() or max(text) <= "\uffff" else self.all
        if len(text) <= CHUNK:
            yield find.findall(text)
            return
        matches = (m.group() for m in find.finditer(text))
        while part := list(itertools.islice(matches, CHUNK)):
            yield part

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode and decode what is not remembered yet."""
        asked = set(pieces)
        new = list(asked.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.known.clear()
            self.decoded.clear()
            self.held, new = 0, list(asked)
        for p, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            self.known[p] = " ".join(map(self.decimal.__getitem__, ids))
            self.decoded[p] = self.decode(ids)
            self.held += 2 * len(p) + len(self.known[p])

    def encode(self, text: str) -> list[int]:
        return [i for part in self.pieces(text) for ids in self.encode_pieces([p.encode() for p in part]) for i in ids]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def model(path: str, pattern: str) -> ByteBPE:
    """One model a worker process."""
    return resident(("bpe", path, pattern), lambda: ByteBPE(path, pattern))


ENCODED, ENCODED_ARROW = arrow_schema(doc_id="long", n_tokens="long", ids="array<int>", decoded="binary")
DIGEST, DIGEST_ARROW = arrow_schema(doc_id="long", n_tokens="long", ids_sha256="string", decoded_sha256="string")


def _grouped(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about CHUNK * 4 characters in all; a text beyond CHUNK, which may have several slices of pieces, is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "") if len(t or "") <= CHUNK else math.inf
        if i > start and size + n > 4 * CHUNK:
            yield start, i
            start, size = i, 0
        size += n
    if texts:
        yield start, len(texts)


def encoded(docs: DataFrame, path: str, pattern: str, digest: bool = False) -> DataFrame:
    """For each row doc_id, n_tokens, and either the ids and the bytes they decode to, or the digests of both."""

    def make():
        bpe = model(path, pattern)

        def whole(text: str) -> tuple:
            n, ids, back = 0, [], []
            sha_ids, sha_back = hashlib.sha256(), hashlib.sha256()
            for part in bpe.pieces(text) if text else ():
                bpe.learn(part)
                add(part, ids, back)
                n += ids[-1].count(" ") + 1
                if digest:
                    sha_ids.update(((" " if n > ids[-1].count(" ") + 1 else "") + ids.pop()).encode())
                    sha_back.update(back.pop())
            return (n, sha_ids.hexdigest(), sha_back.hexdigest()) if digest else (n, [int(i) for x in ids for i in x.split()], b"".join(back))

        def add(part: list[str], ids: list[str], back: list[bytes]) -> None:
            ids.append(" ".join(map(bpe.known.__getitem__, part)))
            back.append(b"".join(map(bpe.decoded.__getitem__, part)))

        def step(batch: pa.RecordBatch):
            docs, texts = batch.column(0), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for a, b in _grouped(texts):
                if b == a + 1 and len(texts[a] or "") > CHUNK:
                    rows.append(whole(texts[a]))
                    continue
                parts = [next(bpe.pieces(t)) if t else [] for t in texts[a:b]]
                bpe.learn(itertools.chain.from_iterable(parts))
                for part in parts:
                    ids = " ".join(map(bpe.known.__getitem__, part))
                    back = b"".join(map(bpe.decoded.__getitem__, part))
                    n = ids.count(" ") + 1 if ids else 0
                    rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest()) if digest else (n, list(map(int, ids.split())), back))
            shape = DIGEST_ARROW if digest else ENCODED_ARROW
            if rows:
                yield pa.RecordBatch.from_arrays([docs, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types[1:], strict=True))], schema=shape)

        return step

    return in_batches(docs.select("doc_id", "text"), make, DIGEST if digest else ENCODED)


def decoded(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text bytes for rows of doc_id and ids."""
    schema, shape = arrow_schema(doc_id="long", decoded="binary")

    def make():
        bpe = model(path, pattern)

        def step(batch: pa.RecordBatch):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], schema=shape)

        return step

    return in_batches(ids.select("doc_id", "ids"), make, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digest=True)
