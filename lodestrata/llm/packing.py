"""Best-fit packing with large-item matching.

Documents are tokenised and cut into pieces of at most `capacity` tokens. How
many pieces there are of each length is all that packing needs to know: at
most `capacity` numbers, on which the driver plans bins as patterns with
multiplicities. Lengths above one third of a bin pair at most two to a bin, by
greedy matching of the longest with the longest that still fits; lengths up to
one third go, longest first, to the tightest gap that holds them, and open
new bins only when none does. A piece takes its place in the plan by its rank
among the pieces of its length, which is numbered over sampled ranges, so that
a length that a third of all pieces share is no single task's work.

Cases: null and empty texts are a document of the end id alone; a document of
exactly the capacity is one piece; repeated rows are pieces of their own; a
null doc_id is kept; an empty table gives no rows; further columns are
ignored by `packed` and `sequences`.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import SPACE, arrow_schema, in_batches, numbered, released, resident, table
from lodestrata.llm.merges import LONGEST, Merges
from lodestrata.session import written

CAPACITY = 2048
#: Characters of text tokenised at a time; longer texts are cut at white space.
BLOCK = 6_000_000
#: Tokenizer pieces that a task remembers the ids of, and their characters; beyond either it starts anew.
REMEMBERED, REMEMBERED_CHARS = 250_000, 5_000_000
#: Words whose ids are put in place at a time.
PLACED = 500_000

#: Characters whose class, small letter and normal form the two libraries agree on: ASCII, the letters of Latin-1, and signs that are neither letters, digits nor white space and have no other normal form.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_OTHER = re.compile(f"[^\\x21-\\x7e\\n{_LETTERS}\u00a1-\u00a7\u00ab\u00ac\u00ae\u00b0\u00b1\u00b6\u00b7\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u20ac]|<\\|")
_PIECES = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9\n]+")
#: What the fast way stands for: a file that says otherwise has all its words encoded by the library.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself, or else the next one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Words:
    """Ids of words by a tokenizers file whose tokens never span white space.

    The library takes longer over a word than its merges do. Where the file's
    normalizer, pre-tokenizer and model are of the known kind, words of common
    characters are cut by the same pattern, and each distinct piece goes
    through the merges in numpy once; all other words go to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        said = json.loads(self.tokenizer.to_str())
        model, cut = said["model"], said["pre_tokenizer"] or {}
        vocab, letters = model.get("vocab", {}), _byte_letters()
        first, last = ([vocab.get(c + end, -1) for c in letters] for end in ("", model.get("end_of_word_suffix") or ""))
        steps = cut.get("pretokenizers", [])
        self.fast = (
            (said["normalizer"] or {}).get("normalizers") == _NORMAL
            and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == ({"Regex": _PATTERN}, "Removed", True)
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
            and (model["type"], model["dropout"], model["continuing_subword_prefix"], model["ignore_merges"]) == ("BPE", None, None, False)
            and min(first + last) >= 0
            and all(x["content"].startswith("<|") for x in said["added_tokens"])
        )
        if self.fast:
            pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
            self.first, self.last = np.array(first, np.int32), np.array(last, np.int32)
            self.merges = Merges([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], list(range(len(pairs))), np.array([vocab[a + b] for a, b in pairs], np.int32))

    def ids(self, words: list[str], known: Known) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space, one after another, and how many each has."""
        hard = [i for i, w in enumerate(words) if w and (not self.fast or len(w) > LONGEST // 4 or _OTHER.search(w))] if not self.fast or _OTHER.search("\n".join(words)) or max(map(len, words), default=0) > LONGEST // 4 else []
        odd = set(hard)
        plain = words if not odd else [w for i, w in enumerate(words) if i not in odd]
        flat, sizes = self._plain(plain, known) if plain else (np.empty(0, np.int32), np.empty(0, np.int64))
        if not hard:
            return flat, sizes
        every = np.zeros(len(words), np.int64)
        is_hard = np.zeros(len(words), bool)
        is_hard[hard] = True
        every[~is_hard] = sizes
        got = []
        for k in range(0, len(hard), 10_000):
            for i, e in zip(hard[k : k + 10_000], self.tokenizer.encode_batch_fast([words[i] for i in hard[k : k + 10_000]], add_special_tokens=False), strict=True):
                every[i] = len(e.ids)
                got.append(np.array(e.ids, np.int32))
        out = np.empty(int(every.sum()), np.int32)
        of_hard = np.repeat(is_hard, every)
        out[~of_hard] = flat
        out[of_hard] = np.concatenate(got)
        return out, every

    def _plain(self, words: list[str], known: Known) -> tuple[np.ndarray, np.ndarray]:
        pieces = _PIECES.findall("\n".join([*words, ""]).lower())
        known.learn(pieces, self)
        at = np.fromiter(map(known.places.__getitem__, pieces), np.int64, len(pieces))
        ends = np.flatnonzero(at == 0)  # the line end's place
        sizes = known.sizes[at]
        until = np.cumsum(sizes)[ends]
        flat = [gathered(known.flat, known.starts[at[k : k + PLACED]], sizes[k : k + PLACED]) for k in range(0, len(at), PLACED)]
        return np.concatenate(flat), np.diff(until, prepend=0)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start : start + size] for each start and size, one after another."""
    to = np.cumsum(sizes, dtype=np.int32)
    total = int(to[-1]) if len(to) else 0
    return flat[np.repeat((starts - (to - sizes)).astype(np.int32), sizes) + np.arange(total, dtype=np.int32)]


class Known:
    """The ids of pieces, in one array."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {"\n": 0}
        self.chars = 0
        self.flat, self.starts, self.sizes = np.empty(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def learn(self, pieces: list[str], words: Words) -> None:
        new = list(set(pieces).difference(self.places))
        if len(self.places) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.clear()
            new = list(set(pieces).difference(self.places))
        if new:
            flat, sizes = words.merges.merged([p.encode() for p in new], words.first, words.last)
            self.chars += sum(map(len, new))
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
            self.starts = np.concatenate([self.starts, np.cumsum(sizes) - sizes + len(self.flat)])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])


def words(path: str) -> Words:
    return resident(("words", path), lambda: Words(path))


def slices(text: str) -> Iterator[str]:
    """A text, cut at ASCII white space to about BLOCK characters."""
    start = 0
    while len(text) - start > BLOCK:
        space = re.compile(SPACE).search(text, start + BLOCK)
        cut = space.start() if space else len(text)
        yield text[start:cut]
        start = cut
    yield text[start:]


PIECES, PIECES_ARROW = arrow_schema(doc_id="long", piece="int", start="long", length="long", ids_crc32="long", ids="binary")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit) for each piece of each row."""

    def make():
        model, known, end = words(path), Known(), np.array([end_id], "<u4")
        held: list[tuple] = []  # doc_id, slice, whether it is its text's last
        begun: list[np.ndarray] = []  # ids of the slices so far of a text that is not done

        def cut(doc, ids: np.ndarray, rows: list) -> None:
            raw = ids.astype("<u4", copy=False).tobytes()
            for i in range(0, len(raw), 4 * capacity):
                part = raw[i : i + 4 * capacity]
                rows.append((doc, i // (4 * capacity), i // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))

        def flush():
            rows: list[tuple] = []
            of = [(doc, last) for doc, _, last in held]
            texts = pa.array([t for _, t, _ in held], pa.string())
            held.clear()
            lists = pc.ascii_split_whitespace(texts)
            counts = np.diff(lists.offsets.to_numpy())
            each = lists.flatten().dictionary_encode()
            del texts, lists
            flat, sizes = model.ids(each.dictionary.to_pylist(), known)
            code, starts, sizes = each.indices.to_numpy(), (np.cumsum(sizes) - sizes).astype(np.int32), sizes.astype(np.int32)
            n = sizes[code]
            ids = np.concatenate([np.empty(0, np.int32), *(gathered(flat, starts[code[k : k + PLACED]], n[k : k + PLACED]) for k in range(0, len(code), PLACED))])
            until = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[np.concatenate([[0], np.cumsum(counts)])]
            del each, flat, sizes, code, starts, n
            for (doc, last), a, b in zip(of, until[:-1].tolist(), until[1:].tolist(), strict=True):
                begun.append(ids[a:b])
                if last:
                    cut(doc, np.concatenate([*begun, end]), rows)
                    begun.clear()
            del ids
            released()  # what a block took goes back before the next one's texts are held
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES_ARROW.types, strict=True)], schema=PIECES_ARROW)

        def step(batch: pa.RecordBatch | None):
            if batch is None:
                if held:
                    yield from flush()
                return
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                some = list(slices(text or ""))
                for i, t in enumerate(some):
                    held.append((doc, t, i == len(some) - 1))
                    state["size"] += len(t) + 64
                    if state["size"] > BLOCK:
                        state["size"] = 0
                        yield from flush()

        state = {"size": 0}
        return step

    out = in_batches(docs.select("doc_id", "text"), make, PIECES, ends=True)
    return out if with_ids else out.drop("ids")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of bins, [(length, copies in each bin)]) that hold so many pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    if any(n > capacity or n < 1 for n in left):
        raise ValueError("a length is out of range")
    gaps: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    sizes: list[int] = []  # the gaps that there are, ascending

    def put(bins: int, items: list[tuple[int, int]], gap: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(sizes, gap)
        gaps[gap].append((bins, items))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        fits = bisect.bisect_right(large, capacity - n) - 1
        m = large[fits] if fits >= 0 else 0
        if m == n and left[n] == 1:
            m = large[fits - 1] if fits > 0 else 0
        if not m:
            put(left[n], [(n, 1)], capacity - n)
            left[n] = 0
        elif m == n:
            put(left[n] // 2, [(n, 2)], capacity - 2 * n)
            left[n] %= 2
        else:
            bins = min(left[n], left[m])
            put(bins, [(n, 1), (m, 1)], capacity - n - m)
            left[n] -= bins
            left[m] -= bins
        large = [x for x in large if left[x]]
    for n in sorted((x for x in left if left[x]), reverse=True):
        todo = left[n]
        while todo:
            at = bisect.bisect_left(sizes, n)
            if at == len(sizes):
                each = capacity // n
                bins, rest = divmod(todo, each)
                if bins:
                    put(bins, [(n, each)], capacity - each * n)
                if rest:
                    put(1, [(n, rest)], capacity - rest * n)
                break
            gap = sizes[at]
            bins, items = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            each = gap // n
            full, rest = divmod(todo, each)
            if full >= bins:
                full, rest = bins, 0
            if full:
                put(full, [*items, (n, each)], gap - each * n)
            if rest:
                put(1, [*items, (n, rest)], gap - rest * n)
            if bins - full - bool(rest):
                put(bins - full - bool(rest), items, gap)
            todo -= full * each + rest
    return [x for gap in sizes for x in gaps[gap]]


def packed(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """parts (with doc_id, piece and length) with sequence_id and offset."""
    spark = parts.sparkSession
    t = written(parts, "pieces")
    counts = {r.length: r.n for r in t.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places, used, base = [], dict.fromkeys(counts, 0), 0
    for bins, items in plan(counts, capacity):
        at = 0
        for n, copies in items:
            places.append((n, used[n], used[n] + bins * copies, base, copies, at))
            used[n] += bins * copies
            at += n * copies
        base += bins
    ranks = numbered(t, ["length"], ["doc_id", "piece", "start"], "__rank")
    # As many rows as the plan has patterns, which depends on the capacity and not on the data's size.
    known = spark.createDataFrame(places, "__length long, __from long, __to long, __base long, __copies long, __at long")
    known = F.broadcast(known) if len(places) <= 64 * capacity else known
    found = ranks.join(known, (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    nth = F.col("__rank") - F.col("__from")
    return found.select(*parts.columns, (F.col("__base") + F.expr("(__rank - __from) div __copies")).alias("sequence_id"), (F.col("__at") + F.pmod(nth, F.col("__copies")) * F.col("length")).alias("offset"))


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """sequence_id, doc_ids and ids of each packed sequence; a group holds at most `capacity` tokens."""
    placed = packed(pieces(docs, path, capacity, end_id, with_ids=True), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = placed.groupBy("sequence_id").agg(parts.alias("p"))
    raw = F.hex(F.concat(F.lit(b""), F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))))
    words_ = F.expr("transform(sequence(1, length(h), 8), i -> cast(conv(concat(substr(h, i + 6, 2), substr(h, i + 4, 2), substr(h, i + 2, 2), substr(h, i, 2)), 16, 10) as int))")
    return whole.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), raw.alias("h")).select("sequence_id", "doc_ids", words_.alias("ids"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    parts = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
