"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

Covering: the bit positions get vectors of r + 1 bits, and for each nonzero
vector v of r + 1 bits a table is keyed by the fingerprint's bits at the
positions whose vector has an odd product with v. The at most r positions in
which two fingerprints differ have vectors that span at most r dimensions, so
some v has an even product with all of them, and its table ignores all of
these positions: every pair within r collides in one of the 2^(r+1) - 1
tables, for certain. A fingerprint in parts has such tables for each part: of
p parts, one has at most r of p (r + 1) - 1 differing bits.

Equal fingerprints are one node. Rows of a table are sorted by bucket and
compared bucket by bucket in numpy; only the links of a forest leave a bucket
that joins the nearest first. A bucket of more than `brute` nodes is dealt into
blocks, and each two blocks are compared like a bucket, in tasks of their own,
so that no task holds a large bucket and no pair of its nodes is left out.

`components` and `representatives` link fingerprints of shingles within the
radius. `near_representatives` decides by the similarity of the sets of
shingles: word edits that change a fifth of the shingles of five words leave
most single words, so that the first candidates come from 128-bit fingerprints
of the distinct words, in three parts of radius 4, that is, at up to 14
differing bits; each link is then held to the texts' exact similarity. No
fingerprint is certain to show every pair so similar, and a forest of the
nearest is not one of the most similar. So a second pass makes up for both: of
n shingles in a common order, two sets so similar share one of their first
n - ceil(similarity * n) + 1, and each pair of different parts that shares
enough of these for the similarity to be possible is held to it as well. What
is linked is then exactly what all pairs would link.

Cases: a text without words has fingerprint zero and links like any other;
null texts count as empty; a text of fewer words than a shingle is one
shingle; a null doc_id is kept and never names a component unless it is all
there is; repeated rows fall in one component; an empty table gives no rows;
further columns, whatever their names, are ignored by `fingerprints` and
carried by `representatives` and `near_representatives`.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import arrow_schema, fresh, hashed_share, in_batches, likely, small_batches, table, text_column
from lodestrata.operators.graph import connected_components
from lodestrata.session import written

BITS = 64
#: Buckets of more nodes than this are compared in blocks of half as many.
BRUTE = 4_096
#: Buckets of up to so many nodes are compared many at a time.
SMALL = 48
#: Shingles counted at a time.
CHUNK = 65_536
#: Contents whose shingles are counted for the order of shingles, and shingles that come last in it. Results don't depend on the order.
SAMPLE, OFTEN = 4_096, 65_536
#: Contents that a task remembers as done; beyond it starts anew.
SEEN = 100_000


def fingerprint(text: str, width: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text, as an unsigned number."""
    import xxhash

    words = text.encode().lower().split()  # on bytes: only A-Z and only the six ASCII white spaces
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) < width:
        return hash_of(b" ".join(words), seed)
    n, ones = len(words) - width + 1, np.zeros(BITS, np.int64)
    for start in range(0, n, CHUNK):
        part = words[start : start + CHUNK + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False))
        h = np.fromiter((hash_of(s, seed) for s in shingles), np.uint64, min(CHUNK, n - start))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            ones += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and fp for each row; fp holds the unsigned fingerprint's bits in a long."""
    return _keyed_prints(docs.select("doc_id", "text", F.lit(0).cast("long").alias("k")), width, seed).select("doc_id", "fp")


def covering_masks(radius: int, seed: int = 20_15) -> list[int]:
    """2^(radius+1) - 1 masks as signed longs, such that any `radius` positions or fewer are clear in one of them.

    The vectors of the positions are dealt evenly, so that each mask keeps
    about half of the bits. Positions with the zero vector would be in no
    mask; there are none.
    """
    return [mask[0] for mask in tables(BITS, 1, radius, seed)]


def tables(bits: int, parts: int, radius: int, seed: int = 20_15) -> list[list[int]]:
    """The masks of each part's tables, as signed longs, one for 64 bits of the fingerprint."""
    out = []
    for part in range(parts):
        places = list(range(bits))[part * bits // parts : (part + 1) * bits // parts]
        vectors = list(range(1, 1 << (radius + 1)))
        dealt = [vectors[i % len(vectors)] for i in range(len(places))]
        random.Random(seed + part).shuffle(dealt)
        out += [_signed(sum(1 << p for p, m in zip(places, dealt, strict=True) if (m & v).bit_count() & 1), bits) for v in vectors]
    return out


def _signed(mask: int, bits: int) -> list[int]:
    words = [mask >> k & (1 << 64) - 1 for k in range(0, bits, 64)]
    return [w - (1 << 64) if w >> 63 else w for w in words]


def _spanning(pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (distance, x, y) those that join what is not joined yet, the nearest first."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = root[x]
        return x

    out = []
    for d, x, y in sorted(pairs):
        x2, y2 = find(x), find(y)
        if x2 != y2:
            root[max(x2, y2)] = min(x2, y2)
            out.append((d, x, y))
    return out


def _apart(f: np.ndarray, x, y) -> np.ndarray:
    return np.bitwise_count(f[x] ^ f[y]).sum(axis=-1, dtype=np.int64)


def _within(buckets: np.ndarray, f: np.ndarray, radius: int) -> list[tuple[int, int, int]]:
    """The forests (distance, x, y: rows) of sorted buckets."""
    edges = np.flatnonzero(np.diff(buckets)) + 1
    starts = np.concatenate([[0], edges]).astype(np.int64)
    sizes = np.diff(np.concatenate([starts, [len(buckets)]]))
    out: list[tuple[int, int, int]] = []
    few = sizes <= SMALL
    ends = np.repeat(np.where(few, starts + sizes, 0), sizes)  # of each row's bucket, if it is small
    rows = np.flatnonzero(ends > np.arange(len(buckets)) + 1)
    pairs: list[tuple[int, int, int]] = []
    for lag in range(1, SMALL):
        rows = rows[ends[rows] > rows + lag]
        if not len(rows):
            break
        d = _apart(f, rows, rows + lag)
        near = d <= radius
        pairs += zip(d[near].tolist(), rows[near].tolist(), (rows[near] + lag).tolist(), strict=True)
    out += _spanning(pairs)  # rows of different buckets never meet
    for start, size in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
        out += _tree(f[start : start + size], radius, start)
    return out


def _tree(f: np.ndarray, radius: int, offset: int) -> list[tuple[int, int, int]]:
    """The nearest-first forest of many nodes: each time the node nearest to those joined comes next."""
    n = len(f)
    left, best, to = np.arange(1, n), np.bitwise_count(f[1:] ^ f[0]).sum(axis=1, dtype=np.int64), np.zeros(n - 1, np.int64)
    out = []
    while len(left):
        at = int(best.argmin())
        d, x = int(best[at]), int(left[at])
        if d <= radius:
            out.append((d, offset + int(to[at]), offset + x))
        keep = np.arange(len(left)) != at
        left, best, to = left[keep], best[keep], to[keep]
        now = np.bitwise_count(f[left] ^ f[x]).sum(axis=1, dtype=np.int64)
        nearer = now < best
        best[nearer], to[nearer] = now[nearer], x
    return out


def links(nodes: DataFrame, masks: list[list[int]], radius: int = 4, brute: int = BRUTE) -> DataFrame:
    """Links (a, b, far: bits) between nodes (columns id, unique, and f0, f1 and so on: 64 bits each) whose components are those of all pairs within the radius."""
    spark, words = nodes.sparkSession, len(masks[0])
    fs = [f"f{w}" for w in range(words)]
    schema, shape = arrow_schema(a="long", b="long", far="int", bucket="long", id="long", **dict.fromkeys(fs, "long"))

    def handed_on(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.nulls(batch.num_rows, f.type) for f in list(shape)[:3]), *batch.columns], schema=shape)

    def compared(rows: DataFrame, most: int | None) -> DataFrame:
        """Links of sorted buckets, and the rows of those of more than `most` nodes as they are."""

        def make():
            state: dict = {"bucket": None, "held": [], "n": 0, "over": False}

            def flush(batch: pa.RecordBatch):
                buckets = batch.column(0).to_numpy()
                sizes = np.diff(np.concatenate([np.flatnonzero(np.diff(buckets, prepend=buckets[0] - 1)), [len(buckets)]]))
                if sizes.max() == 1:
                    return
                if most and sizes.max() > most:
                    crowd = np.repeat(sizes > most, sizes)
                    yield handed_on(batch.filter(pa.array(crowd)))
                    batch = batch.filter(pa.array(~crowd))
                    if batch.num_rows < 2:
                        return
                f = np.stack([batch.column(2 + w).to_numpy() for w in range(words)], axis=1).view(np.uint64)
                found = _within(batch.column(0).to_numpy(), f, radius)
                if found:
                    far, x, y = (np.array(c, np.int64) for c in zip(*found, strict=True))
                    ids = batch.column(1).to_numpy()
                    cols = [pa.array(np.minimum(ids[x], ids[y])), pa.array(np.maximum(ids[x], ids[y])), pa.array(far.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays([*cols, *(pa.nulls(len(far), t.type) for t in list(shape)[3:])], schema=shape)

            def close():
                if state["held"]:
                    yield from flush(pa.Table.from_batches(state["held"]).combine_chunks().to_batches()[0])
                state.update(held=[], n=0, over=False, bucket=None)

            def more(part: pa.RecordBatch):
                if state["over"]:
                    yield handed_on(part)
                    return
                state["held"].append(part)
                state["n"] += part.num_rows
                if most and state["n"] > most:
                    state["over"] = True
                    yield from map(handed_on, state["held"])
                    state["held"] = []

            def step(batch: pa.RecordBatch | None):
                if batch is None:
                    yield from close()
                    return
                if not batch.num_rows:
                    return
                keys = batch.column(0).to_numpy()
                if state["bucket"] == keys[0]:
                    cut = int(np.searchsorted(keys, keys[0], "right"))
                    yield from more(batch.slice(0, cut))
                    batch, keys = batch.slice(cut), keys[cut:]
                    if not len(keys):
                        return
                yield from close()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield from flush(batch.slice(0, cut))
                state["bucket"] = keys[-1]
                yield from more(batch.slice(cut))

            return step

        dealt = rows.select("bucket", "id", *fs).repartition("bucket").sortWithinPartitions("bucket")
        found = in_batches(dealt, make, schema, ends=True)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")  # small rows
        out = written(found, "links")
        small_batches(spark)
        return out

    keys = F.array(*[F.xxhash64(F.lit(k), *[F.col(f).bitwiseAND(F.lit(m)) for f, m in zip(fs, mask, strict=True)]) for k, mask in enumerate(masks)])
    done = compared(nodes.select("id", *fs, F.explode(keys).alias("bucket")), brute)
    out = done.where("a is not null").select("a", "b", "far")
    dense = done.where("id is not null").select("bucket", "id", *fs)
    if not dense.isEmpty():
        counts = dense.groupBy("bucket").agg(F.ceil(F.count("*") / max(1, brute // 2)).cast("int").alias("blocks"))
        mine = dense.join(written(counts, "blocks").hint("merge"), "bucket").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        other = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pairs = other.select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket"), "id", *fs)
        out = out.unionByName(compared(pairs, None).select("a", "b", "far"))
    return out.groupBy("a", "b").agg(F.min("far").alias("far")).where("a <> b")


def _parts(t: DataFrame, radius: int, brute: int) -> DataFrame:
    """fp and part for each distinct fp of t: part is the smallest fp of its component."""
    nodes = written(t.select("fp").distinct(), "nodes")
    found = links(nodes.select(F.col("fp").alias("id"), F.col("fp").alias("f0")), tables(BITS, 1, radius), radius, brute)
    parts = written(connected_components(found), "parts").select(F.col("node").alias("fp"), F.col("component").alias("part"))
    return nodes.join(parts.hint("merge"), "fp", "left").select("fp", F.coalesce("part", "fp").alias("part"))


def components(docs: DataFrame, radius: int = 4, width: int = 4, brute: int = BRUTE) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links, for each row of docs."""
    t = written(fingerprints(docs, width), "prints")
    member = t.groupBy("fp").agg(F.min("doc_id").alias("least")).join(_parts(t, radius, brute), "fp")
    member = written(member, "members")
    # Written, here and below, so that both sides of joins are plain exchanges, which Spark can split where a key is hot.
    least = written(member.groupBy("part").agg(F.min("least").alias("component_id")), "least")
    of = written(member.select("fp", "part").join(least.hint("merge"), "part").select("fp", "component_id"), "components")
    return t.join(of.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id"), text_column())


def _first_of(docs: DataFrame, member: DataFrame) -> DataFrame:
    """The rows of docs that stay: of each part the one of the smallest doc_id, nulls last; member has k (of the row), doc_id and part for each row.

    Rows are known by doc_id and text; of rows that repeat both, one stays.
    Only rows that may go, or repeat, meet what is known of them.
    """
    member = written(member, "members")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")
    best = written(member.groupBy("part").agg(F.min(rank).alias("best"), F.count("*").alias("n")).where("n > 1").select("part", F.col("best.k").alias("best")), "best")
    key, k, stays, may = fresh(docs, "__key", "__k", "__stays", "__may")
    in_parts = member.join(best.hint("merge"), "part")
    odd = written(in_parts.groupBy(F.col("k").alias(k)).agg(F.max(F.col("k") == F.col("best")).alias(stays), F.count("*").alias("n")).where(f"n > 1 or not `{stays}`").drop("n"), "odd")
    marked = likely(docs.withColumn(key, _row_key()), F.col(key), odd.select(k), may)
    met = marked.where(F.col(may)).join(odd.hint("merge"), F.col(key) == F.col(k), "left").select(*docs.columns, key, stays)
    single = met.where(F.col(stays).isNull()).select(*docs.columns)
    repeated = met.where(F.col(stays)).groupBy(key).agg(F.any_value(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])).alias("row"))
    repeated = repeated.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return marked.where(~F.col(may)).select(*docs.columns).unionByName(single).unionByName(repeated)


def representatives(docs: DataFrame, radius: int = 4, width: int = 4, brute: int = BRUTE) -> DataFrame:
    """The rows of docs that stay: of each component of fingerprints within the radius the one of the smallest doc_id, nulls last."""
    t = written(_keyed_prints(docs.select("doc_id", "text", _row_key().alias("k")), width), "prints")
    return _first_of(docs, t.join(_parts(t, radius, brute).hint("merge"), "fp").select("k", "doc_id", "part"))


CONTENT, CONTENT_ARROW = arrow_schema(doc_id="long", k="long", c="long", f0="long", f1="long")
SHINGLES, SHINGLES_ARROW = arrow_schema(c="long", shingles="array<long>")
FIRST, FIRST_ARROW = arrow_schema(c="long", n="long", rest="long", late="long", last="long", first="array<long>")


def word_print(words: list[bytes]) -> tuple[int, int]:
    """128 bits over the distinct words, as two signed longs."""
    import xxhash

    kinds = set(words)
    if not kinds:
        return 0, 0
    ones, at = np.zeros(128, np.int64), list(kinds)
    for k in range(0, len(at), CHUNK):
        raw = b"".join(map(xxhash.xxh3_128_digest, at[k : k + CHUNK]))
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 16), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):
            ones += bits[j : j + 255].sum(axis=0, dtype=np.uint8)
    f = np.packbits(2 * ones > len(kinds), bitorder="little").view(np.int64)
    return int(f[0]), int(f[1])


def shingles(text: str, width: int) -> list[int]:
    """Hashes of a text's distinct shingles, as signed longs."""
    return _shingles(text.encode().lower().split(), width).tolist()


def _shingles(words: list[bytes], width: int) -> np.ndarray:
    import xxhash

    parts: Iterator[bytes] = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else iter([b" ".join(words)])
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64)).view(np.int64)


def content(words: list[bytes]) -> int:
    """A hash of the words in order, as a signed long."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), 7)).view(np.int64))


def first_of(found: np.ndarray, similarity: float, often: np.ndarray, places: np.ndarray) -> tuple[int, int, int, int, np.ndarray]:
    """Of distinct shingles: how many there are, how many don't come first, the last that does (its place among the frequent ones or 0, and itself) and those that come first.

    The order: by hash, but the frequent ones (sorted; each has a place from 1)
    come after all others, by place.
    """
    n = len(found)
    rest = max(0, math.ceil(similarity * n - 1e-6) - 1)
    place = np.zeros(n, np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, found), len(often) - 1)
        place = np.where(often[at] == found, places[at], 0)
    first = np.lexsort((found, place))[: n - rest]
    return n, rest, int(place[first[-1]]), int(found[first[-1]]), found[first]


def _contents(keyed: DataFrame) -> DataFrame:
    """doc_id, k, c (a hash of the words in order) and the word fingerprint for each row."""

    def make():
        def step(batch: pa.RecordBatch):
            rows = []
            for t in batch.column(1).to_pylist():
                words = (t or "").encode().lower().split()
                rows.append((content(words), *word_print(words)))
            c, f0, f1 = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x, pa.int64()) for x in (c, f0, f1))], schema=CONTENT_ARROW)

        return step

    return in_batches(keyed, make, CONTENT)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *rows])))


def _shingled(texts: DataFrame, width: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            found = [_shingles((t.as_py() or "").encode().lower().split(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], schema=SHINGLES_ARROW)

        return step

    return in_batches(texts, make, SHINGLES)


def _firsts(docs: DataFrame, width: int, similarity: float, often: list[int]) -> DataFrame:
    """c and what `first_of` says of its shingles, for each content; often: the frequent shingles, the most frequent last."""
    common = np.array(often, np.int64)

    def make():
        by = np.argsort(common)
        ordered, places, seen = common[by], by + 1, set()

        def step(batch: pa.RecordBatch):
            rows: list[tuple] = []
            for t in batch.column(0):
                words = (t.as_py() or "").encode().lower().split()
                c = content(words)
                if c in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(c)
                rows.append((c, *first_of(_shingles(words, width), similarity, ordered, places)))
            if rows:
                *longs, first = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in longs), _lists(list(first))], schema=FIRST_ARROW)

        return step

    found = in_batches(docs.select("text"), make, FIRST).groupBy("c").agg(F.any_value(F.struct("n", "rest", "late", "last", "first")).alias("x"))
    return found.select("c", "x.*")


def _possible(firsts: DataFrame, parts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b, far: the more first shingles they share, the less) of contents of different parts; those left out are not so similar.

    Where a's first shingles end before b's, all of them that b has are among
    b's first, so that both share no more than these and a's rest.
    """
    t = written(firsts.join(parts.hint("merge"), "c", "left").withColumn("part", F.coalesce("part", "c")), "firsts")
    rows = t.select(F.explode("first").alias("w"), "c", "part", "n", "rest", "late", "last")
    shared = written(rows.groupBy("w").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("w"), "shared")
    met = written(likely(rows, F.col("w"), shared, "may").where("may").drop("may").join(shared.hint("merge"), "w"), "met")
    one, two = (met.select("w", *[F.col(x).alias(f"{x}{i}") for x in met.columns[1:]]) for i in "12")
    n1, n2 = F.col("n1"), F.col("n2")
    apart = (F.col("c1") < F.col("c2")) & (F.col("part1") != F.col("part2"))
    sizes = F.least(n1, n2) >= F.lit(similarity) * F.greatest(n1, n2) - 1e-6
    pairs = one.join(two.hint("merge"), "w").where(apart & sizes).groupBy("c1", "c2", "n1", "n2", "rest1", "rest2", "late1", "late2", "last1", "last2").agg(F.count("*").alias("s"))
    need = F.lit(similarity / (1 + similarity)) * (n1 + n2) - 1e-6
    end1, end2 = (F.struct(F.col(f"late{i}").alias("late"), F.col(f"last{i}").alias("last")) for i in "12")
    enough = ((end1 > end2) | (F.col("s") + F.col("rest1") >= need)) & ((end2 > end1) | (F.col("s") + F.col("rest2") >= need))
    return pairs.where(enough).select(F.col("c1").alias("a"), F.col("c2").alias("b"), (-F.col("s")).alias("far"))


def similar(docs: DataFrame, t: DataFrame, width: int, similarity: float, brute: int = BRUTE) -> DataFrame:
    """c and part for each content that has a link: parts are those of all pairs of contents with so similar sets of shingles."""
    nodes = written(t.groupBy("c").agg(F.any_value("f0").alias("f0"), F.any_value("f1").alias("f1"), F.min("k").alias("k")), "contents")

    def shingled(some: DataFrame) -> DataFrame:
        """c and shingles for each row of `some` (c and k)."""
        k2, key, c2, may = fresh(docs, "__k", "__key", "__c", "__may")
        need = written(some.select(F.col("k").alias(k2), F.col("c").alias(c2)), "needed")
        marked = likely(docs.withColumn(key, _row_key()), F.col(key), need.select(k2), may).where(F.col(may))
        return _shingled(marked.join(need.hint("merge"), F.col(key) == F.col(k2)).groupBy(c2).agg(F.any_value("text").alias("text")), width)

    def joined(found: DataFrame, known: DataFrame | None) -> DataFrame:
        """The known links, and those of the pairs found that are so similar, but for pairs that are joined without."""
        sets = written(shingled(nodes.join(found.select(F.explode(F.array("a", "b")).alias("c")).distinct().hint("merge"), "c")), "shingles")

        def held(pairs: DataFrame) -> DataFrame:
            one, two = (sets.select(F.col("c").alias(x), F.col("shingles").alias(f"s{x}")).hint("merge") for x in "ab")
            both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("n"), (F.size("sa") + F.size("sb")).alias("all"))
            return both.where(F.col("n") >= F.lit(similarity) * (F.col("all") - F.col("n"))).select("a", "b")

        # Each content's nearest candidate first; then those that would join what is not joined yet.
        each = found.select("a", "b", "far", F.explode(F.array("a", "b")).alias("c"))
        nearest = held(each.groupBy("c").agg(F.min(F.struct("far", "a", "b")).alias("x")).select("x.a", "x.b").distinct())
        good = written(nearest if known is None else known.unionByName(nearest), "nearest")
        parts = written(connected_components(good), "parts")
        where = lambda x: parts.select(F.col("node").alias(x), F.col("component").alias(f"p{x}")).hint("merge")
        apart = found.join(where("a"), "a", "left").join(where("b"), "b", "left").where(F.coalesce("pa", "a") != F.coalesce("pb", "b"))
        return written(good.unionByName(held(apart)), "similar")

    def parts_of(pairs: DataFrame) -> DataFrame:
        return written(connected_components(pairs).select(F.col("node").alias("c"), F.col("component").alias("part")), "parts")

    near = joined(written(links(nodes.select(F.col("c").alias("id"), "f0", "f1"), tables(128, 3, 4), 14, brute), "candidates"), None)
    parts = parts_of(near)
    sample = shingled(nodes.where(hashed_share(F.col("c"), SAMPLE, nodes.count())))
    counts = sample.select(F.explode("shingles").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where("n > 2")
    often = [r.w for r in counts.orderBy(F.desc("n"), "w").limit(OFTEN).collect()]  # at most OFTEN rows
    rest = written(_possible(_firsts(docs, width, similarity, often[::-1]), parts, similarity), "possible")
    return parts if rest.isEmpty() else parts_of(joined(rest, near))


def near_representatives(docs: DataFrame, similarity: float = 0.8, width: int = 5, brute: int = BRUTE) -> DataFrame:
    """The rows of docs that stay: of each group of near duplicates the one of the smallest doc_id, nulls last.

    Two texts are linked if their sets of shingles of `width` words, in small
    letters, are so similar (intersection over union); equal words always link.
    """
    t = written(_contents(docs.select("doc_id", "text", _row_key().alias("k"))), "words")
    parts = written(similar(docs, t, width, similarity, brute), "parts")
    return _first_of(docs, t.join(parts.hint("merge"), "c", "left").select("k", "doc_id", F.coalesce("part", "c").alias("part")))


KEYED, KEYED_ARROW = arrow_schema(doc_id="long", k="long", fp="long")


def _keyed_prints(keyed: DataFrame, width: int, seed: int = 42) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            found = np.array([fingerprint(t.as_py() or "", width, seed) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found)], schema=KEYED_ARROW)

        return step

    return in_batches(keyed, make, KEYED)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
