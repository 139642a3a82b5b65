"""Byte pair merges in numpy, on padded matrices.

Sequences of like length form a matrix with a column for each sequence and a
row for each place. In every round each column merges its leftmost pair of
minimum rank; ranks of pairs come from an open-addressing hash table in numpy,
and finished columns and rows that no column needs any more are compacted
away.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)
#: Places in a matrix at a time.
CELLS = 1 << 19
#: Longest sequence: a place takes 9 bits of a pair's key.
LONGEST = 512


class Merges:
    """Merges (left, right) in order of rank; ids[rank] is what the pair of that rank becomes."""

    def __init__(self, left: list[int], right: list[int], ranks: list[int], ids: np.ndarray | None = None):
        self.ids = ids
        keys = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        values = np.array(ranks, np.int32)
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        at, self.probes = self._hash(keys), 1
        while len(keys):
            free = self.slots[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            put = np.flatnonzero(free)[first]
            self.slots[at[put]], self.values[at[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & ((1 << self.bits) - 1)
            self.probes += bool(len(keys))

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NONE where a pair does not merge; ids below 0 are padding."""
        if left.size == 0:
            return np.empty(left.shape, np.int32)
        keys = left.astype(np.int64) << 20 | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        flat, k = out.reshape(-1), keys.reshape(-1)[todo]
        at = self._hash(k)
        for _ in range(self.probes):
            there = self.slots[at]
            hit = there == k
            flat[todo[hit]] = self.values[at[hit]]
            on = ~hit & (there >= 0)
            if not on.any():
                break
            todo, k, at = todo[on], k[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def matrix(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the columns of ids, of these lengths and padded by -1, become: the same shape, and the new lengths."""
        width = len(ids)
        out, sizes = ids.copy(), lengths.copy()
        # A pair's key is its rank, then its place: the least key is the leftmost pair of minimum rank.
        key = self.rank_of(ids[:-1], ids[1:])
        key = np.where(key == NONE, NONE, (key << 9) + np.arange(width - 1, dtype=np.int32)[:, None])
        columns = np.arange(ids.shape[1])
        while len(columns) and len(key):
            least = key.min(axis=0)
            over = least == NONE
            if over.any():
                out[: len(ids), columns[over]], sizes[columns[over]] = ids[:, over], lengths[over]
                go = np.flatnonzero(~over)
                if not len(go):
                    return out, sizes
                lengths = lengths[go]
                used = int(lengths.max())
                columns, ids, key, least = columns[go], ids[:used, go], key[: used - 1, go], least[go]
            at, rank, w = least & 511, least >> 9, len(ids)
            every = np.arange(len(columns))
            for c in range(w - 1):
                if c:
                    np.copyto(ids[c], ids[c + 1], where=at < c)
                if c < w - 2:
                    np.copyto(key[c], np.where(key[c + 1] == NONE, NONE, key[c + 1] - 1), where=at <= c)
            ids[w - 1] = -1
            key[w - 2] = NONE
            ids[at, every] = rank if self.ids is None else self.ids[rank]
            lengths = lengths - 1
            to = np.minimum(at + 1, w - 1)
            right = self.rank_of(ids[at, every], np.where(at + 1 < w, ids[to, every], -1))
            put = np.flatnonzero(at < w - 1)
            key[at[put], put] = np.where(right == NONE, NONE, (right << 9) + at)[put]
            put = np.flatnonzero(at > 0)
            left = self.rank_of(ids[at[put] - 1, put], ids[at[put], put])
            key[at[put] - 1, put] = np.where(left == NONE, NONE, (left << 9) + at[put] - 1)
        out[: len(ids), columns], sizes[columns] = ids, lengths
        return out, sizes

    def merged(self, pieces: list[bytes], first: np.ndarray, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of bytes, one after another, and how many each has; bytes start as first[byte], the last of a piece as last[byte]."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(lengths) - lengths
        # Widths in powers of two beyond 12 bytes.
        widths = np.where(lengths <= 12, lengths, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        sizes, parts = np.zeros(len(pieces), np.int64), []
        for width in np.unique(widths[lengths > 0]).tolist():
            rows = np.flatnonzero(widths == width)
            for k in range(0, len(rows), max(1, CELLS // width)):
                some = rows[k : k + max(1, CELLS // width)]
                n, place = lengths[some], np.arange(width)[:, None]
                inside = place < n
                ids = np.where(inside, first[raw[np.minimum(starts[some] + place, len(raw) - 1)]], np.int32(-1))
                if last is not None:
                    ids[n - 1, np.arange(len(some))] = last[raw[starts[some] + n - 1]]
                ids, sizes[some] = self.matrix(ids, n)
                parts.append((some, ids))
        to = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int32)
        for some, ids in parts:
            n = sizes[some]
            for place in range(int(n.max())):
                on = n > place
                out[to[some[on]] + place] = ids[place, on]
        return out, sizes
