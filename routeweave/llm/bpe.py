"""Byte-pair vocabulary tables and a segment-tree encoder over many words.

A vocabulary here gives every token its bytes and a rank equal to its id,
with the 256 single bytes first.  ``Merges`` holds the mergeable pairs as one
sorted array, so that many pairs are looked up in one vector operation.
"""

from __future__ import annotations

import numpy as np

DEAD = np.int64(1) << np.int64(62)      # key of a position without a pair
SHIFT = 32                              # key = rank << SHIFT | position


class Merges:
    """Pairs (left id, right id) -> merged id."""

    def __init__(self, left, right, merged):
        key = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        order = np.argsort(key)
        self.keys = np.append(key[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.asarray(merged, np.int64)[order], -1)
        self.table = dict(zip(self.keys[:-1].tolist(), self.merged[:-1].tolist(), strict=True))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, -1 where a pair does not merge (or an id is < 0)."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at >= len(self.keys)] = len(self.keys) - 1
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.merged[at], -1)


class Tree:
    """Segment trees over the byte positions of equally padded words.  The
    root of a word's tree holds rank << SHIFT | position of its leftmost
    pair of least rank."""

    def __init__(self, merges: Merges, tok: np.ndarray):
        self.m, self.tok = merges, tok
        w, p = tok.shape
        self.p, self.levels = p, p.bit_length() - 1
        self.next = np.tile(np.arange(1, p + 1, dtype=np.int32), (w, 1))
        self.prev = np.tile(np.arange(-1, p - 1, dtype=np.int32), (w, 1))
        self.tree = np.full((w, 2 * p), DEAD, dtype=np.int64)
        rank = merges.look_up(tok[:, :-1].ravel(), tok[:, 1:].ravel()).reshape(w, p - 1)
        leaf = np.where(rank >= 0, rank << SHIFT | np.arange(p - 1), DEAD)
        self.tree[:, p:2 * p - 1] = leaf
        for at in range(p - 1, 0, -1):
            np.minimum(self.tree[:, 2 * at], self.tree[:, 2 * at + 1], out=self.tree[:, at])

    def point_update(self, rows: np.ndarray, at: np.ndarray, key: np.ndarray) -> None:
        """One leaf of each row gets a new key: a walk to the root."""
        node = at + self.p
        self.tree[rows, node] = key
        for _ in range(self.levels):
            node = node >> 1
            self.tree[rows, node] = np.minimum(self.tree[rows, 2 * node], self.tree[rows, 2 * node + 1])

    def key(self, rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        rank = self.m.look_up(self.tok[rows, left], np.where(right < self.p, self.tok[rows, right % self.p], -1))
        return np.where(rank >= 0, rank << SHIFT | left, DEAD)

    def run(self) -> np.ndarray:
        """Merge until no word has a pair left; dead positions become -1."""
        rows = np.flatnonzero(self.tree[:, 1] < DEAD)
        while len(rows):
            root = self.tree[rows, 1]
            at = root & ((1 << SHIFT) - 1)
            gone = self.next[rows, at].astype(np.int64)
            after = self.next[rows, gone].astype(np.int64)
            self.tok[rows, at] = root >> SHIFT
            self.tok[rows, gone] = -1
            self.next[rows, at] = after
            inside = after < self.p
            self.prev[rows[inside], after[inside]] = at[inside]
            self.point_update(rows, gone, np.full(len(rows), DEAD))
            self.point_update(rows, at, self.key(rows, at, after))
            before = self.prev[rows, at].astype(np.int64)
            has = before >= 0
            r, b = rows[has], before[has]
            self.point_update(r, b, self.key(r, b, at[has]))
            rows = rows[self.tree[rows, 1] < DEAD]
        return self.tok


def encode_long(merges: Merges, first_id: np.ndarray, data: bytes) -> list[int]:
    """The same tree for one long word, on plain lists."""
    n = len(data)
    p = 1 << (n - 1).bit_length()
    dead, look = int(DEAD), merges.table.get
    tok = first_id[np.frombuffer(data, np.uint8)].tolist()
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [dead] * (2 * p)

    def key(i, j):
        rank = look(tok[i] << 32 | tok[j]) if j < n else None
        return dead if rank is None else rank << SHIFT | i

    for i in range(n - 1):
        tree[p + i] = key(i, i + 1)
    for at in range(p - 1, 0, -1):
        a, b = tree[2 * at], tree[2 * at + 1]
        tree[at] = a if a < b else b

    def update(i, k):
        i += p
        tree[i] = k
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

    while tree[1] < dead:
        i = tree[1] & ((1 << SHIFT) - 1)
        j = nxt[i]
        tok[i] = tree[1] >> SHIFT
        tok[j] = -1
        nxt[i] = k = nxt[j]
        if k < n:
            prv[k] = i
        update(j, dead)
        update(i, key(i, k))
        if prv[i] >= 0:
            update(prv[i], key(prv[i], i))
    return [t for t in tok if t >= 0]


LONG = 64
ROWS = 8192


def encode_words(merges: Merges, first_id: np.ndarray, texts: list[bytes]) -> list[list[int]]:
    """Ids of many words: one tree per word, words of a padded length
    together.  ``first_id`` maps a byte to its id."""
    out: list = [None] * len(texts)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    for i in np.flatnonzero(length <= 1):
        out[i] = [int(first_id[b]) for b in texts[i]]
    for i in np.flatnonzero(length > LONG):
        out[i] = encode_long(merges, first_id, texts[i])
    p = 2
    while p <= LONG:
        group = np.flatnonzero((length > max(1, p // 2)) & (length <= p))
        for k in range(0, len(group), ROWS):
            part = group[k:k + ROWS]
            flat = np.frombuffer(b"".join(texts[i].ljust(p, b"\0") for i in part), np.uint8)
            tok = first_id[flat].reshape(-1, p).astype(np.int64)
            tok[np.arange(p) >= length[part, None]] = -1
            done = Tree(merges, tok).run()
            alive = done >= 0
            ends = np.cumsum(alive.sum(1))
            ids = np.split(done[alive], ends[:-1])
            for i, x in zip(part, ids, strict=True):
                out[i] = x.tolist()
        p *= 2
    return out
