"""Benchmark decontamination by SimHash of item-sized windows.

A document is contaminated by an item if one of its windows as long as the
item (or the whole document, if that is shorter) has a weighted Jaccard
similarity of ``THRESHOLD`` or more with it: sum of the smaller over sum of
the larger counts of five-word shingles.  Words are runs of ASCII letters and
digits (lower-cased) and non-ASCII characters.

Such a window keeps a run of the item's words untouched, of a length that
follows from the item's and from how few words in a row stand in it once only
(``clean_run``).  Items are classed by that; per class, documents are cut into
strided windows short enough that one lies in any such run, and items into all
their windows of that size.  Every window gets a 64-bit SimHash of its shingles.  Fingerprints are matched by multi-index
Hamming blocks: four blocks of 16 bits, of which one must be equal in any two
fingerprints within radius 3, so none within the radius is missed.

Items in which three words in a row repeat are found by their shingles: a similar
window holds ``least_shared`` of them, so it holds one of any set that is large
enough to leave fewer (``watched``).

Both give ranges of window starts; equal fingerprints and shingles that follow
each other are matched once and their ranges merged.  Each range is verified
exactly by one sliding count, in time that is linear in it.

Benchmarks are searched for in parts of at most ``PART_BYTES`` of text, each
broadcast with the tasks; documents are scanned in place, without a shuffle.

Results for special inputs: a null text has no words and no hit; items
without words are never found; an item of fewer than five words is found
where its words stand consecutively; repeated rows give repeated hits,
repeated items one; empty tables give an empty result; other columns are
ignored.  Of equally similar windows the first is reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from routeweave.llm.textbytes import pieces, shingles, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 3
PART_BYTES = 4 << 20
PIECE = 1 << 18         # bytes of documents that a worker searches at once, unless one is longer

_U = np.uint64

#: Bytes of words: digits, letters and everything beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def allowed_difference(n_shingles: int) -> int:
    """Largest difference of two equally large sets of the least similarity."""
    return int(2 * n_shingles * (1 - THRESHOLD) / (1 + THRESHOLD) + 1e-9)


def clean_run(n_words: int, unique: int = 1) -> int:
    """Words in a row that a similar window must share with an item in which
    no ``unique`` words in a row stand twice: changes near the ends cost a
    shingle a word.  Each cut further in makes two runs of one; where two runs
    of the item meet in a window, they overlap in less than ``unique`` words,
    so ``SHINGLE - unique`` shingles of the window and as many of the item are
    in no run."""
    d = allowed_difference(n_words - SHINGLE + 1)
    cost = 2 * (SHINGLE - unique)
    return min((n_words - (d - cost * e) - e) // (e + 1) for e in range(d // cost + 1))


def grid(n_words: int, unique: int = 1) -> tuple[int, int, int]:
    """(shingle size, stride, strides per window) of an item's class."""
    if n_words < SHINGLE:
        return n_words, 1, 1
    run = SHINGLE
    while (wider := max(run + 1, int(run * 1.4))) <= clean_run(n_words, unique):
        run = wider
    stride = max(1, run // 5)
    return SHINGLE, stride, max(1, (run - stride + 2 - SHINGLE) // stride)


def unique_run(words: np.ndarray) -> int:
    """The fewest words in a row of which none stand twice, up to 4."""
    for r in range(1, 4):
        grams = shingles(words, np.array([0, len(words)]), r)[0]
        if len(np.unique(grams)) == len(grams):
            return r
    return 4


def fingerprints(h: np.ndarray, stride: int, strides: int) -> np.ndarray:
    """SimHash of the windows of ``stride * strides`` shingles that begin at
    multiples of ``stride``."""
    n = len(h) // stride
    if n < strides:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(h[:n * stride].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    block = bits.reshape(n, stride, 64).sum(1, dtype=np.uint16) if stride > 1 else bits.astype(np.uint16)
    total = block[:n - strides + 1].copy()
    for i in range(1, strides):
        total += block[i:n - strides + 1 + i]
    return np.packbits(2 * total > stride * strides, axis=1, bitorder="little").view(np.uint64).ravel()


def least_shared(n_shingles: int) -> int:
    """Shingles that any window of the least similarity shares with an item."""
    return int(np.ceil(THRESHOLD * n_shingles - 1e-9))


class HammingIndex:
    """All (query, entry) pairs of fingerprints within the radius."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.blocks = entries, []
        for b in range(RADIUS + 1):
            part = self._block(entries, b)
            order = np.argsort(part, kind="stable")
            self.blocks.append((order, np.searchsorted(part[order], np.arange((1 << 16) + 1))))

    @staticmethod
    def _block(f: np.ndarray, b: int) -> np.ndarray:
        return (f >> _U(16 * b) & _U(0xFFFF)).astype(np.int64)

    def search(self, queries: np.ndarray, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs; blocks that are equal are compared in portions."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for b, (order, begin) in enumerate(self.blocks):
            part = self._block(queries, b)
            n = begin[part + 1] - begin[part]
            q = np.flatnonzero(n)
            portion = np.cumsum(n[q]) // at_once
            for mine in np.split(q, np.flatnonzero(np.diff(portion)) + 1) if len(q) else ():
                m = n[mine]
                at = np.repeat(begin[part[mine]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                i, e = np.repeat(mine, m), order[at]
                near = np.bitwise_count(queries[i] ^ self.entries[e]) <= RADIUS
                found.append((i[near], e[near]))
        q, e = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        key = np.unique(q * max(1, len(self.entries)) + e)
        return key // max(1, len(self.entries)), key % max(1, len(self.entries))


class Holders:
    """The items that hold each of some hashes (``kinds``, distinct)."""

    def __init__(self, hashes: np.ndarray, item: np.ndarray):
        both = np.unique(np.stack([hashes, item.astype(np.uint64)], axis=1), axis=0)
        self.kinds, at = np.unique(both[:, 0], return_index=True)
        self.item, self.begin = both[:, 1].astype(np.int64), np.append(at, len(both))


def _stretches(row: np.ndarray, at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of places in a row, sorted, that are at most ``gap`` apart."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > gap)
    i = np.flatnonzero(new)
    return row[i], at[i], at[np.append(i[1:], len(at)) - 1] if len(i) else at[:0]


class Items:
    """Items of one part of a benchmark, classed and indexed."""

    def __init__(self, ids: list, texts: pa.Array):
        self.ids, self.kinds, self.n_words = ids, [], []
        classes: dict[tuple, list] = {}
        watched = []
        row = 0
        for begin, end, values, offsets in pieces(texts):
            h, first = word_hashes(values, offsets, WORD)
            for i in range(end - begin):
                words = h[first[i]:first[i + 1]]
                n = len(words)
                own = shingles(words, np.array([0, n]), SHINGLE)[0]
                kinds, wanted = np.unique(own, return_counts=True)
                self.kinds.append((kinds, wanted, len(own)))
                self.n_words.append(n)
                unique = unique_run(words)
                if n >= SHINGLE and unique > 3:
                    # enough of the shingles that stand in it least often, so that none similar is without
                    order = np.argsort(wanted, kind="stable")
                    enough = np.searchsorted(np.cumsum(wanted[order]), len(own) - least_shared(len(own)) + 1) + 1
                    watched.append((kinds[order[:enough]], np.full(min(enough, len(kinds)), row)))
                elif n:
                    size, stride, strides = grid(n, unique)
                    f = np.concatenate([fingerprints(own[k:k + stride * strides], stride, strides) for k in range(len(own) - stride * strides + 1)])
                    classes.setdefault((size, stride, strides), []).append((f, np.full(len(f), row)))
                row += 1
        self.classes = {}
        for key, found in classes.items():
            holders = Holders(*map(np.concatenate, zip(*found, strict=True)))
            self.classes[key] = holders, HammingIndex(holders.kinds)
        self.watched = Holders(*map(np.concatenate, zip(*watched, strict=True))) if watched else None
        self.sizes = np.array([k[2] for k in self.kinds])

    def find(self, values: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(row, item, similarity, first word, words) of the best window of
        every row and item that reach the threshold."""
        h, first = word_hashes(values, offsets, WORD)
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        spans: list[np.ndarray] = []

        def starts(row, at, holders, kind, width):
            """Ranges of starts of the windows that hold one of the places,
            ``width`` shingles wide, of one kind of hash."""
            item = holders.item[holders.begin[kind]:holders.begin[kind + 1]]
            row, low, high = _stretches(row, at, width)
            spans.append(np.stack([np.repeat(row, len(item)), np.tile(item, len(row)),
                                   (low[:, None] + width - self.sizes[item]).ravel(), np.repeat(high, len(item))], axis=1))

        def shingled(size):
            if size not in made:
                made[size] = shingles(h, first, size)
            return made[size]

        for (size, stride, strides), (holders, index) in self.classes.items():
            s, begin = shingled(size)
            kinds, which = np.unique(fingerprints(s, stride, strides), return_inverse=True)
            q, e = index.search(kinds)
            if not len(q):
                continue
            found = np.flatnonzero(np.isin(which, q))
            at = found * stride
            row = np.searchsorted(begin, at, side="right") - 1
            inside = at + stride * strides <= begin[row + 1]
            kind, row, at = which[found][inside], row[inside], at[inside]
            order = np.argsort(kind, kind="stable")
            kind, row, at = kind[order], row[order], (at - begin[row])[order]
            low, high = np.searchsorted(kind, q), np.searchsorted(kind, q, side="right")
            for i in np.flatnonzero(high > low).tolist():
                starts(row[low[i]:high[i]], at[low[i]:high[i]], holders, e[i], stride * strides)
        if self.watched is not None:
            s, begin = shingled(SHINGLE)
            at = np.searchsorted(self.watched.kinds, s)
            at[at == len(self.watched.kinds)] = 0
            found = np.flatnonzero(self.watched.kinds[at] == s) if len(self.watched.kinds) else np.zeros(0, np.int64)
            found = found[np.argsort(at[found], kind="stable")]
            row = np.searchsorted(begin, found, side="right") - 1
            kind = at[found]
            edge = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])[:len(kind)])
            for i, j in zip(edge, np.append(edge[1:], len(kind))[:len(edge)], strict=True):
                starts(row[i:j], (found - begin[row])[i:j], self.watched, kind[i], 1)
        out = []
        if not spans:
            return out
        all_ = np.concatenate(spans)
        all_ = all_[np.lexsort((all_[:, 2], all_[:, 1], all_[:, 0]))]
        edge = np.flatnonzero(np.append(True, (all_[1:, :2] != all_[:-1, :2]).any(1)))
        for i, j in zip(edge.tolist(), np.append(edge[1:], len(all_)).tolist(), strict=True):
            row, item = all_[i, :2].tolist()
            s, begin = shingled(min(SHINGLE, self.n_words[item]))
            got = self._best(s[begin[row]:begin[row + 1]], item, all_[i:j, 2:], int(first[row + 1] - first[row]))
            if got:
                out.append((row, item, *got))
        return out

    def _best(self, s: np.ndarray, item: int, ranges: np.ndarray, n_words: int):
        """Best window of the item's size that starts in the ranges."""
        a = self.kinds[item][2]
        last = max(0, len(s) - a)
        low = np.minimum(np.maximum(ranges[:, 0], 0), last)
        high = np.maximum(np.minimum(np.maximum.accumulate(ranges[:, 1]), last), low)
        edge = np.flatnonzero(np.append(True, low[1:] > high[:-1] + 1))
        best = None
        for i, j in zip(edge, np.append(edge[1:], len(low)), strict=True):
            lo, hi = int(low[i]), int(high[i:j].max())
            similarity = self._similarities(s[lo:hi + a], item, hi - lo + 1)
            k = int(similarity.argmax())
            if similarity[k] >= THRESHOLD and (best is None or similarity[k] > best[0]):
                best = float(similarity[k]), lo + k, min(self.n_words[item], n_words - lo - k)
        return best

    def _similarities(self, part: np.ndarray, item: int, n: int) -> np.ndarray:
        """Similarity of the windows that start at the first ``n`` places.

        An occurrence counts in all windows that hold it and fewer earlier
        ones of its kind than the item has: one interval of starts."""
        kinds, wanted, a = self.kinds[item]
        at = np.searchsorted(kinds, part)
        at[at == len(kinds)] = 0
        place = np.flatnonzero(kinds[at] == part)
        kind = at[place]
        order = np.argsort(kind, kind="stable")
        kind, place = kind[order], place[order]
        earlier = np.arange(len(kind)) - wanted[kind]       # the occurrence that crowds this one out
        known = (earlier >= 0) & (kind[np.maximum(earlier, 0)] == kind)
        begin = np.maximum(place - a + 1, np.where(known, place[np.maximum(earlier, 0)] + 1, 0))
        begin = np.maximum(begin, 0)
        end = np.minimum(place, n - 1) + 1
        real = begin < end
        both = np.cumsum(np.bincount(begin[real], minlength=n + 1)[:n] - np.bincount(end[real], minlength=n + 1)[:n])
        size = min(a, len(part))
        return both / (a + size - both)


def _parts(benchmark: DataFrame):
    """The distinct items in parts of bounded size."""
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    n = max(1, -(-size // PART_BYTES))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow()
        ids = part["item_id"].to_pylist()
        yield Items(ids, part["text"].combine_chunks()) if ids else None


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that it contains: doc_id, item_id,
    similarity, start_word, n_words (of the best window)."""
    src = docs.select("doc_id", "text")
    id_type, item_type = src.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, similarity double, start_word bigint, n_words bigint"
    out = src.sparkSession.createDataFrame([], schema)
    for items in _parts(benchmark):
        if items is not None:
            out = out.union(src.mapInArrow(_searcher(src, items, benchmark.select("item_id").schema), schema))
    return out


def _searcher(src: DataFrame, items: Items, id_schema):
    item_arrow = to_arrow_schema(id_schema).field(0).type
    shared = src.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        model = shared.value
        for batch in batches:
            for begin, _, values, offsets in pieces(batch.column(1), PIECE):
                found = model.find(values, offsets)
                rows = pa.array([begin + f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).take(rows), "item_id": pa.array([model.ids[f[1]] for f in found], item_arrow),
                    "similarity": pa.array([f[2] for f in found], pa.float64()),
                    "start_word": pa.array([f[3] for f in found], pa.int64()), "n_words": pa.array([f[4] for f in found], pa.int64())})
    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    at = docs.columns.index("text")
    for items in _parts(benchmark):
        if items is not None:
            shared = docs.sparkSession.sparkContext.broadcast(items)

            def run(batches, shared=shared):
                for batch in batches:
                    clean = np.ones(batch.num_rows, dtype=bool)
                    for begin, _, values, offsets in pieces(batch.column(at), PIECE):
                        clean[[begin + f[0] for f in shared.value.find(values, offsets)]] = False
                    yield batch.filter(pa.array(clean))

            docs = docs.mapInArrow(run, docs.schema)
    return docs
