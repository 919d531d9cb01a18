"""Language-model scores from a log-frequency Bloom filter.

Training: words and word pairs of all training texts are counted (partial
counts per task, summed per region of the hash space).  A count c is
quantised to level 1 + floor(log2 c); the filter holds (n-gram, 1), ...,
(n-gram, level), so a count is read by probing levels until one is absent.
Every region of the hash space owns a slice of the filter, and the number of
regions grows with the corpus.  A slice holds every level of its n-grams: it
has its share of ``filter_bytes`` at least, and more where that gives an entry
less than ``BITS_PER_ENTRY`` bits.

Scoring: P(w | v) = (c(vw) + MU * P(w)) / (c(v) + MU) with
P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)), all counts c by probes.

The filter and the exact counts of the base score grow with the corpus.  They
are never broadcast: documents are dealt into blocks of bounded size, a block
asks the regions for its distinct words and pairs only, and the answers (exact
counts of words, levels of words and pairs) come back to the block (two
shuffles of distinct hashes and answers, however hot a word is).

Words are told apart by 64-bit hashes.

Results for special inputs: a null text is the empty text (the end token
alone); a row with a null doc_id is held out; without training tokens every
count is 0; repeated rows are counted and scored as often as they occur; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.llm.op7_language import remainder
from routeweave.llm.tables import from_planes, planes, written
from routeweave.llm.textbytes import mix64, pieces, word_hashes

FILTER_BYTES = 32 << 20
BITS_PER_ENTRY = 6
PROBES = 3
MU = 4.0
BLOCK_BYTES = 6 << 20
REGION_BYTES = 8 << 20
FLUSH_TOKENS = 2_000_000

_U = np.uint64
END = mix64(np.array([0xE0D], np.uint64))[0]


def token_hashes(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's words and its end token; (hashes, row begins)."""
    h, first = word_hashes(values, offsets)
    rows = len(offsets) - 1
    begin = first + np.arange(rows + 1)
    out = np.full(len(h) + rows, END, dtype=np.uint64)
    keep = np.ones(len(out), dtype=bool)
    keep[begin[1:] - 1] = False
    out[keep] = h
    return out, begin


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hash of (previous token, token); a text begins after an end token."""
    before = np.concatenate([[END], tokens[:-1]]) if len(tokens) else tokens
    return mix64(before * _U(0x9E3779B97F4A7C15) + tokens * _U(0xC2B2AE3D27D4EB4F) + _U(1))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    return np.where(level > 0, (1.5 * np.exp2(level - 1.0)) - 0.5, 0.0)


def _bits(h: np.ndarray, level, mask: int) -> list[np.ndarray]:
    """The bit positions, within a region's slice, of (n-gram, level)."""
    g = mix64(h + _U(0x9FB21C651E98DF25) * np.asarray(level, dtype=np.uint64))
    a, b = g & _U(0xFFFFFFFF), (g >> _U(32)) | _U(1)
    return [((a + _U(i) * b) & _U(mask)).astype(np.int64) for i in range(PROBES)]


def build_slice(h: np.ndarray, counts: np.ndarray, n_bytes: int) -> tuple[bytes, int]:
    """One region's slice of the filter and its lowest level."""
    level = levels(counts)
    top = int(level.max(initial=0))
    entries = np.bincount(level, minlength=top + 2)[::-1].cumsum()[::-1]     # n-grams of at least a level
    lowest = 1
    while lowest < top and entries[lowest:].sum() * BITS_PER_ENTRY > n_bytes * 8:
        lowest += 1
    out = np.zeros(n_bytes * 8, dtype=bool)
    for j in range(lowest, top + 1):
        for at in _bits(h[level >= j], j, n_bytes * 8 - 1):
            out[at] = True
    return np.packbits(out, bitorder="little").tobytes(), lowest


class CountFilter:
    """The whole filter on a worker: quantised counts by probing."""

    def __init__(self, slices: list[tuple[int, bytes, int]], regions: int, n_bytes: int):
        self.shift = 64 - (regions.bit_length() - 1)
        self.slice_bits = n_bytes * 8
        self.bits = np.zeros(regions * n_bytes, dtype=np.uint8)
        self.lowest = np.ones(regions, dtype=np.int64)
        for region, data, lowest in slices:
            self.bits[region * n_bytes:(region + 1) * n_bytes] = np.frombuffer(data, np.uint8)
            self.lowest[region] = lowest

    def levels(self, h: np.ndarray) -> np.ndarray:
        region = (h >> _U(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(h), np.int64)
        out = np.zeros(len(h), dtype=np.int64)
        rows, at = np.arange(len(h)), self.lowest[region]
        while len(rows):
            alive = np.ones(len(rows), dtype=bool)
            for bit in _bits(h[rows], at, self.slice_bits - 1):
                place = region[rows] * self.slice_bits + bit
                alive &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            rows, at = rows[alive], at[alive]
            out[rows] = at
            at = at + 1
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        return level_count(self.levels(h))


def slice_size(counts: np.ndarray, least: int) -> int:
    """Bytes, a power of two, of a slice that holds every level."""
    return _power_of_two(max(least, levels(counts).sum() * BITS_PER_ENTRY / 8))


def _split_regions(h: np.ndarray, shift: int):
    """(region, begin, end) over sorted hashes."""
    if not len(h):
        return
    region = (h >> _U(shift)).astype(np.int64) if shift < 64 else np.zeros(len(h), np.int64)
    cut = np.flatnonzero(np.diff(region)) + 1
    for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(h)]]), strict=True):
        yield int(region[a]), int(a), int(b)


def count_ngrams(texts: DataFrame, regions: int, filter_bytes: int) -> DataFrame:
    """One row per region: exact word counts, their totals and the slice."""
    shift = 64 - (regions.bit_length() - 1)
    least = max(64, filter_bytes // regions)

    def partial(batches):
        held: list[list[np.ndarray]] = [[], []]
        size = 0

        def flush():
            for order in (0, 1):
                h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held[order]]), return_counts=True)
                held[order].clear()
                cuts = list(_split_regions(h, shift))
                if cuts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c[0] for c in cuts], pa.int32()), pa.array([order] * len(cuts), pa.int32()),
                         pa.array([planes(h[a:b]) for _, a, b in cuts], pa.binary()),
                         pa.array([planes(n[a:b].astype(np.uint32)) for _, a, b in cuts], pa.binary())],
                        names=["region", "word_order", "hashes", "counts"])

        for batch in batches:
            for _, _, values, offsets in pieces(batch.column(0)):
                tokens, _ = token_hashes(values, offsets)
                held[0].append(tokens)
                held[1].append(pair_hashes(tokens))
                size += len(tokens)
                if size >= FLUSH_TOKENS:
                    yield from flush()
                    size = 0
        yield from flush()

    def merge(key, table):
        found = {}
        for order in (0, 1):
            part = table.filter(pa.compute.equal(table["word_order"], order))
            h = [from_planes(x, "u8") for x in part["hashes"].to_pylist()]
            n = [from_planes(x, "u4") for x in part["counts"].to_pylist()]
            found[order] = summed(np.concatenate([np.zeros(0, np.uint64), *h]),
                                  np.concatenate([np.zeros(0, np.int64), *n]).astype(np.int64))
        (h, n), (h2, n2) = found[0], found[1]
        both = np.concatenate([n, n2])
        data, lowest = build_slice(np.concatenate([h, h2]), both, slice_size(both, least))
        return pa.table({"region": pa.array([key[0].as_py()], pa.int32()), "hashes": [planes(h)], "counts": [planes(n)],
                         "n_words": pa.array([len(h)], pa.int64()), "n_tokens": pa.array([int(n.sum())], pa.int64()),
                         "slice": [data], "lowest": pa.array([lowest], pa.int32())})

    return (texts.select("text")
            .mapInArrow(partial, "region int, word_order int, hashes binary, counts binary")
            .groupBy("region").applyInArrow(merge, "region int, hashes binary, counts binary, n_words bigint, "
                                            "n_tokens bigint, slice binary, lowest int"))


def _power_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, x)))))


def score_documents(docs: DataFrame, folds: int = 10, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Scores of all documents under the model of those whose id does not
    fall into the held-out fold (remainder 0)."""
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    size = src.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    regions = _power_of_two(max(16, size / REGION_BYTES))
    blocks = max(1, -(-size // BLOCK_BYTES))
    shift = 64 - (regions.bit_length() - 1)

    known = written(count_ngrams(src.filter(remainder(F.col("doc_id"), folds) != 0), regions, filter_bytes), "lm-counts")
    total = known.agg(F.sum("n_tokens"), F.sum("n_words")).collect()[0]
    n_all, n_distinct = total[0] or 0, total[1] or 0

    held = remainder(F.col("doc_id"), folds) == 0
    dealt = src.select("doc_id", "text", held.alias("held_out"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))
    dealt = dealt.repartition(blocks, "block")

    def asked(batches):
        """Distinct hashes of each block's tokens and pairs, by region."""
        held: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            block_of = batch.column(3).to_numpy()
            for block in np.unique(block_of):
                parts = held.setdefault(int(block), [[], []])
                for _, _, values, offsets in pieces(batch.column(1).filter(pa.array(block_of == block))):
                    tokens, _ = token_hashes(values, offsets)
                    parts[0].append(np.unique(tokens))
                    parts[1].append(np.unique(pair_hashes(tokens)))
        for block, parts in held.items():
            cuts = []
            for part in parts:
                h = np.unique(np.concatenate(part))
                part.clear()
                cuts.append({r: planes(h[a:b]) for r, a, b in _split_regions(h, shift)})
            of = sorted({*cuts[0], *cuts[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(of, pa.int32()), pa.array([block] * len(of), pa.int64()),
                 *(pa.array([c.get(r, b"") for r in of], pa.binary()) for c in cuts)], names=["region", "block", "asked", "pairs"])

    def answer(key, left, right):
        """Exact counts and levels of the asked hashes, in their order."""
        have, slices, n_bytes = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 1
        if right.num_rows:
            have = from_planes(right["hashes"][0].as_py(), "u8"), from_planes(right["counts"][0].as_py(), "i8")
            data = right["slice"][0].as_py()
            slices, n_bytes = [(0, data, right["lowest"][0].as_py())], len(data)
        filt = CountFilter(slices, 1, n_bytes)
        keys, counts = np.append(have[0], _U(0)), np.append(have[1], 0)
        exact, single, double = [], [], []
        for x, y in zip(left["asked"].to_pylist(), left["pairs"].to_pylist(), strict=True):
            h = from_planes(x, "u8")
            at = np.searchsorted(have[0], h)
            exact.append(planes(np.where(keys[at] == h, counts[at], 0)))
            single.append(filt.levels(h).astype(np.uint8).tobytes())
            double.append(filt.levels(from_planes(y, "u8")).astype(np.uint8).tobytes())
        return pa.table({"block": left["block"], "region": left["region"], "counts": pa.array(exact, pa.binary()),
                         "levels": pa.array(single, pa.binary()), "pairs": pa.array(double, pa.binary())})

    def score(key, left, right):
        parts = [token_hashes(v, o) for _, _, v, o in pieces(left["text"].combine_chunks())]
        uniq = np.unique(np.concatenate([np.unique(p[0]) for p in parts]))
        pairs = np.unique(np.concatenate([np.unique(pair_hashes(p[0])) for p in parts]))
        order = np.argsort(right["region"].to_numpy())
        exact, single, double = (np.concatenate([from_planes(x[i], "i8") if c == "counts" else np.frombuffer(x[i], np.uint8) for i in order])
                                 for c in ("counts", "levels", "pairs") for x in (right[c].to_pylist(),))
        base = np.log10((exact + 0.1) / (n_all + 0.1 * (n_distinct + 1)))
        approx, approx2 = level_count(single.astype(np.int64)), level_count(double.astype(np.int64))
        single = (approx + 0.1) / (n_all + 0.1 * (n_distinct + 1))
        end = np.searchsorted(uniq, END)
        sums = []
        for tokens, begin in parts:
            at, first = np.searchsorted(uniq, tokens), begin[:-1]
            history = approx[np.concatenate([[end], at[:-1]])]      # a text begins after an end token
            both = approx2[np.searchsorted(pairs, pair_hashes(tokens))]
            p = (np.minimum(both, history) + MU * single[at]) / (history + MU)
            sums.append((np.diff(begin), np.add.reduceat((exact[at] > 0).astype(np.int64), first),
                         np.add.reduceat(base[at], first), np.add.reduceat(np.log10(np.minimum(p, 1.0)), first)))
        n, known_, base_sum, model_sum = (np.concatenate([x[i] for x in sums]) for i in range(4))
        return pa.table({"doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": pa.array(n, pa.int64()),
                         "n_known": pa.array(known_, pa.int64()), "train_tokens": pa.array(np.full(len(n), n_all), pa.int64()),
                         "base_score": pa.array(base_sum), "score": pa.array(model_sum)})

    need = dealt.mapInArrow(asked, "region int, block bigint, asked binary, pairs binary")
    counted = (need.groupBy("region").cogroup(known.select("region", "hashes", "counts", "slice", "lowest").groupBy("region"))
               .applyInArrow(answer, "block bigint, region int, counts binary, levels binary, pairs binary"))
    return (dealt.groupBy("block").cogroup(counted.groupBy("block"))
            .applyInArrow(score, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
                                 "train_tokens bigint, base_score double, score double"))
