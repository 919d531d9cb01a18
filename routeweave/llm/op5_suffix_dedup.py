"""Repeated byte strings by suffix arrays over aligned contexts.

A window is a string of ``length`` bytes.  Its anchor is the k-gram with the
least hash inside it (the leftmost of equals), so equal windows have equal
anchors at equal offsets, wherever they are.  Neighbouring windows share
anchors; a run of windows with one anchor, with the bytes it covers, is a
context, and only a few of them are made per hundred bytes.

1. Anchors that occur once have no repeated window (a count by hash).
2. Equal contexts of an anchor repeat all their windows.
3. Different contexts of one anchor are compared on their bytes: a suffix
   array over the contexts of some anchors ranks suffixes by their first
   ``length`` bytes; the previous and the next smaller position in suffix
   order give each window the length of its longest previous factor, and over
   the reversed order that of its longest later one.  A window goes where one
   of them (for "first": the previous one) is ``length``.  An anchor with more
   than ``GROUP`` contexts is compared by counted window hashes instead, so
   no group is held whole.

``keep="first"`` removes windows with an earlier copy, in order of doc_id and
position; ``keep="none"`` removes all copies.  Strings are judged on the
input; matches never cross documents.

Results for special inputs: a null text is the empty text; texts shorter than
``length`` stay whole; repeated rows are copies of each other (of rows with
equal doc_id and text, "first" counts none as earlier); rows with a null
doc_id count and come first; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.llm.bloom import bloom_filter, may_contain
from routeweave.llm.tables import written
from routeweave.llm.textbytes import as_bytes, mix64, pieces, powers, prefix_hash, span_hash

GRAMS_PER_WINDOW = 4     # a window is this many anchor lengths
GROUP = 1000
NARROW = 8              # windows of a narrow context, at most
CHUNK = 1 << 19
SEGMENT = 4 << 20       # windows of a very long text are taken in segments
POSITION_BITS = 24

_U = np.uint64


def contexts(values: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Contexts of all windows of some texts: (anchor hash, context hash,
    row, anchor - first window, first window, last window), positions within
    the given bytes."""
    n = len(values)
    if n < length:
        return [np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)]
    prefix = prefix_hash(values)
    v = mix64((prefix[gram:] - prefix[:-gram]) * powers(n - gram + 1)[1])
    key = (v & ~_U((1 << POSITION_BITS) - 1)) | np.arange(len(v), dtype=np.uint64)
    w = length - gram + 1       # k-grams of a window
    least, span = key, 1
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[:len(least) - (w - span)], least[w - span:])
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), np.maximum(0, size - length + 1))
    first = np.cumsum(np.maximum(0, size - length + 1)) - np.maximum(0, size - length + 1)
    start = offsets[:-1][row] + np.arange(len(row)) - first[row]
    anchor = (least[start] & _U((1 << POSITION_BITS) - 1)).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(start)]]) - 1
    s1, s2, p = start[begin], start[end], anchor[begin]
    context = mix64(span_hash(prefix, s1, s2 + length) + (p - s1).astype(np.uint64))
    return v[p], context, row[begin], p - s1, s1, s2


def _segments(column: pa.Array, length: int):
    """(first row, bytes, offsets, position of the bytes in their row)."""
    for begin, end, values, offsets in pieces(column):
        if len(values) <= SEGMENT + length:
            yield begin, values, offsets, 0
        else:       # one long text: segments overlap by a window less a byte
            for at in range(0, max(1, len(values) - length + 1), SEGMENT):
                part = values[at:at + SEGMENT + length - 1]
                yield begin, part, np.array([0, len(part)]), at


def text_ids(column: pa.Array) -> np.ndarray:
    """A hash of each row's whole text."""
    values, offsets = as_bytes(column)
    out = [hashlib.blake2b(values[a:b], digest_size=8).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.frombuffer(b"".join(out), np.int64)


def place_hash(h: np.ndarray, c: np.ndarray, tid: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of one context's occurrence."""
    return mix64(mix64(h ^ mix64(c)) + mix64(tid.view(np.uint64) + start.astype(np.uint64)))


def _anchors(docs: DataFrame, length: int, bits=None, with_bytes: bool = False, places: bool = False) -> DataFrame:
    """Contexts of all texts as rows: only anchor and context hash, or with
    where they are, or with their bytes; those that a filter lets through."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches):
        for batch in batches:
            tid = text_ids(batch.column(1)) if places or with_bytes else None
            for begin, values, offsets, base in _segments(batch.column(1), length):
                h, c, row, back, s1, s2 = contexts(values, offsets, length, max(1, length // GRAMS_PER_WINDOW))
                home = offsets[:-1][row]
                keep = slice(None)
                if shared is not None:
                    asked = place_hash(h, c, tid[begin + row], s1 - home + base) if with_bytes else h
                    keep = np.flatnonzero(may_contain(shared.value, asked))
                    h, c, row, back, s1, s2, home = (x[keep] for x in (h, c, row, back, s1, s2, home))
                columns = {"h": pa.array(h.view(np.int64)), "c": pa.array(c.view(np.int64))}
                if places or with_bytes:
                    columns |= {"doc_id": batch.column(0).take(pa.array(begin + row)), "tid": pa.array(tid[begin + row]),
                                "start": pa.array(s1 - home + base), "back": pa.array(back.astype(np.int32)),
                                "windows": pa.array((s2 - s1 + 1).astype(np.int32))}
                if with_bytes:
                    columns["data"] = pa.array([values[a:b + length].tobytes() for a, b in zip(s1, s2, strict=True)], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "h bigint, c bigint"
    if places or with_bytes:
        schema += f", doc_id {id_type}, tid bigint, start bigint, back int, windows int"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", data binary" if with_bytes else ""))


PACKED = 20     # bits of a rank and of a position that share a sorted word


class Suffixes:
    """Suffixes of some bytes in order of their first ``length`` bytes.

    ``levels``: (span, ranks): the rank of every suffix by its first ``span``
    bytes, equal strings having equal ranks, by prefix doubling; the end is
    padded with zeros.  Below 2^20 bytes, (rank, rank after, position) fit one
    word, so that a plain sort of words does each round."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        n = len(data)
        packed = n < 1 << PACKED
        span = min(5, length)
        padded = np.concatenate([data, np.zeros(5, np.uint8)]).astype(np.uint64)
        key = np.zeros(n, dtype=np.uint64)
        for i in range(span):
            key = key << _U(8) | padded[i:n + i]
        position = np.arange(n, dtype=np.uint64)

        def ranks(key: np.ndarray) -> np.ndarray:
            if not packed:
                return np.unique(key, return_inverse=True)[1].astype(np.uint64)
            word = np.sort(key << _U(PACKED) | position)
            group = word >> _U(PACKED)
            out = np.empty(n, dtype=np.uint64)
            out[(word & _U((1 << PACKED) - 1)).astype(np.int64)] = np.cumsum(
                np.concatenate([[0], group[1:] != group[:-1]])) if n else 0
            return out

        rank = ranks(key)
        self.levels = [(span, rank.astype(np.uint32))]
        while span < length:
            step = min(span, length - span)
            after = np.concatenate([rank[step:] + _U(1), np.zeros(min(step, n), np.uint64)])
            rank = ranks(rank << _U(PACKED if packed else 32) | after)
            span += step
            self.levels.append((span, rank.astype(np.uint32)))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b, up to ``length``
        (and up to the end of the bytes)."""
        n, size = len(self.data), np.zeros(len(a), np.int64)
        for span, rank in reversed(self.levels):
            x, y = a + size, b + size
            fits = np.maximum(x, y) + span <= n
            size[fits] += span * (rank[x[fits]] == rank[y[fits]])
        open_ = np.arange(len(a))
        for _ in range(self.levels[0][0] - 1):
            x, y = a[open_] + size[open_], b[open_] + size[open_]
            open_ = open_[np.maximum(x, y) < n]
            x, y = a[open_] + size[open_], b[open_] + size[open_]
            open_ = open_[self.data[x] == self.data[y]]
            size[open_] += 1
        return np.minimum(size, self.length)


def longest_factors(suffixes: Suffixes, at: np.ndarray, later: bool = False) -> np.ndarray:
    """LPF: for each of the positions ``at``, in order, the length (up to
    ``length``) of the longest string that begins there and at a position of
    ``at`` before it; ``later``: after it, the same over the reversed order.

    Suffix order lists positions by rank.  The longest previous factor is
    shared with the previous or the next smaller position in that order; both
    are found by jumping along those of its neighbours."""
    n = len(at)
    turn = np.arange(n)[::-1] if later else np.arange(n)
    order = np.lexsort((turn, suffixes.levels[-1][1][at]))
    place = turn[order]
    best = np.zeros(n, np.int64)
    for sign in (-1, 1):
        link = np.arange(n) + sign                  # candidate for the smaller position on this side
        if n:
            link[0 if sign < 0 else -1] = -1
        open_ = np.flatnonzero(link >= 0)
        while len(open_):
            open_ = open_[place[link[open_]] > place[open_]]
            link[open_] = link[link[open_]]
            open_ = open_[link[open_] >= 0]
        found = np.flatnonzero(link >= 0)
        best[found] = np.maximum(best[found], suffixes.common(at[order[found]], at[order[link[found]]]))
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def suffix_ranks(data: np.ndarray, length: int) -> Suffixes:
    return Suffixes(data, length)


def earlier_copies(suffixes: Suffixes, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of some positions: whether the longest previous factor reaches
    ``length``, and whether that or the longest later one does."""
    at = np.arange(len(suffixes.data)) if at is None else at
    earlier = longest_factors(suffixes, at) >= suffixes.length
    return earlier, earlier | (longest_factors(suffixes, at, later=True) >= suffixes.length)


def _compare(rows: DataFrame, length: int, keep: str) -> DataFrame:
    """Removed spans from contexts with bytes, some anchors at a time."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def spans(table: pa.Table):
        values, begin = as_bytes(table["data"])
        flat, begin = values[begin[0]:begin[-1]], begin - begin[0]
        windows = table["windows"].to_numpy().astype(np.int64)
        of = np.repeat(np.arange(len(windows)), windows)
        at = begin[:-1][of] + np.arange(len(of)) - (np.cumsum(windows) - windows)[of]
        suffixes = suffix_ranks(flat, length)
        factor = longest_factors(suffixes, at)
        if keep == "none":
            factor = np.maximum(factor, longest_factors(suffixes, at, later=True))
        hit = np.flatnonzero(factor >= length)
        start = table["start"].to_numpy()[of[hit]] + at[hit] - begin[:-1][of[hit]]
        yield from _runs(table["doc_id"], table["tid"], of[hit], start, length)

    def chunks(table: pa.Table):
        """Runs of whole anchors of less than CHUNK bytes, where they fit."""
        h = table["h"].to_numpy()
        size = np.cumsum([0, *pc.binary_length(table["data"]).to_numpy()])
        edge = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1, [len(h)]]) if len(h) else [0]
        begin = 0
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if size[b] - size[begin] >= CHUNK and a > begin:
                yield from spans(table.slice(begin, a - begin))
                begin = a
        if begin < len(h):
            yield from spans(table.slice(begin))

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            if rest.nbytes >= CHUNK:
                h = rest["h"].to_numpy()
                cut = int(np.searchsorted(h, h[-1]))        # the last anchor may go on
                yield from chunks(rest.slice(0, cut))
                rest = rest.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from chunks(rest)

    dealt = rows.repartition("h").sortWithinPartitions("h", "doc_id", "start")
    return dealt.mapInArrow(run, f"doc_id {id_type}, tid bigint, start bigint, stop bigint")


def _runs(doc_id, tid, row: np.ndarray, start: np.ndarray, length: int):
    """Removed spans of consecutive windows of a row."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.concatenate([a[1:], [len(row)]]) - 1 if len(row) else a
    at = pa.array(row[a])
    flat = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (doc_id, tid)]
    yield pa.RecordBatch.from_arrays([*(x.take(at) for x in flat), pa.array(start[a]), pa.array(start[b] + length)],
                                     names=["doc_id", "tid", "start", "stop"])


def _narrow(rows: DataFrame, length: int) -> DataFrame:
    """Contexts cut into contexts of at most NARROW windows.  Their key is a
    hash of the bytes that all their windows share, and of their place
    beside the anchor; equal windows have equal keys."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    width = max(1, min(NARROW, length // GRAMS_PER_WINDOW))

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            values, offsets = as_bytes(table["data"])
            values, home = values[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0]
            prefix = prefix_hash(values)
            back, windows = (table[c].to_numpy().astype(np.int64) for c in ("back", "windows"))
            # cut where the distance of a window to the anchor is a multiple of width
            first, last = back // width, (back - windows + 1) // width
            n = first - last + 1
            of = np.repeat(np.arange(len(n)), n)
            block = first[of] - (np.arange(len(of)) - (np.cumsum(n) - n)[of])
            far, near = block * width + width - 1, block * width
            begin = np.maximum(0, back[of] - far)
            end = np.minimum(windows[of] - 1, back[of] - near)       # last window
            s1, s2, anchor = home[of] + begin, home[of] + end, home[of] + back[of]
            # what all windows at these distances have in common lies in each of them
            core = mix64(span_hash(prefix, anchor - near, anchor - far + length) + block.astype(np.uint64))
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(core.view(np.int64)), "c": pa.array(span_hash(prefix, s1, s2 + length).view(np.int64)),
                "doc_id": table["doc_id"].combine_chunks().take(pa.array(of)), "tid": table["tid"].combine_chunks().take(pa.array(of)),
                "start": pa.array(table["start"].to_numpy()[of] + begin), "windows": pa.array((end - begin + 1).astype(np.int32)),
                "data": pa.array([values[x:y + length].tobytes() for x, y in zip(s1, s2, strict=True)], pa.binary())})

    return rows.mapInArrow(run, f"h bigint, c bigint, doc_id {id_type}, tid bigint, start bigint, windows int, data binary")


def _windows(rows: DataFrame, length: int) -> DataFrame:
    """One row per window: (w, doc_id, tid, start), w a hash of its bytes."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            values, offsets = as_bytes(table["data"])
            prefix = prefix_hash(values[offsets[0]:offsets[-1]])
            windows = table["windows"].to_numpy().astype(np.int64)
            of = np.repeat(np.arange(len(windows)), windows)
            k = np.arange(len(of)) - (np.cumsum(windows) - windows)[of]
            at = offsets[:-1][of] - offsets[0] + k
            yield pa.RecordBatch.from_arrays(
                [pa.array(span_hash(prefix, at, at + length).view(np.int64)), table["doc_id"].combine_chunks().take(pa.array(of)),
                 table["tid"].combine_chunks().take(pa.array(of)), pa.array(table["start"].to_numpy()[of] + k)],
                names=["w", "doc_id", "tid", "start"])

    return rows.mapInArrow(run, f"w bigint, doc_id {id_type}, tid bigint, start bigint")


def _compare_hot(rows: DataFrame, length: int, keep: str) -> DataFrame:
    """The same for anchors with very many contexts: narrow contexts are
    counted by hash first (with partial counts before the shuffle), and only
    the windows of different narrow contexts that share their core are
    counted one by one."""
    narrow = written(_narrow(rows, length), "repeat-narrow")
    least = written(narrow.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "start", "tid", "windows", "data")).alias("least")), "repeat-firsts")
    again = narrow.drop("data").join(least.filter("n > 1").select("h", "c", F.col("least").dropFields("data").alias("least")), ["h", "c"])
    if keep == "first":
        again = again.filter(~_is_least())
    again = again.select("doc_id", "tid", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("stop"))
    mixed = least.groupBy("h").count().filter("count > 1").select("h")
    every = written(_windows(least.join(mixed, "h", "left_semi").select("least.*"), length), "repeat-windows")
    met = every.groupBy("w").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start", "tid")).alias("least")).filter("n > 1")
    hit = every.join(met, "w")
    if keep == "first":
        hit = hit.filter(~_is_least())
    return again.union(hit.select("doc_id", "tid", "start", (F.col("start") + length).alias("stop")))


def repeated_spans(docs: DataFrame, length: int = 200, keep: str = "first") -> DataFrame:
    """(doc_id, tid, start, stop): byte spans to remove, which may overlap;
    tid is a hash of the row's text."""
    docs = docs.select("doc_id", "text").filter(F.octet_length("text") >= length)
    met = _anchors(docs, length).groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    met = written(met.filter("n > 1").select("h", (F.col("lo") != F.col("hi")).alias("mixed")), "repeat-anchors")
    rows = _anchors(docs, length, bloom_filter(met, "h"), places=True)
    rows = written(rows.join(met, "h"), "repeat-contexts")

    # equal contexts: all of their windows, but for the first context where it stays
    place = F.struct("doc_id", "start", "tid", "back", "windows")
    least = rows.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(place).alias("least"), F.first("mixed").alias("mixed"))
    least = written(least, "repeat-firsts")
    if keep == "first":
        equal = rows.join(least.filter("n > 1").select("h", "c", "least"), ["h", "c"]).filter(~_is_least())
    else:
        equal = rows.join(least.filter("n > 1").select("h", "c"), ["h", "c"], "left_semi")
    equal = equal.select("doc_id", "tid", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("stop"))

    # different contexts of an anchor: on their bytes
    firsts = least.filter("mixed").select("h", "c", "least.*")
    wanted = firsts.select("h", "c", "tid", "start")
    asked = wanted.mapInArrow(_place_rows, "place bigint")
    found = _anchors(docs, length, bloom_filter(asked, "place"), with_bytes=True)
    # one place stands for all copies: repeated rows for "first"; else contexts met twice are removed whole above
    found = found.dropDuplicates(["h", "c", "doc_id", "tid", "start"] if keep == "first" else ["h", "c"])
    found = written(found, "repeat-bytes")
    many = written(firsts.groupBy("h").count().filter(F.col("count") > GROUP).select("h"), "repeat-hot")
    cold = _compare(found.join(many, "h", "left_anti"), length, keep)
    hot = _compare_hot(found.join(many, "h", "left_semi"), length, keep)
    return equal.union(cold).union(hot)


def _is_least():
    """Whether a row is the one that stays of its equals."""
    return (F.col("least.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("least.start") == F.col("start"))
            & (F.col("least.tid") == F.col("tid")))


def _place_rows(batches):
    for batch in batches:
        h, c, tid, start = (batch.column(i).to_numpy() for i in range(4))
        made = place_hash(h.view(np.uint64), c.view(np.uint64), tid, start)
        yield pa.RecordBatch.from_arrays([pa.array(made.view(np.int64))], names=["place"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup_documents(docs: DataFrame, length: int = 200, keep: str = "first", digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and the kept bytes
    (``kept`` binary), or with ``digest`` their sha256 (``kept_sha256``)."""
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    spans = written(repeated_spans(src, length, keep).groupBy("doc_id", "tid").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")), "repeat-spans")
    asked = spans.select(F.col("tid").alias("h"))
    bits = src.sparkSession.sparkContext.broadcast(bloom_filter(asked, "h"))
    final = "kept_sha256 string" if digest else "kept binary"

    def prepare(batches):
        """Texts that may lose bytes go on; others need no shuffle of theirs."""
        for batch in batches:
            tid = text_ids(batch.column(1))
            go = may_contain(bits.value, tid.view(np.uint64))
            raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
            done = [None if g else hashlib.sha256(t).hexdigest() if digest else t for g, t in zip(go, raw, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tid), pa.array([len(t) for t in raw], pa.int64()),
                 pa.array([t if g else None for g, t in zip(go, raw, strict=True)], pa.binary()),
                 pa.array(done, pa.string() if digest else pa.binary())], names=["doc_id", "tid", "n_bytes", "data", "done"])

    def finish(batches):
        for batch in batches:
            removed, n_spans, kept = [], [], []
            for data, done, cut in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                runs = merged([(x["start"], x["stop"]) for x in cut or ()])
                if data is None:
                    kept.append(done)
                else:
                    edges = [0, *(x for r in runs for x in r), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    kept.append(hashlib.sha256(data).hexdigest() if digest else data)
                removed.append(sum(b - a for a, b in runs))
                n_spans.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(kept, pa.string() if digest else pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", final.split()[0]])

    ready = src.mapInArrow(prepare, f"doc_id {id_type}, tid bigint, n_bytes bigint, data binary, done {final.split()[1]}").alias("r")
    both = ready.join(spans.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.tid") == F.col("s.tid")), "left")
    return (both.select("r.doc_id", "r.n_bytes", "r.data", "r.done", "s.spans")
            .mapInArrow(finish, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, {final}"))
