"""N-gram Jaccard join and its components by parity sketches.

A document is its set of k-word shingles; sets are equal for copies, so equal
sets are one node (``sid``) from the start.  Two sets with Jaccard >= p % have
a symmetric difference of at most (a + b)(100 - p) / (100 + p) elements.

* Size bands: sizes that can be linked lie in one band or in two neighbouring
  ones; scheme s serves bands s and s + 1, with D the largest difference there.
* Parity sketch: elements are dealt by hash into D + g parts; each part
  XORs its elements' one-bit masks (and their hashes).  An element in both
  sets cancels, so the Hamming distance of two sketches never exceeds the
  symmetric difference, and at least g parts of a linked pair are equal
  (pigeonhole).  Equal empty parts tell nothing: a set leaves its empty parts
  out if it has fewer than g of them, and then another part is equal.
* Join: equal (scheme, part, sketch) meet.  Inside such a bucket, all are
  paired with its least set first (no pair product); pairs are cut by the
  Hamming bound on folded whole sketches, then verified on the exact sets.
* Components of verified links; buckets that still hold several components
  are searched again in blocks of bounded size, first for spanning forests of
  the pairs that pass the Hamming bound, then, if some of these are no links,
  for all of them, so that no link between components is missed.

Results for special inputs: a document without words (or null text) has an
empty set, links with nothing and is its own component; repeated rows are
copies; documents that share a doc_id are told apart by their sets; a set
that only rows with a null doc_id have links with nothing (component_id null);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from routeweave.llm.bloom import bloom_filter, may_contain
from routeweave.llm.graph import components
from routeweave.llm.tables import written
from routeweave.llm.textbytes import mix64, pieces, shingles, word_hashes

PART_BITS = 64
BLOCK = 512                 # members of a bucket that are compared at once
PIECE = 1 << 18             # bytes of text that a worker holds as words at once, unless one text is longer
MET = 1 << 18               # sets that a task remembers, so that copies near each other give keys once

_U = np.uint64


class Bands:
    """Size bands and schemes for one threshold (in percent)."""

    def __init__(self, percent: int):
        self.p = percent
        self.top = [1]
        #: bits of a folded sketch per allowed difference: 16 at 90 %, 4 at 80 %.  The more differences
        #: are allowed, the longer sketches are, and the fewer bits for each tell other pairs apart.
        self.fold = max(2, 1600 // (100 - percent) ** 2) if percent < 100 else 16

    def band(self, n: int) -> int:
        while self.top[-1] < n:
            self.top.append(max(self.top[-1] + 1, self.top[-1] * 100 // self.p))
        return int(np.searchsorted(self.top, n))

    def difference(self, total) -> int:
        """Largest symmetric difference of a linked pair with a + b = total."""
        return total * (100 - self.p) // (100 + self.p)

    def parts(self, scheme: int) -> tuple[int, int]:
        """(parts, g) of a scheme."""
        self.band(self.top[scheme] + 1)
        while len(self.top) < scheme + 2:
            self.top.append(max(self.top[-1] + 1, self.top[-1] * 100 // self.p))
        d = self.difference(self.top[scheme] + self.top[scheme + 1])
        if d == 0:
            return 1, 1
        g = 1
        for _ in range(20):
            empty = (d + g) * np.exp(-self.top[scheme] / (d + g))
            want = 1 + int(empty + 4 * np.sqrt(empty))
            if want <= g:
                break
            g = want
        return d + g, g


def document_sets(values: np.ndarray, offsets: np.ndarray, k: int):
    """Per row: its sorted distinct shingle hashes."""
    h, first = word_hashes(values, offsets)
    s, begin = shingles(h, first, k)
    return [np.unique(s[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set: the sum and the parity of its elements,
    the first mixed with the second."""
    m = mix64(s)
    both = np.array([m.sum(dtype=np.uint64) + _U(len(s)), np.bitwise_xor.reduce(m)], dtype=np.uint64)
    name = (mix64(both) * np.array([1, 0x9E3779B97F4A7C15], np.uint64)).sum(dtype=np.uint64)
    return int(name.view(np.int64)), int(both[1].view(np.int64))


class Names:
    """Names of sets: the first 64 bits of their identity, but for the few
    sets (about n^2 / 2^65 of n) whose first bits are another set's too; these
    have names of their own."""

    def __init__(self, renamed: dict[tuple[int, int], int] | None = None):
        self.renamed, self.identity = renamed or {}, identity

    def __call__(self, s: np.ndarray) -> int:
        both = self.identity(s)
        return self.renamed.get(both, both[0]) if self.renamed else both[0]

    def told_apart(self, clashes: list[tuple[int, int]]) -> Names:
        """New names for identities whose names clash."""
        fresh = mix64(mix64(np.array(clashes, np.int64).view(np.uint64)[:, 0]) ^ np.array(clashes, np.int64).view(np.uint64)[:, 1])
        return Names(self.renamed | dict(zip(clashes, fresh.view(np.int64).tolist(), strict=True)))


def folded_sketch(s: np.ndarray, bands: Bands) -> bytes:
    """Parity of the set over a power of two of bits, at least ``bands.fold``
    for each allowed difference."""
    bits = max(64, 1 << int(bands.fold * (bands.difference(2 * len(s)) + 1) - 1).bit_length())
    odd = np.bincount((s >> _U(7) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two folded sketches, the wider one folded on."""
    if len(a) > len(b):
        a, b = b, a
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def part_keys(s: np.ndarray, scheme: int, parts: int, g: int) -> np.ndarray:
    """Join keys of a set in one scheme: one for each part it shows."""
    part = ((s >> _U(24)) % _U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    sizes = np.bincount(part, minlength=parts)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    s = s[order]
    mask = _U(1) << (s & _U(PART_BITS - 1))
    both = np.zeros((2, parts), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    for row, x in enumerate((mask, mix64(s))):
        both[row, full] = np.bitwise_xor.reduceat(x, begin[full])
    shown = np.arange(parts) if parts - len(full) >= g else full
    return mix64(mix64(both[0, shown]) + both[1, shown] + mix64(shown.astype(np.uint64) + (_U(scheme) << _U(32))))


def _members(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, identity (sid, sid2) and folded sketch of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            n, ids, sketch = [], [], []
            for _, _, values, offsets in pieces(batch.column(1), PIECE):
                for s in document_sets(values, offsets, k):
                    n.append(len(s))
                    ids.append(identity(s) if len(s) else (None, None))
                    sketch.append(folded_sketch(s, bands) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *(pa.array([x[i] for x in ids], pa.int64()) for i in (0, 1)), pa.array(sketch, pa.binary())],
                names=["doc_id", "n_shingles", "sid", "sid2", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_shingles bigint, sid bigint, sid2 bigint, sketch binary")


def _named(members: DataFrame) -> tuple[DataFrame, Names]:
    """A written ``members`` table with one name for each set in ``sid``."""
    names = Names()
    while True:
        apart = members.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("sid2").alias("lo"), F.max("sid2").alias("hi")).filter("lo != hi")
        clash = members.select(F.col("sid").alias("name"), "sid2").join(apart.select(F.col("sid").alias("name")), "name", "left_semi").distinct().collect()
        if not clash:
            return members, names
        # every set of such a name but the first gets another
        first = {n: min(x.sid2 for x in clash if x.name == n) for n in {x.name for x in clash}}
        moved = {(x.name, x.sid2) for x in clash if x.sid2 != first[x.name]}
        names = names.told_apart(sorted(moved))
        table = members.sparkSession.createDataFrame([(a, b, names.renamed[a, b]) for a, b in sorted(moved)], "sid long, sid2 long, fresh long")
        members = written(members.join(table, ["sid", "sid2"], "left")
                          .select("doc_id", "n_shingles", F.coalesce("fresh", "sid").alias("sid"), "sid2", "sketch"), "jaccard-members")


def _keys(docs: DataFrame, k: int, percent: int, names: Names) -> DataFrame:
    """(key, sid) of every set; copies near each other give them once."""

    def run(batches):
        bands, met = Bands(percent), set()
        for batch in batches:
            for _, _, values, offsets in pieces(batch.column(0), PIECE):
                keys, sids = [], []
                for s in document_sets(values, offsets, k):
                    if not len(s) or (sid := names(s)) in met:
                        continue
                    if len(met) >= MET:
                        met.clear()
                    met.add(sid)
                    band = bands.band(len(s))
                    for scheme in (band - 1, band) if band else (0,):
                        keys.append(part_keys(s, scheme, *bands.parts(scheme)))
                        sids.append(np.full(len(keys[-1]), sid))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sids))],
                                                     names=["key", "sid"])

    return docs.select("text").mapInArrow(run, "key bigint, sid bigint")


def _buckets(keys: DataFrame) -> DataFrame:
    """(key, sid, center) of the buckets with two sets or more; center is
    the least set of the bucket."""
    w = W.partitionBy("key").orderBy("sid")
    once = keys.withColumn("before", F.lag("sid").over(w)).filter("before IS NULL OR before != sid")
    met = once.select("key", "sid", F.first("sid").over(w).alias("center"), F.lead("sid").over(w).alias("after"))
    return met.filter("center != sid OR after IS NOT NULL").drop("after")


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and folded sketches allow to be linked,
    with a document of each (rep_a, rep_b)."""
    def side(x):
        return nodes.select(F.col("sid").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"),
                            F.col("rep").alias(f"rep_{x}"))

    id_type = nodes.schema["rep"].dataType.simpleString()

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            na, nb = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 4))
            fits = np.flatnonzero(100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            sa, sb = batch.column(3), batch.column(5)
            good = [i for i in fits.tolist() if hamming(sa[i].as_py(), sb[i].as_py()) <= bands.difference(int(na[i] + nb[i]))]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good, pa.int64())) for c in (0, 1, 6, 7)],
                                             names=["a", "b", "rep_a", "rep_b"])

    both = side("b").join(side("a").join(pairs, "a"), "b")
    return (both.select("a", "b", "n_a", "s_a", "n_b", "s_b", "rep_a", "rep_b")
            .mapInArrow(run, f"a bigint, b bigint, rep_a {id_type}, rep_b {id_type}"))


def _linked(pairs: DataFrame, docs: DataFrame, k: int, percent: int, names: Names) -> DataFrame:
    """The pairs whose exact sets are linked; ``pairs`` is a written table.

    Only the texts of a pair's documents are read as sets; each set goes to
    its pairs, and the two sets of a pair meet by one shuffle."""
    side = lambda sid, rep, i: pairs.select(F.col(sid).alias("sid"), F.col(rep).alias("doc_id"), "a", "b", F.lit(i).alias("side"))
    need = written(side("a", "rep_a", 0).union(side("b", "rep_b", 1)), "jaccard-needed")
    reps = written(need.select("doc_id").distinct(), "jaccard-needed-documents")

    def sets(batches):
        for batch in batches:
            sid, data = [], []
            for _, _, values, offsets in pieces(batch.column(0), PIECE):
                for s in document_sets(values, offsets, k):
                    if len(s):
                        sid.append(names(s))
                        data.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(data, pa.binary())], names=["sid", "elements"])

    found = (docs.select("doc_id", "text").join(reps, "doc_id", "left_semi").select("text")
             .mapInArrow(sets, "sid bigint, elements binary"))
    met = found.join(need.select("sid", "a", "b", "side"), "sid").select("a", "b", "side", "elements")

    def check(batches):
        held = None, None, None         # a pair, and its set of side 0
        for batch in batches:
            a, b, side = (batch.column(i).to_pylist() for i in range(3))
            good = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                if side[i] == 0:
                    held = a[i], b[i], x.copy()
                elif held[:2] == (a[i], b[i]):
                    both = len(np.intersect1d(held[2], x, assume_unique=True))
                    if 100 * both >= percent * (len(held[2]) + len(x) - both):
                        good.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good, pa.int64())) for c in (0, 1)], names=["a", "b"])

    return met.repartition("a", "b").sortWithinPartitions("a", "b", "side").mapInArrow(check, "a bigint, b bigint")


def _open_pairs(buckets: DataFrame, nodes: DataFrame, comps: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs across components in one bucket that the sketches allow: all of
    them, or per block a spanning forest of their graph.

    A bucket of more than BLOCK members is dealt into blocks; a pair of
    blocks is one group, so a task never holds more than two blocks."""
    rows = (buckets.join(comps.withColumnRenamed("node", "sid"), "sid", "left")
            .select("key", "sid", F.coalesce("root", "sid").alias("root")))
    mixed = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).filter("lo != hi")
    mixed = written(mixed.select("key", "n"), "jaccard-mixed")
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    dealt = (rows.join(mixed.select("key", blocks.alias("blocks")), "key")
             .join(nodes.select("sid", "n_shingles", "sketch", "rep"), "sid")
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                     "own", "sid", "root", "n_shingles", "sketch", "rep"))
    id_type = nodes.schema["rep"].dataType.simpleString()
    dealt = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def run(batches):
        bands, rest = Bands(percent), None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            edge = _edges(rest)
            if len(edge) > 2:       # the last group may go on
                yield from _compare(rest.slice(0, edge[-2]), edge[:-1], bands, forest)
                rest = rest.slice(edge[-2]).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from _compare(rest, _edges(rest), bands, forest)

    return dealt.mapInArrow(run, f"a bigint, b bigint, rep_a {id_type}, rep_b {id_type}").distinct()


def _edges(table: pa.Table) -> np.ndarray:
    x = np.stack([table[c].to_numpy() for c in ("key", "lo", "hi")])
    return np.concatenate([[0], np.flatnonzero((x[:, 1:] != x[:, :-1]).any(0)) + 1, [x.shape[1]]]) if x.shape[1] else np.zeros(1, int)


def _compare(table: pa.Table, edge: np.ndarray, bands: Bands, forest: bool):
    sid, root, n, own, lo, hi = (table[c].to_numpy() for c in ("sid", "root", "n_shingles", "own", "lo", "hi"))
    sketch = table["sketch"].to_pylist()
    left, right = [], []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        top = {}

        def find(x, top=top):
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        # sketches folded to the least width of the group
        width = min(map(len, sketch[a:b]))
        flat = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, width // 8), axis=0) for x in sketch[a:b]])
        size = n[a:b].astype(np.int64)
        for i in range(b - a - 1):
            j = np.arange(i + 1, b - a)
            ok = (root[a + j] != root[a + i]) & (100 * np.minimum(size[i], size[j]) >= bands.p * np.maximum(size[i], size[j]))
            if lo[a] != hi[a]:
                ok &= own[a + j] != own[a + i]
            j = j[ok]
            far = np.bitwise_count(flat[j] ^ flat[i]).sum(1)
            for x in j[far <= (size[i] + size[j]) * (100 - bands.p) // (100 + bands.p)].tolist():
                if hamming(sketch[a + i], sketch[a + x]) > bands.difference(int(size[i] + size[x])):
                    continue
                if forest:
                    u, v = find(int(root[a + i])), find(int(root[a + x]))
                    if u == v:
                        continue
                    top[u] = v
                u, v = (a + i, a + x) if sid[a + i] < sid[a + x] else (a + x, a + i)
                left.append(u)
                right.append(v)
    left, right, rep = pa.array(left, pa.int64()), pa.array(right, pa.int64()), table["rep"].combine_chunks()
    yield pa.RecordBatch.from_arrays([pa.array(sid).take(left), pa.array(sid).take(right), rep.take(left), rep.take(right)],
                                     names=["a", "b", "rep_a", "rep_b"])


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least
    doc_id that links reach) and sid, the identity of its set."""
    docs = docs.select("doc_id", "text")
    return _components(docs, k, percent)[0]


def _components(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, Names]:
    members, names = _named(written(_members(docs, k, percent), "jaccard-members"))
    nodes = written(members.filter("sid IS NOT NULL AND doc_id IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch")), "jaccard-nodes")
    buckets = written(_buckets(_keys(docs, k, percent, names)), "jaccard-buckets")

    star = buckets.filter("center != sid").select(F.col("center").alias("a"), F.col("sid").alias("b")).distinct()
    star = written(star, "jaccard-pairs")
    nearest = _close(star, nodes, percent).groupBy("b").agg(F.min(F.struct("a", "rep_a")).alias("x"), F.first("rep_b").alias("rep_b"))
    pairs = written(nearest.select("x.a", "b", "x.rep_a", "rep_b"), "jaccard-pairs")
    tested = pairs.select("a", "b")
    links = written(_linked(pairs, docs, k, percent, names), "jaccard-links")
    comps = written(components(links), "jaccard-components")
    for forest in (True, False):
        near = _open_pairs(buckets, nodes, comps, percent, forest)
        near = written(near.join(tested.withColumn("known", F.lit(True)), ["a", "b"], "left"), "jaccard-pairs")
        if near.isEmpty():
            break
        fresh = near.filter("known IS NULL").drop("known")
        made = written(_linked(fresh, docs, k, percent, names), "jaccard-links")
        tested, links = tested.union(fresh.select("a", "b")), links.union(made)
        comps = written(components(links), "jaccard-components")
        # where every pair of a forest is a link, no pair of its graph is left open
        if made.distinct().count() == near.count():
            break

    # sets in components take the least document of theirs
    named = nodes.select("sid", "rep").join(comps.withColumnRenamed("node", "sid"), "sid")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    joined = written(named.join(least, "root").select("sid", "least"), "jaccard-named")
    of = nodes.select("sid", "rep").join(joined, "sid", "left").select("sid", F.coalesce("least", "rep").alias("component_id"))
    return members.join(of, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "sid"), names


def drop_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: its
    least doc_id (of several such rows, the first by text).  Rows without
    words stay.

    Only rows whose set is in a component of several rows are shuffled; the
    others are told by a Bloom filter of fixed size and stay in place."""
    found, names = _components(docs.select("doc_id", "text"), k, percent)
    found = written(found, "jaccard-groups").filter("sid IS NOT NULL")
    several = found.groupBy("sid").agg(F.count("*").alias("n"), F.max(~F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("goes"))
    bits = docs.sparkSession.sparkContext.broadcast(bloom_filter(several.filter("n > 1 OR goes"), "sid"))
    stays = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("id_of__"), F.col("sid").alias("sid_of__")).distinct()
    at = docs.columns.index("text")
    marked = StructType([*docs.schema.fields, StructField("sid__", LongType())])

    def mark(batches):
        for batch in batches:
            sid = [None] * batch.num_rows
            for begin, _, values, offsets in pieces(batch.column(at), PIECE):
                for i, s in enumerate(document_sets(values, offsets, k)):
                    if len(s) and may_contain(bits.value, np.array([made := names(s)]).view(np.uint64))[0]:
                        sid[begin + i] = made
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sid, pa.int64())], names=[*batch.schema.names, "sid__"])

    rows = docs.mapInArrow(mark, marked)
    first = W.partitionBy("doc_id", "sid__").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    looked = (rows.filter("sid__ IS NOT NULL")
              .join(stays, F.col("doc_id").eqNullSafe(F.col("id_of__")) & (F.col("sid__") == F.col("sid_of__")), "left_semi")
              .withColumn("rank__", F.row_number().over(first)).filter("rank__ = 1"))
    return rows.filter("sid__ IS NULL").select(*docs.columns).union(looked.select(*docs.columns))
