"""Collocations by bidirectional FM-indexes over word ids, one per shard.

1. Texts are cut into shards of about ``SHARD_BYTES``; a shard's words get
   ids of its own, one for each (language, word), and its texts become one
   sequence of ids with a break at every end of a piece.  Word counts are
   summed over shards; words that occur ``LEAST`` times or more get a number.
2. In every shard the other words become breaks as well (a phrase that holds
   one cannot be frequent), and the rest is indexed: the occurrences of each
   word with the symbol after it, and suffixes in order of their first words
   with the symbol before each (``BiIndex``).  Phrases are intervals of these
   orders: a word's interval is cut into those of its two-word phrases by the
   symbols after it, and theirs by the symbols before them.
3. Two-word phrases are summed over shards.  Only the frequent ones are then
   extended to the left, where the two words that come together so are
   frequent too, and three-word phrases are summed.  Shards learn of them by a
   Bloom filter with ``FILTER_BITS`` for each, of ``FILTER_BYTES`` at most: if
   they need more, each of several passes extends a part of them.  What a
   filter lets through by chance is counted and then dropped.
4. The left and right extensions of a phrase (the longer phrases that hold it)
   decide whether it is dropped.

Scores are computed in decimals without a fraction, which hold the products.
The first of each language are taken in two steps, so no task holds a
language's candidates.

Results for special inputs: null and empty texts have no words; a null
language is ``und``; a very long text is cut into several shards between
pieces (a piece is never cut); repeated rows count again; ties go by the
contract's order; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from routeweave.llm.bloom import SLICES, bloom_filter, may_contain
from routeweave.llm.tables import batch_rows, from_planes, planes, written
from routeweave.llm.textbytes import LOWER, byte_set, mix64, pieces, words

SHARD_BYTES = 3 << 20
SHARDS_A_BATCH = 2      # in one Arrow batch
FILTER_BITS = 16
FILTER_BYTES = 32 << 20
LEAST = 10              # occurrences of a candidate
WORDS = 3               # words of a candidate, at most
SHARE = 50              # percent of a phrase that a longer one must cover to drop it
MILLION = 1_000_000
SALTS = 64              # parts of a language in the first step of the ranking

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
IS_BREAK = ~byte_set(BREAKS)
IS_WORD = byte_set(BREAKS + b"\x20\x09")


class BiIndex:
    """Both directions of an index over a sequence of symbols from 0 (break)
    to ``top``, for patterns of at most ``depth`` symbols; the sequence begins
    and ends with a break.  Each direction is made when it is used first."""

    def __init__(self, s: np.ndarray, top: int, depth: int):
        self.s, self.base, self.depth = s, top + 1, depth

    @cached_property
    def after(self) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in order of their symbols: (symbol, the one after it)."""
        occurrence = np.argsort(self.s, kind="stable")
        return self.s[occurrence], np.append(self.s, 0)[occurrence + 1]

    @cached_property
    def before(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order: (the symbol before each: the BWT, the place of
        the suffix that begins with it)."""
        rank, k = self.s.astype(np.int64), 1
        while k < self.depth - 1:        # suffixes told apart by twice as many symbols
            if k > 1:
                rank = np.unique(rank, return_inverse=True)[1]
            rank = rank * (rank.max() + 1) + np.concatenate([rank[k:], np.zeros(k, np.int64)])
            k *= 2
        symbol = self.s[np.argsort(rank, kind="stable") - 1]
        del rank
        step = np.empty(len(symbol), np.int64)
        step[np.argsort(symbol, kind="stable")] = np.arange(len(symbol))
        return symbol, step

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every two-word phrase, words extended to the right: (its symbols,
        begins, ends of its intervals)."""
        symbol, after = self.after
        key, n = np.unique(symbol.astype(np.int64) * self.base + after, return_counts=True)
        end = np.cumsum(n)
        grams = np.stack([key // self.base, key % self.base], axis=1)
        real = (grams > 0).all(1)
        return grams[real], (end - n)[real], end[real]

    def to_left(self, grams: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The phrases of one word more before them: as ``pairs``."""
        symbol, step = self.before
        n = end - begin
        which = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(which)) + (begin - (np.cumsum(n) - n))[which]
        inside = symbol[at] > 0
        which, at = which[inside], at[inside]
        key, first, n = np.unique(which * self.base + symbol[at], return_index=True, return_counts=True)
        longer = np.concatenate([(key % self.base)[:, None], grams[key // self.base]], axis=1)
        begin = step[at[first]]
        return longer, begin, begin + n


def _cut(values: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A text in parts of about ``limit`` bytes that end after a break."""
    while len(values) > limit:
        at = np.flatnonzero(IS_BREAK[values[limit:2 * limit]])
        if not len(at):
            at = np.flatnonzero(IS_BREAK[values[limit:]])
            if not len(at):
                break
        yield values[:limit + at[0] + 1]
        values = values[limit + at[0] + 1:]
    yield values


def _shard(texts: list[np.ndarray], langs: list[str]) -> tuple:
    """(sequence, words, languages, counts) of a shard; the sequence holds
    places in the lists from 1, and 0 for breaks."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    low = LOWER[np.concatenate(texts)]
    starts, ends, first = words(low, offsets, IS_WORD)
    n = len(starts)
    # the bytes of the words, one after the other
    size = ends - starts
    spread = np.zeros(len(low) + 1, np.int8)
    spread[starts] += 1
    spread[ends] -= 1
    data = low[np.cumsum(spread[:-1], dtype=np.int8) > 0]
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
    names = sorted(set(langs))
    row = np.searchsorted(first, np.arange(n), side="right") - 1
    lang = np.array([names.index(x) for x in langs], dtype=np.int64)[row]
    kinds, ident, counts = np.unique(coded.indices.to_numpy().astype(np.int64) * len(names) + lang, return_inverse=True, return_counts=True)
    stops = np.concatenate([[0], np.cumsum(IS_BREAK[low])])
    apart = np.ones(n, dtype=bool)
    if n:
        apart[1:] = (stops[starts[1:]] != stops[ends[:-1]]) | (row[1:] != row[:-1])
    seq = np.zeros(n + int(apart.sum()) + 1, np.int32)
    seq[np.arange(n) + np.cumsum(apart)] = ident + 1
    return (seq, coded.dictionary.take(pa.array(kinds // len(names))).cast(pa.string()),
            pa.array(names, pa.string()).take(pa.array(kinds % len(names))), pa.array(counts.astype(np.int64)))


def make_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """shard, seq, words, langs, counts; see ``_shard``."""
    def run(batches):
        number, texts, langs, size = TaskContext.get().partitionId() << 32, [], [], 0

        def row():
            seq, *lists = _shard(texts, langs)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([planes(seq)], pa.binary()), *lists],
                                              names=["shard", "seq", "words", "langs", "counts"])

        for batch in batches:
            lang = batch.column(1).to_pylist()
            for begin, end, values, offsets in pieces(batch.column(0), shard_bytes):
                for i in range(end - begin):
                    for part in _cut(values[offsets[i]:offsets[i + 1]], shard_bytes):
                        if len(part):
                            texts.append(part.copy())
                            langs.append(lang[begin + i])
                            size += len(part)
                        if size >= shard_bytes:
                            yield row()
                            number, size = number + 1, 0
                            texts.clear()
                            langs.clear()
        if texts:
            yield row()

    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, "shard bigint, seq binary, words array<string>, langs array<string>, counts array<bigint>")


def _numbered_shard(key, shard: pa.Table, numbers: pa.Table) -> pa.Table:
    """One shard's sequence of frequent words, from 1 in order of their places
    in its list, and their numbers."""
    place, number = (numbers[c].to_numpy() for c in ("place", "number"))
    order = np.argsort(place)
    place = place[order]
    seq = from_planes(shard["seq"][0].as_buffer(), "i4")
    code = np.zeros(max(int(seq.max()), int(place.max(initial=-1)) + 1) + 1, np.int32)
    code[place + 1] = np.arange(1, len(place) + 1)
    seq = code[seq]
    seq = seq[(seq > 0) | np.append(True, seq[:-1] > 0)]        # one break in a row
    if seq[-1]:
        seq = np.append(seq, np.int32(0))
    return pa.table([pa.array([planes(seq)], pa.binary()), pa.array([planes(number[order])], pa.binary())], names=["seq", "numbers"])


def _indexes(batches) -> Iterator[tuple[BiIndex, np.ndarray]]:
    for batch in batches:
        for seq, numbers in zip(batch.column(0), batch.column(1), strict=True):
            number = np.append(0, from_planes(numbers.as_buffer(), "i8"))
            yield BiIndex(from_planes(seq.as_buffer(), "i4"), len(number) - 1, WORDS), number


def _count_pairs(batches) -> Iterator[pa.RecordBatch]:
    """Two-word phrases of each shard: (g1, g2, n)."""
    for index, number in _indexes(batches):
        grams, begin, end = index.pairs()
        yield pa.RecordBatch.from_arrays([pa.array(number[grams[:, 0]]), pa.array(number[grams[:, 1]]), pa.array(end - begin)], names=["g1", "g2", "n"])


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(mix64(a.view(np.uint64)) + b.view(np.uint64))


def _pass_of(h: np.ndarray, passes: int) -> np.ndarray:
    return mix64(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(passes)


def _count_triples(batches, bits: np.ndarray, k: int, passes: int) -> Iterator[pa.RecordBatch]:
    """Three-word phrases (g1, g2, g3, n) of each shard whose last two words
    are a frequent phrase of pass ``k``, and whose first two may be one."""
    def wanted(h, others):
        mine = _pass_of(h, passes) == k
        return np.where(mine, may_contain(bits, h), others)

    for index, number in _indexes(batches):
        grams, begin, end = index.pairs()
        keep = wanted(_pair_hash(number[grams[:, 0]], number[grams[:, 1]]), False)
        grams, begin, end = index.to_left(grams[keep], begin[keep], end[keep])
        keep = wanted(_pair_hash(number[grams[:, 0]], number[grams[:, 1]]), True)
        grams, n = number[grams[keep]], (end - begin)[keep]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(grams[:, i])) for i in range(WORDS)] + [pa.array(n)],
                                         names=["g1", "g2", "g3", "n"])


def _summed(counts: DataFrame, gram: list[str], least: int, name: str) -> DataFrame:
    """Phrases of all shards with ``least`` occurrences or more, written; a
    worker reads few shards at once."""
    with batch_rows(counts.sparkSession, SHARDS_A_BATCH):
        return written(counts.groupBy(*gram).agg(F.sum("n").alias("a")).filter(F.col("a") >= least), name)


def _triples(indexed: DataFrame, two: DataFrame, least: int) -> DataFrame:
    """(g1, g2, g3, a) of the frequent three-word phrases."""
    spark, size = indexed.sparkSession, two.count()
    passes = max(1, -(-size * FILTER_BITS // (8 * FILTER_BYTES)))
    n_bytes = max(8 * SLICES, 1 << (size * FILTER_BITS // (8 * passes)).bit_length())

    def hashes(k):
        def run(batches):
            for batch in batches:
                h = _pair_hash(*(batch.column(i).to_numpy() for i in (0, 1)))
                yield pa.RecordBatch.from_arrays([pa.array(h[_pass_of(h, passes) == k].view(np.int64))], names=["h"])
        return run

    found = None
    for k in range(passes):
        bits = spark.sparkContext.broadcast(bloom_filter(two.select("g1", "g2").mapInArrow(hashes(k), "h bigint"), "h", min(n_bytes, FILTER_BYTES)))
        part = indexed.mapInArrow(lambda batches, bits=bits, k=k: _count_triples(batches, bits.value, k, passes),
                                  "g1 bigint, g2 bigint, g3 bigint, n bigint")
        part = _summed(part, ["g1", "g2", "g3"], least, "collocation-triples")
        found = part if found is None else found.union(part)
    return found


def frequent_phrases(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, ...]:
    """(words, two-word phrases, three-word phrases, languages): number, lang,
    word, f; g1, g2, a; g1, g2, g3, a; lang, n.  Words and phrases of ``least``
    occurrences or more, counted exactly; all written."""
    shards = written(make_shards(docs, shard_bytes), "collocation-shards")
    each = shards.select("shard", F.posexplode(F.arrays_zip("words", "langs", "counts"))).select(
        "shard", F.col("pos").alias("place"), F.col("col.words").alias("word"), F.col("col.langs").alias("lang"), F.col("col.counts").alias("n"))
    total = each.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    known = written(total.filter(F.col("f") >= least).select((F.monotonically_increasing_id() + 1).alias("number"), "lang", "word", "f"),
                    "collocation-words")
    langs = written(each.groupBy("lang").agg(F.sum("n").alias("n")), "collocation-langs")
    numbers = (each.select("shard", "place", "lang", "word").join(known.select("lang", "word", "number"), ["lang", "word"])
               .select(F.col("shard").alias("of"), "place", "number"))
    indexed = written(shards.select("shard", "seq").groupBy("shard").cogroup(numbers.groupBy("of"))
                      .applyInArrow(_numbered_shard, "seq binary, numbers binary"), "collocation-indexed")
    pairs = indexed.mapInArrow(_count_pairs, "g1 bigint, g2 bigint, n bigint")
    two = _summed(pairs, ["g1", "g2"], least, "collocation-pairs")
    return known, two, _triples(indexed, two, least), langs


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    whole = lambda c: c.cast("decimal(19,0)")
    num, den = whole(a) * whole(a) * F.lit(MILLION).cast("decimal(7,0)"), whole(left) * whole(right)
    return F.call_function("div", num, den)


def collocations(docs: DataFrame, least: int = LEAST, first: int = 2000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, left_extension and
    right_extension (the largest count of a candidate with one word more) of
    the first phrases of each language."""
    words_, two, three, langs = frequent_phrases(docs.select("text", "lang"), least, shard_bytes)
    word = lambda g, f: words_.select(F.col("number").alias(g), F.col("f").alias(f))
    pair = lambda x, y, f: two.select(F.col("g1").alias(x), F.col("g2").alias(y), F.col("a").alias(f))

    # extensions of two-word phrases: the longer phrases that hold them
    longer = three.select(F.col("g1").alias("x"), F.col("g2").alias("y"), F.lit(None).cast("long").alias("before"), F.col("a").alias("behind")).union(
        three.select("g2", "g3", "a", F.lit(None).cast("long")))
    longer = longer.groupBy("x", "y").agg(F.max("before").alias("left_extension"), F.max("behind").alias("right_extension"))
    held = F.coalesce(F.greatest("left_extension", "right_extension"), F.lit(0))
    kept = (two.join(longer, (F.col("g1") == F.col("x")) & (F.col("g2") == F.col("y")), "left")
            .filter(100 * held < SHARE * F.col("a"))
            .join(word("g1", "l"), "g1").join(word("g2", "r"), "g2")
            .select("g1", "g2", F.lit(0).cast("long").alias("g3"), "a", "l", "r", cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score"),
                    "left_extension", "right_extension"))
    cuts = (three.join(word("g1", "l1"), "g1").join(pair("g2", "g3", "r1"), ["g2", "g3"])
            .join(pair("g1", "g2", "l2"), ["g1", "g2"]).join(word("g3", "r2"), "g3"))
    cuts = cuts.withColumn("s1", cut_score(F.col("a"), F.col("l1"), F.col("r1"))).withColumn("s2", cut_score(F.col("a"), F.col("l2"), F.col("r2")))
    early = F.col("s1") <= F.col("s2")
    none = F.lit(None).cast("long")
    kept = kept.union(cuts.select("g1", "g2", "g3", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")),
                                  F.when(early, F.col("r1")).otherwise(F.col("r2")), F.least("s1", "s2"), none, none))

    text = lambda g, w: words_.select(F.col("number").alias(g), F.col("word").alias(w))
    named = (kept.join(words_.select(F.col("number").alias("g1"), "lang", F.col("word").alias("w1")), "g1")
             .join(text("g2", "w2"), "g2").join(text("g3", "w3"), "g3", "left")
             .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score", "left_extension", "right_extension"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = (named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= first))
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= first)
    return best.join(langs, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_extension", "right_extension")


#: The query in plain SQL.
ORACLE_SQL = """
WITH piece AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM (
    SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents WHERE text IS NOT NULL)),
f1 AS (SELECT lang, x, COUNT(*) AS f FROM (SELECT lang, unnest(w) AS x FROM piece) GROUP BY lang, x),
total AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
f2 AS (
  SELECT lang, z[1] AS x, z[2] AS y, COUNT(*) AS f FROM (
    SELECT lang, unnest(list_zip(w[1:len(w) - 1], w[2:len(w)])) AS z FROM piece WHERE len(w) >= 2) GROUP BY ALL HAVING COUNT(*) >= 10),
f3 AS (
  SELECT lang, z[1] AS x, z[2] AS y, z[3] AS v, COUNT(*) AS f FROM (
    SELECT lang, unnest(list_zip(w[1:len(w) - 2], w[2:len(w) - 1], w[3:len(w)])) AS z FROM piece WHERE len(w) >= 3)
  GROUP BY ALL HAVING COUNT(*) >= 10),
ahead AS (SELECT lang, x, y, MAX(f) AS e FROM f3 GROUP BY ALL),
behind AS (SELECT lang, y AS x, v AS y, MAX(f) AS e FROM f3 GROUP BY ALL),
cut AS (
  SELECT p.lang, p.x || ' ' || p.y AS phrase, 1 AS k, p.f AS a, l.f AS l, r.f AS r, b.e AS left_extension, h.e AS right_extension
  FROM f2 p JOIN f1 l ON l.lang = p.lang AND l.x = p.x JOIN f1 r ON r.lang = p.lang AND r.x = p.y
    LEFT JOIN behind b ON b.lang = p.lang AND b.x = p.x AND b.y = p.y LEFT JOIN ahead h ON h.lang = p.lang AND h.x = p.x AND h.y = p.y
  WHERE 100 * COALESCE(GREATEST(b.e, h.e), b.e, h.e, 0) < 50 * p.f
  UNION ALL
  SELECT p.lang, p.x || ' ' || p.y || ' ' || p.v, 1, p.f, l.f, r.f, NULL, NULL
  FROM f3 p JOIN f1 l ON l.lang = p.lang AND l.x = p.x JOIN f2 r ON r.lang = p.lang AND r.x = p.y AND r.y = p.v
  UNION ALL
  SELECT p.lang, p.x || ' ' || p.y || ' ' || p.v, 2, p.f, l.f, r.f, NULL, NULL
  FROM f3 p JOIN f2 l ON l.lang = p.lang AND l.x = p.x AND l.y = p.y JOIN f1 r ON r.lang = p.lang AND r.x = p.v),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cut),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM scored) WHERE i = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM one)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score, r.left_extension, r.right_extension
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
