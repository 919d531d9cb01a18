"""Spelling variants by a dictionary of trie-node pairs.

Words are the maximal runs of Latin letters of at least ``LETTERS`` code
points that occur at least twice (with the one-letter deletions that
``variants`` plants by crc32).  Sorted, they are the leaves of a trie; sorted
by their reversals, of a second one.  Every prefix of a word is a node of the
first trie and every suffix a node of the second, and both get numbers.

* A word skips each of its positions: (node of what stands before, node of
  what stands after).  Words of one such pair differ in that position alone.
* A word is split between any two positions: (prefix node, suffix node), a
  pair that is its own only.  Where it equals a skipping pair, the other word
  has one more code point.  Of equal letters in a row only the last is
  skipped for that, so no neighbour is met twice.

Numbers are exact, so a meeting is a neighbour and needs no check.  A pair
holds one word for each letter of the alphabet at most (90), and one that is
split there; neighbours are counted and the most frequent one found within it
without making the pairs.

Numbering: words are sorted by ranges; a task numbers the nodes that its words
add to the word before.  Only the nodes on the path to a range's first word
can belong to an earlier range; the two edge words of every range give these,
a table as long as there are ranges.

Results for special inputs: null and empty texts have no words; a null doc_id
counts as empty text; a very long run is one word like any other (nodes and
pairs are linear in its length); repeated rows count again; ties go to the
smaller word; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.llm.tables import written

LETTERS = 7             # code points of a word, at least
OCCURRENCES = 2
DROP = 31               # every so many runs (by crc32) lose a code point
RATIO = 10              # a form is so many times as frequent
PART = 40               # a number is the range's, shifted so far, and its own

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest runs only: a shorter run has no place to begin a match.
RUN = rf"[A-Za-zÀ-ÿ]{{{LETTERS},}}+"


def variants(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of all texts."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % DROP == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
    words = runs.select(F.coalesce(word, "run").alias("word")).filter(F.length("word") >= LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= OCCURRENCES)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            n = mid
    return lo


def number_nodes(rows: DataFrame, word: str, path: str) -> DataFrame:
    """``rows`` with the trie nodes on the path of each ``word``: ``path`` (one
    number for each code point), ``<path>_part`` (its range), ``<path>_row``
    (its place in the range) and ``<path>_edge`` (first or last of it).
    ``word`` is unique; numbers count from 1 in each range, in order of the
    words, so the first word's are its lengths; see ``inherited``."""
    columns = rows.columns
    at = columns.index(word)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    names = [*columns, path, f"{path}_part", f"{path}_row", f"{path}_edge"]

    def walk(batches):
        part, before, nodes, count, place, held = TaskContext.get().partitionId(), "", np.zeros(0, np.int64), 0, 0, None
        for batch in batches:
            paths = []
            for w in batch.column(at).to_pylist():
                keep = _shared(before, w)
                new = len(w) - keep
                nodes = np.concatenate([nodes[:keep], np.arange(count + 1, count + new + 1)])
                count, before = count + new, w
                paths.append(nodes)
            if not paths:
                continue
            n = len(paths)
            edge = np.zeros(n, dtype=bool)
            edge[0] = place == 0
            begin = np.concatenate([[0], np.cumsum([len(x) for x in paths])]).astype(np.int32)
            made = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(begin), pa.array(np.concatenate(paths))),
                 pa.array(np.full(n, part, np.int64)), pa.array(np.arange(place, place + n)), pa.array(edge)], names=names)
            place += n
            # the last row waits: it may be the last of the range
            if held is not None:
                yield held
            if n > 1:
                yield made.slice(0, n - 1)
            held = made.slice(n - 1)
        if held is not None:
            yield held.set_column(len(names) - 1, names[-1], pa.array([True]))

    return (rows.repartitionByRange(word).sortWithinPartitions(word)
            .mapInArrow(walk, f"{fields}, {path} array<bigint>, {path}_part bigint, {path}_row bigint, {path}_edge boolean"))


def inherited(numbered: DataFrame, word: str, path: str) -> dict[int, np.ndarray]:
    """Per range, the true numbers of the nodes on its first word's path that
    an earlier range has numbered.  Only the ranges' edge words are read."""
    edges = numbered.filter(f"{path}_edge").select(f"{path}_part", f"{path}_row", word, path).collect()
    found, last, nodes = {}, "", np.zeros(0, np.int64)
    for part, row, w, own in sorted(edges, key=lambda r: r[:2]):
        if row == 0:
            found[part] = nodes[:_shared(last, w)]
        last, nodes = w, true_numbers(np.array(own, np.int64), np.full(len(own), part), found)
    return {k: v for k, v in found.items() if len(v)}


def true_numbers(own: np.ndarray, part: np.ndarray, known: dict[int, np.ndarray]) -> np.ndarray:
    """Numbers over all ranges from those within a range."""
    out = (part << PART) + own
    for p in np.unique(part[own <= max(map(len, known.values()), default=0)]).tolist():
        if p in known:
            at = np.flatnonzero((part == p) & (own <= len(known[p])))
            out[at] = known[p][own[at] - 1]
    return out


def _node_pairs(batches, forward: dict, backward: dict) -> Iterator[pa.RecordBatch]:
    """(prefix, suffix, id, n, kind) of every word: kind 0 and 1 skip a
    position (1: the last of equal letters in a row), kind 2 splits."""
    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            some = batch.slice(k, 4096)
            word, ident, n = some.column(0).to_pylist(), some.column(1).to_numpy(), some.column(2).to_numpy()
            size = np.array([len(w) for w in word])
            row = np.repeat(np.arange(len(word)), size)
            part = lambda i: some.column(i).to_numpy()[row]  # noqa: B023,E731
            before = true_numbers(some.column(3).flatten().to_numpy(), part(4), forward)
            after = true_numbers(some.column(5).flatten().to_numpy(), part(6), backward)
            # one more place than letters in each word, from the empty prefix to the empty suffix (number 0)
            begin = np.concatenate([[0], np.cumsum(size)])
            place = np.arange(len(row)) + row
            prefix, suffix = np.zeros((2, len(row) + len(word)), np.int64)
            prefix[place + 1] = before
            suffix[place] = after[begin[row] + begin[row + 1] - 1 - np.arange(len(row))]
            letter = np.frombuffer("".join(word).encode("utf-32-le"), np.uint32)
            last = np.ones(len(row), dtype=np.int8)
            last[:-1] = (letter[1:] != letter[:-1]) | (row[1:] != row[:-1])
            full = np.repeat(np.arange(len(word)), size + 1)
            for p, s, r, kind in ((prefix[place], suffix[place + 1], row, last), (prefix, suffix, full, np.full(len(full), 2, np.int8))):
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(s), pa.array(ident[r]), pa.array(n[r]), pa.array(kind)],
                                                 names=["prefix", "suffix", "id", "n", "kind"])


def neighbours(numbered: DataFrame) -> DataFrame:
    """(id, n_near, best) of every word with a neighbour; best: its most
    frequent one as (-n, id), the least id of equally frequent ones.

    ``numbered``: word, id, n, fore, fore_part, back, back_part; written."""
    shared = numbered.sparkSession.sparkContext.broadcast(
        (inherited(numbered, "word", "fore"), inherited(numbered.withColumn("turned", F.reverse("word")), "turned", "back")))
    pairs = numbered.select("word", "id", "n", "fore", "fore_part", "back", "back_part").mapInArrow(
        lambda batches: _node_pairs(batches, *shared.value), "prefix bigint, suffix bigint, id bigint, n bigint, kind tinyint")
    met = (pairs.groupBy("prefix", "suffix").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "id", "kind"))).alias("x"))
           .filter(F.size("x") > 1))
    met = met.select(F.filter("x", lambda w: w.kind < 2).alias("skip"), F.filter("x", lambda w: w.kind == 1).alias("end"),
                     F.filter("x", lambda w: w.kind == 2).alias("split"))
    best = lambda w: F.when(w.isNotNull(), F.struct(w.m, w.id))

    def skipped(w, i):
        other = best(F.when(i == 0, F.get("skip", 1)).otherwise(F.get("skip", 0)))
        own = F.when(w.kind == 1, best(F.get("split", 0)))
        return F.struct(w.id.alias("id"), (F.size("skip") - 1 + own.isNotNull().cast("int")).alias("n_near"),
                        F.least(other, own).alias("best"))

    def split(w):
        return F.struct(w.id.alias("id"), F.size("end").alias("n_near"), best(F.get("end", 0)).alias("best"))

    each = met.select(F.explode(F.concat(F.transform("skip", skipped), F.transform("split", split))).alias("w")).select("w.*")
    return each.filter("n_near > 0").groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def follow(links: DataFrame) -> DataFrame:
    """(id, root) of a written (id, form) table: where its forms end.  Each
    round doubles the steps taken; a form is ten times as frequent as its
    word, so there are no cycles and few rounds."""
    now = links.select("id", F.col("form").alias("root"))
    while True:
        onward = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        step = written(now.join(onward, "root", "left").select("id", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("id", "root")
        if step.filter("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = number_nodes(variants(docs.select("doc_id", "text")), "word", "fore")
    words = written(words.withColumn("id", F.shiftleft("fore_part", PART) + F.col("fore_row")), "spelling-words")
    turned = number_nodes(words.withColumn("turned", F.reverse("word")), "turned", "back").drop("turned")
    words = written(turned, "spelling-nodes")
    near = neighbours(words)
    found = words.select("id", "word", "n").join(near, "id", "left")
    most = -F.col("best.m")
    found = written(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(most >= RATIO * F.col("n"), F.col("best.id")).alias("form"),
                                 F.when(most >= RATIO * F.col("n"), most).alias("form_n")), "spelling-found")
    roots = follow(found.filter("form IS NOT NULL").select("id", "form"))
    name = lambda a, b: words.select(F.col("id").alias(a), F.col("word").alias(b))
    named = (found.filter("form IS NOT NULL").join(roots, "id")
             .join(name("form", "form_word"), "form").join(name("root", "root_word"), "root"))
    rest = found.filter("form IS NULL")
    return named.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n").union(
        rest.select("word", F.lit(None).cast("string"), "word", "n", "n_near", "form_n"))
