"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order (0 to 3 bytes of
context), learnt from a bounded hash sample of labelled documents and frozen.
A byte is coded in its longest known context; a byte that the context has not
seen costs an escape (method C: distinct / (total + distinct)) and is coded
one order lower, down to a uniform code over all bytes.  The language whose
tree gives a text the shortest code wins (ties: the first name); the score is
its share of 2^-length over all languages.

The trees of all languages become one table (context, byte, language) ->
code length, of a size bounded by the sample (``sample_docs`` documents a
language), which is broadcast; every byte of every text is scored.

Results for special inputs: a text that is null or has no letter is ``und``
with score 0; without any labelled text every row is ``und``; repeated rows
give repeated results; an empty table gives an empty result; other columns
are ignored.  A null doc_id is in no held-out part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.llm.textbytes import pieces

ORDER = 3
PAD = 0         # the symbol before a text's first byte
PIECE = 1 << 18         # bytes of text that a worker scores at once, unless one text is longer


def remainder(column, n: int):
    """crc32 of an id as text modulo n; 0 for null."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % n, F.lit(0))


class Trees:
    """Code lengths in bits of every (context, symbol) for every language."""

    def __init__(self, langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]]):
        """grams: per language, codes of ORDER + 1 bytes + 1 (a pad is 0), 9 bits each, and their counts."""
        self.langs = langs
        seen = np.unique(np.concatenate([((g[:, None] >> np.array([27, 18, 9, 0])) & 511).ravel() for g, _ in grams]))
        seen = seen[seen > 0]
        #: symbols: pad, the bytes of the sample, any other byte
        self.size = len(seen) + 2
        self.symbol = np.full(257, self.size - 1, dtype=np.int64)
        self.symbol[0] = PAD
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        a = self.size
        counts = []
        for g, n in grams:
            s = self.symbol[(g[:, None] >> np.array([27, 18, 9, 0])) & 511]
            counts.append((((s[:, 0] * a + s[:, 1]) * a + s[:, 2]) * a + s[:, 3], n))
        # contexts that any language has seen, longest first
        known = [np.unique(np.concatenate([c // a % a ** k for c, _ in counts])) for k in range(ORDER + 1)]
        begin = np.cumsum([0] + [len(k) for k in known])
        self.table = np.zeros((len(langs), begin[-1], a), dtype=np.float32)
        for i, (code, n) in enumerate(counts):
            lower = np.full((1, a), np.log2(257.0))
            above = np.zeros(len(known[0]), dtype=np.int64)
            for k in range(ORDER + 1):
                at = np.searchsorted(known[k], code // a % a ** k)
                c = np.bincount(at * a + code % a, weights=n, minlength=len(known[k]) * a).reshape(-1, a)
                total, kinds = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    own = np.log2(total + kinds) - np.log2(c)
                    escape = np.log2(total + kinds) - np.log2(kinds)
                cost = np.where(c > 0, own, np.where(total > 0, escape, 0) + lower[above])
                self.table[i, begin[k]:begin[k + 1]] = cost
                if k < ORDER:       # the next longer contexts fall back on their suffix
                    above = np.searchsorted(known[k], known[k + 1] % a ** k)
                    lower = cost
        # longest known context of any three symbols
        longest = np.zeros(a ** ORDER, dtype=np.int32)
        every = np.arange(a ** ORDER)
        for k in range(1, ORDER + 1):
            short = np.zeros(a ** k, dtype=np.int32)
            short[known[k]] = np.arange(begin[k], begin[k + 1])
            hit = short[every % a ** k]
            longest = np.where(hit > 0, hit, longest)
        self.longest = longest.astype(np.int32)
        self.table = self.table.reshape(len(langs), -1)

    def lengths(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every row's text in every language."""
        rows = len(offsets) - 1
        a = self.size
        sym = np.zeros(len(values) + ORDER * rows, dtype=np.int64)
        row_of = np.repeat(np.arange(rows), np.diff(offsets))
        at = np.arange(len(values)) + ORDER * (row_of + 1)
        sym[at] = self.symbol[values.astype(np.int64) + 1]
        context = self.longest[(sym[at - 3] * a + sym[at - 2]) * a + sym[at - 1]]
        cell = context.astype(np.int64) * a + sym[at]
        out = np.empty((rows, len(self.langs)))
        for i in range(len(self.langs)):
            c = np.zeros(len(values) + 1)
            np.cumsum(self.table[i][cell], dtype=np.float64, out=c[1:])
            out[:, i] = c[offsets[1:]] - c[offsets[:-1]]
        return out


def _gram_codes(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    sym = np.zeros(len(values) + ORDER * rows, dtype=np.int64)
    at = np.arange(len(values)) + ORDER * (np.repeat(np.arange(rows), np.diff(offsets)) + 1)
    sym[at] = values.astype(np.int64) + 1
    return sym[at - 3] << 27 | sym[at - 2] << 18 | sym[at - 1] << 9 | sym[at]


def train(labelled: DataFrame, sample_docs: int = 400) -> Trees | None:
    """Trees from (doc_id, text, lang) rows: of every language about
    ``sample_docs`` documents by hash of doc_id and text, whole texts.  Their
    context counts are summed by Spark; the driver gets the sums only."""
    rows = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", "lang")
    have = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not have:
        return None
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_docs / n))) for k, n in have.items()])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                for _, _, values, offsets in pieces(batch.column(0).filter(pa.array(langs == lang)), PIECE):
                    code, n = np.unique(_gram_codes(values, offsets), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code), pa.array(n)],
                                                     names=["lang", "code", "n"])

    found = (rows.filter(draw < share).select("text", "lang")
             .mapInArrow(count, "lang string, code bigint, n bigint")
             .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas())
    if not len(found):
        return None
    parts = {k: (x["code"].to_numpy(), x["n"].to_numpy()) for k, x in found.groupby("lang")}
    langs = sorted(parts)
    return Trees(langs, [parts[k] for k in langs])


def has_letter(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row's text has a letter of any script."""
    low = values | 0x20
    plain = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122) & (values < 128))])
    high = np.concatenate([[0], np.cumsum(values >= 128)])
    out = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~out & (high[offsets[1:]] > high[offsets[:-1]])):
        out[i] = any(map(str.isalpha, bytes(values[offsets[i]:offsets[i + 1]]).decode("utf-8", "replace")))
    return out


def predict(docs: DataFrame, trees: Trees | None, keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str, str] = ("lang_pred", "score", "bits_per_byte")) -> DataFrame:
    """The columns of ``keep`` with language, score and bits per byte of every
    row of ``docs``, under ``names``; only the text is looked at."""
    src = docs.select(*keep, F.col("text").alias("text_of"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        model = shared.value
        for batch in batches:
            n = batch.num_rows
            lang, score, rate = ["und"] * n, np.zeros(n), np.zeros(n)
            for begin, end, values, offsets in pieces(batch.column(n_keep), PIECE) if model else ():
                bits = model.lengths(values, offsets)
                best = bits.argmin(1)
                least = bits[np.arange(end - begin), best]
                known = has_letter(values, offsets)
                score[begin:end] = np.where(known, 1 / np.exp2(np.maximum(-900.0, least[:, None] - bits)).sum(1), 0)
                rate[begin:end] = least / np.maximum(1, np.diff(offsets))
                for i in np.flatnonzero(known):
                    lang[begin + i] = model.langs[best[i]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], pa.array(lang, pa.string()), pa.array(score), pa.array(rate)],
                                             names=[*batch.schema.names[:n_keep], *names])

    n_keep = len(keep)
    return src.mapInArrow(run, f"{fields}, {names[0]} string, {names[1]} double, {names[2]} double")


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1, sample_docs: int = 400) -> DataFrame:
    """Languages of all documents, learnt from those whose id does not fall
    into the held-out fold."""
    trees = train(docs.filter(remainder(F.col("doc_id"), folds) != held_out), sample_docs)
    return predict(docs, trees).select(
        "doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score", "bits_per_byte")
