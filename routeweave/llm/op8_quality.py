"""Quality rules with adaptive thresholds, on DataFrame functions only.

Every text's measures are computed inside its row.  Per language and source,
mergeable quantile sketches of four rates are aggregated: counts of values in
bins of a fixed relative width (``BIN``), so a sketch is a sum, the same in
every run and order, and its quantiles are true to that width.  A group's
quantiles are mixed with those of its language's merged sketch, with weights n
and ``SMALL_GROUP`` for a group of n documents.

A document fails a rule if its rate lies above its group's median by more than
``FENCE`` standard deviations.  Their square is the group's spread (from the
interquartile range) and the noise of counting in this document: its number of
words or lines is finite, and one event changes as many of them as ``UNITS``
says.  There are no other thresholds; they are joined back by language and
source.

Results for special inputs: a null or empty text has 0 words and fails;
null languages and sources are groups of their own; repeated rows give
repeated results; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from routeweave.llm.native import let, split_words
from routeweave.llm.tables import written

SPACES = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
FENCE = 8.0
SMALL_GROUP = 200       # documents that the language's quantiles count for
BIN = 1.02              # a bin's upper end over its lower one
ZERO = -(1 << 20)       # the bin of 0, below all others
QUARTILE = 1.349        # interquartile range of a normal distribution, in standard deviations
#: Rates, what they count in, and how many of it one event changes: symbols a
#: word, share of repeated lines, share of words in repeated windows (twice
#: three words at once), code points a word (words vary by some).
UNITS = {"symbol_rate": ("n_words", 1), "dup_line_rate": ("n_lines", 1), "repeat_rate": ("n_words", 6), "word_length": ("n_words", 3)}


def _covered(hashes: Column) -> Column:
    """Words in three-word windows whose hash occurs twice or more.

    Windows sorted by hash put equal ones side by side; the sorted positions
    of those cover min(3, gap to the next) words each."""
    def repeated(p: Column) -> Column:
        twice = F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def cover(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        let(let(by_hash, repeated), cover))


def _word_measures(words: Column) -> Column:
    windows = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                      1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.struct(F.size(words).cast("long").alias("n_words"),
                    F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                    let(windows, _covered).cast("long").alias("n_repeat_words"))


def _line_measures(lines: Column) -> Column:
    return F.struct(F.size(lines).cast("long").alias("n_lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACES}]"))
    made = docs.select("doc_id", "lang", "source", let(split_words(text, SPACES), _word_measures).alias("w"),
                       let(lines, _line_measures).alias("l"),
                       (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    return made.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
                       "l.n_lines")


def _rates(m: DataFrame) -> DataFrame:
    def share(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return m.withColumns({"symbol_rate": share("n_symbols", "n_words"), "dup_line_rate": share("n_dup_lines", "n_lines"),
                          "repeat_rate": share("n_repeat_words", "n_words"), "word_length": share("word_chars", "n_words")})


def sketches(rates: DataFrame) -> DataFrame:
    """lang, source, rate, bin, n: how many documents of a group have a rate in
    a bin.  Empty documents take no part."""
    def bin_of(c):
        return F.when(F.col(c) > 0, F.ceil(F.log(F.col(c)) / math.log(BIN)).cast("int")).otherwise(F.lit(ZERO))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("rate"), bin_of(c).alias("bin")) for c in UNITS]))
    return (rates.filter("n_words > 0").select("lang", "source", each.alias("x")).groupBy("lang", "source", "x.rate", "x.bin")
            .agg(F.count("*").alias("n")))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Number of documents and quartiles (q1, q2, q3) of every group and rate;
    sketches of groups with equal ``keys`` are merged."""
    merged = sketch.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*keys, "rate")
    at = merged.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    value = F.when(F.col("bin") == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(BIN), F.col("bin")) * (2 / (1 + BIN)))
    return at.withColumn("value", value).groupBy(*keys, "rate").agg(
        F.max("all").alias("n"), *[F.min(F.when(4 * F.col("upto") >= q * F.col("all"), F.col("value"))).alias(f"q{q}") for q in (1, 2, 3)])


def thresholds(rates: DataFrame) -> DataFrame:
    """One row per language and source: middle and spread of each rate."""
    sketch = written(sketches(rates), "quality-sketches")
    own = quartiles(sketch, ["lang", "source"])
    whole = quartiles(sketch, ["lang"]).select(F.col("lang").alias("lang_of"), F.col("rate").alias("rate_of"), *[F.col(f"q{q}").alias(f"all{q}") for q in (1, 2, 3)])
    both = own.join(whole, F.col("lang").eqNullSafe(F.col("lang_of")) & (F.col("rate") == F.col("rate_of")))
    part = F.col("n") / (F.col("n") + SMALL_GROUP)
    mixed = both.select("lang", "source", "rate", *[(part * F.col(f"q{q}") + (1 - part) * F.col(f"all{q}")).alias(f"m{q}") for q in (1, 2, 3)])
    one = lambda c, x: F.max(F.when(F.col("rate") == c, x))
    return mixed.groupBy("lang", "source").agg(
        *[one(c, F.col("m2")).alias(f"middle_{c}") for c in UNITS],
        *[one(c, (F.col("m3") - F.col("m1")) / QUARTILE).alias(f"spread_{c}") for c in UNITS])


def _over(c: str) -> Column:
    """Whether a document's rate is above what its group's allows."""
    counted, unit = UNITS[c]
    n, middle = F.greatest(F.col(counted), F.lit(1)), F.col(f"middle_{c}")
    noise = unit * (middle + unit / n) / n
    return F.coalesce(F.col(c) - middle > FENCE * F.sqrt(F.pow(F.col(f"spread_{c}"), 2) + noise), F.lit(False))


def quality(docs: DataFrame) -> DataFrame:
    """Measures, base verdict and verdict of every row.  Measures are written
    once, so texts are read once."""
    m = written(measures(docs), "quality-measures")
    rates = _rates(m)
    limits = thresholds(rates).withColumnsRenamed({"lang": "lang_of", "source": "source_of"})
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_join(F.array_compact(F.array(*[F.when(_over(c), F.lit(c)) for c in UNITS])), ",")
    same = F.col("lang").eqNullSafe(F.col("lang_of")) & F.col("source").eqNullSafe(F.col("source_of"))
    return rates.join(limits, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & (failed == "")).alias("kept"), failed.alias("failed_rules"))


def _sql_rates() -> str:
    share = {"symbol_rate": "n_symbols / n_words", "dup_line_rate": "n_dup_lines / n_lines", "repeat_rate": "n_repeat_words / n_words",
             "word_length": "word_chars / n_words"}
    return ",\n  ".join(f"CASE WHEN {counted} > 0 THEN {x} ELSE 0.0 END AS {c}" for (c, x), counted in zip(
        share.items(), ("n_words", "n_lines", "n_words", "n_words"), strict=True))


def _sql_over(c: str) -> str:
    counted, unit = UNITS[c]
    n = f"greatest({counted}, 1)"
    noise = f"{unit} * (m.{c} + {unit} / {n}) / {n}"
    return f"COALESCE(r.{c} - m.{c} > {FENCE} * sqrt(pow(m.spread_{c}, 2) + {noise}), false)"


#: The query in plain SQL.
ORACLE_SQL = f"""
WITH w AS (
  SELECT doc_id, lang, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM (SELECT *, COALESCE(text, '') AS t FROM documents)),
win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n >= 2),
rep AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM twice) GROUP BY doc_id),
measured AS (
  SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, COALESCE(rep.n, 0) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
rated AS (SELECT *,
  {_sql_rates()}
  FROM measured),
sketch AS (
  SELECT lang, source, rate, CASE WHEN x > 0 THEN CAST(ceil(ln(x) / {math.log(BIN)!r}) AS INTEGER) ELSE {ZERO} END AS bin, COUNT(*) AS n FROM (
    SELECT lang, source, unnest([{", ".join(f"'{c}'" for c in UNITS)}]) AS rate, unnest([{", ".join(UNITS)}]) AS x FROM rated WHERE n_words > 0)
  GROUP BY ALL),
summed AS (
  SELECT true AS own, lang, source, rate, bin, n FROM sketch
  UNION ALL SELECT false, lang, NULL, rate, bin, SUM(n) FROM sketch GROUP BY lang, rate, bin),
ranked AS (
  SELECT *, SUM(n) OVER (PARTITION BY own, lang, source, rate ORDER BY bin) AS upto, SUM(n) OVER (PARTITION BY own, lang, source, rate) AS total,
    CASE WHEN bin = {ZERO} THEN 0.0 ELSE pow({BIN}, bin) * {2 / (1 + BIN)!r} END AS value FROM summed),
quart AS (
  SELECT own, lang, source, rate, CAST(MAX(total) AS DOUBLE) AS n, {", ".join(f"MIN(CASE WHEN 4 * upto >= {q} * total THEN value END) AS q{q}" for q in (1, 2, 3))}
  FROM ranked GROUP BY own, lang, source, rate),
mixed AS (
  SELECT g.lang, g.source, g.rate, {", ".join(f"g.n / (g.n + {SMALL_GROUP}) * g.q{q} + (1 - g.n / (g.n + {SMALL_GROUP})) * a.q{q} AS m{q}" for q in (1, 2, 3))}
  FROM quart g JOIN quart a ON g.own AND NOT a.own AND a.lang IS NOT DISTINCT FROM g.lang AND a.rate = g.rate),
m AS (
  SELECT lang, source, {", ".join(f"MAX(CASE WHEN rate = '{c}' THEN m2 END) AS {c}, MAX(CASE WHEN rate = '{c}' THEN (m3 - m1) / {QUARTILE} END) AS spread_{c}" for c in UNITS)}
  FROM mixed GROUP BY lang, source),
judged AS (
  SELECT r.*, array_to_string(list_filter([{", ".join(f"CASE WHEN {_sql_over(c)} THEN '{c}' END" for c in UNITS)}], lambda x: x IS NOT NULL), ',') AS failed_rules,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM rated r LEFT JOIN m ON m.lang IS NOT DISTINCT FROM r.lang AND m.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""
