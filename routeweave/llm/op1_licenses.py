"""License scans with a positional rare-token index, on DataFrame functions.

The index holds the places of the words of every template's mandatory key
phrase, function words aside, and each word's document frequency over all
files.  Each file looks up its own license words, the rarest first: a template
is dropped at the first of its key words that the file does not hold.  For the
others, the places of each key word in the file, less its place in the
template, are the alignments that it allows; these lists are intersected, the
shortest first, until nothing is left.  What is left is verified in the file's
words: the key phrase must stand at its place, and enough of the template must
match.  Base phrases are found wherever their words stand consecutively.

The templates bound everything that reaches the driver or a task closure:
one frequency for each license word.

Results for special inputs: a null text is the empty text (0 words, no
labels); repeated rows give repeated results; an empty table gives an empty
result; other columns are ignored.  Equally rare words are taken in
alphabetical order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeweave.llm.native import let, split_words

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of public licenses as (label, words, key phrase).
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
            "gnu general public license as published by the free software foundation", "free software"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted", "with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
)

#: Function words, which are no index terms.
FUNCTION_WORDS = frozenset("a and any are as by for in into is it of or that the this to under use with you".split())

LEAST_COVERAGE = 0.6    # of a template's words at their places

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
KELVIN = "K"       # its lower case is an ASCII letter; only A-Z count here

INDEX_WORDS = sorted({w for _, t, _ in TEMPLATES for w in t.split()} - FUNCTION_WORDS)
#: The word of each base phrase to look for first, by position.
ANCHORS = {"cc by": 0, "general public license": 0, "all rights reserved": 1}
HIT_WORDS = sorted({*INDEX_WORDS, *(p.split()[k] for p, k in ANCHORS.items())})


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("ĸ")))
    return split_words(low, SEPARATORS)


def _hits(words: Column) -> Column:
    """(at, word) of the license words of a file."""
    return F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(HIT_WORDS), F.struct(i.alias("at"), w.alias("word")))))


def rarity(docs: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every index word over all files."""
    found = (docs.select(F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(INDEX_WORDS))).alias("w"))
             .select(F.explode("w").alias("w")).groupBy("w").count().collect())
    df = {r[0]: r[1] for r in found}
    n = docs.count()
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in INDEX_WORDS}


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _index(idf: dict[str, float]) -> Column:
    """The templates as constants; their key words (with their places) are in
    order of rarity."""
    made = []
    for label, text, key in TEMPLATES:
        w, k = text.split(), key.split()
        first = next(i for i in range(len(w)) if w[i:i + len(k)] == k)
        rare = sorted((i for i in range(first, first + len(k)) if w[i] not in FUNCTION_WORDS), key=lambda i: (-idf[w[i]], w[i], i))
        made.append(F.struct(F.lit(label).alias("label"), _array(w).alias("words"), F.lit(first).alias("key_at"), F.lit(len(k)).alias("key_size"),
                             F.array(*[F.struct(F.lit(w[i]).alias("word"), F.lit(i).alias("place")) for i in rare]).alias("rare")))
    return F.array(*made)


def _base(words: Column, hits: Column) -> Column:
    """(start, label) of every place of a base phrase."""
    def places(w: list[str], k: int, label: str) -> Column:
        def stands(x):
            test = x["word"] == w[k]
            for i in range(len(w)):
                if i != k:
                    test = test & (F.get(words, x["at"] + (i - k)) == w[i])
            return test
        return F.transform(F.filter(hits, stands), lambda x: F.struct((x["at"] - k).alias("start"), F.lit(label).alias("label")))

    return F.concat(*[places(phrase.split(), ANCHORS[phrase], label) for phrase, label in PHRASES.items()])


def _starts(hits: Column, t: Column) -> Column:
    """Where a template can begin in a file: the places that all of its key
    words allow, intersected from the shortest list on."""
    lists = F.array_sort(F.transform(t["rare"], lambda k: let(
        F.transform(F.filter(hits, lambda x: x["word"] == k["word"]), lambda x: x["at"] - k["place"]),
        lambda at: F.struct(F.size(at).alias("n"), at.alias("at")))))
    return let(lists, lambda x: F.aggregate(F.slice(x, 2, F.size(x)), x[0]["at"], lambda left, more: F.when(
        F.size(left) == 0, left).otherwise(F.array_intersect(left, more["at"]))))


def _aligned(words: Column, hits: Column, templates: Column) -> Column:
    """(label, start, coverage) of the verified alignments of templates."""
    def verify(t: Column, start: Column) -> Column:
        equal = F.transform(t["words"], lambda w, k: F.coalesce(F.when(start + k >= 0, F.get(words, start + k)) == w, F.lit(False)))
        return let(equal, lambda e: F.struct(
            t["label"].alias("label"), start.alias("start"),
            (F.size(F.filter(e, lambda x: x)) / F.size(e)).alias("coverage"),
            F.forall(F.slice(e, t["key_at"] + 1, t["key_size"]), lambda x: x).alias("keys")))

    held = F.array_distinct(F.transform(hits, lambda x: x["word"]))
    # the rarest key word is asked for first; one that is missing ends it
    possible = let(held, lambda h: F.filter(templates, lambda t: F.forall(t["rare"], lambda k: F.array_contains(h, k["word"]))))
    found = F.flatten(F.transform(possible, lambda t: F.transform(_starts(hits, t), lambda at: verify(t, at))))
    return F.filter(found, lambda x: x["keys"] & (x["coverage"] >= LEAST_COVERAGE))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def _result(words: Column, hits: Column, base: Column, more: Column) -> Column:
    starts = F.transform(base, lambda x: x["start"])
    labels = F.transform(base, lambda x: x["label"])
    return F.struct(
        F.size(words).cast("long").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        _joined(labels).alias("base_labels"),
        _joined(F.concat(labels, F.transform(more, lambda x: x["label"]))).alias("labels"),
        F.greatest(F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
                   F.coalesce(F.array_max(F.transform(more, lambda x: x["coverage"])), F.lit(0.0))).alias("score"),
        F.size(more).cast("long").alias("n_aligned"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Labels and places of license texts in every row: doc_id, n_words,
    n_base, first_word, last_word, base_labels, labels, score, n_aligned."""
    index = _index(rarity(docs))
    made = let(words_of(F.col("text")), lambda words: let(_hits(words), lambda hits: let(
        _base(words, hits), lambda base: let(_aligned(words, hits, index), lambda more: _result(words, hits, base, more)))))
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _sql_templates() -> str:
    rows = []
    for k, (label, text, key) in enumerate(TEMPLATES):
        w, mandatory = text.split(), key.split()
        first = next(i for i in range(len(w)) if w[i:i + len(mandatory)] == mandatory)
        rows.append(f"({k}, '{label}', {_sql_list(w)}, {first}, {_sql_list(mandatory)})")
    return ",\n  ".join(rows)


#: The query in plain SQL: every place of every phrase and template.
ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
phrase(label, p) AS (VALUES {", ".join(f"('{label}', {_sql_list(p.split())})" for p, label in PHRASES.items())}),
template(t, label, tw, pos, mandatory) AS (VALUES
  {_sql_templates()}),
w AS (SELECT doc_id, ws, i, ws[i + 1] AS x FROM (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM d)),
base AS (SELECT doc_id, i AS start, label FROM w JOIN phrase ON x = p[1] AND list_slice(ws, i + 1, i + len(p)) = p),
met AS (
  SELECT doc_id, label, list_sum(list_transform(range(len(tw)), lambda j: CASE WHEN i - pos + j >= 0 AND ws[i - pos + j + 1] = tw[j + 1] THEN 1 ELSE 0 END))
    / len(tw) AS coverage
  FROM w JOIN template ON x = mandatory[1] AND list_slice(ws, i + 1, i + len(mandatory)) = mandatory),
aligned AS (SELECT * FROM met WHERE coverage >= {LEAST_COVERAGE}),
of_base AS (SELECT doc_id, COUNT(*) AS n, MIN(start) AS lo, MAX(start) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
of_all AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM aligned) GROUP BY doc_id),
of_aligned AS (SELECT doc_id, COUNT(*) AS n, MAX(coverage) AS best FROM aligned GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(b.n, 0) AS n_base, CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
  COALESCE(b.labels, '') AS base_labels, COALESCE(l.labels, '') AS labels,
  greatest(CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, COALESCE(a.best, 0.0::DOUBLE)) AS score, COALESCE(a.n, 0) AS n_aligned
FROM d LEFT JOIN of_base b ON b.doc_id = d.doc_id LEFT JOIN of_all l ON l.doc_id = d.doc_id LEFT JOIN of_aligned a ON a.doc_id = d.doc_id
"""
