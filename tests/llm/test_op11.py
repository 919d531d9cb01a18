import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeweave.llm import op11_collocations
from routeweave.llm.op11_collocations import BiIndex, collocations, cut_score, make_shards


def brute(rows, least=10, first=2000):
    f, total = defaultdict(Counter), Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, n in f.items():
        found = []
        good = {p: a for p, a in n.items() if len(p) > 1 and a >= least}
        for p, a in good.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in good.items()):
                continue
            score, k = min((1_000_000 * a * a // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("The of and a b c rare new York city é ñu".split()) if rng.random() < .9 else f"w{rng.randrange(500)}"
    rows = []
    for i in range(n):
        text = "".join(word() + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b", "  "]) for _ in range(rng.randrange(60)))
        if rng.random() < .4:
            text += " New York City, san francisco bay, San Francisco Bay area"
        rows.append((text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, word string")


@pytest.mark.parametrize("shard_bytes", [4 << 20, 700])
def test_against_all_phrases(table, shard_bytes):
    rows = corpus(5, 300)
    want = brute(rows)
    assert len(want) > 100 and any(x[2] == "san francisco bay" for x in want) and not any(x[2] == "francisco bay" for x in want)
    assert got(collocations(table(rows).repartition(4), shard_bytes=shard_bytes)) == want


def test_ranks_are_cut_per_language(table, monkeypatch):
    rows = corpus(6, 200)
    monkeypatch.setattr(op11_collocations, "SALTS", 3)
    assert got(collocations(table(rows), least=2, first=7)) == brute(rows, 2, 7)


def test_index_counts_every_phrase():
    rng = np.random.default_rng(1)
    for top, longest in ((1, 3), (3, 5), (40, 3), (6, 4)):
        s = np.append(rng.integers(0, top + 1, 500), 0).astype(np.int32)
        s[0] = 0
        want = Counter(tuple(s[i:i + k]) for k in range(2, longest + 1) for i in range(len(s) - k + 1) if (s[i:i + k] > 0).all())
        index = BiIndex(s, top, longest)
        found, have = index.pairs(), {}
        for size in range(2, longest + 1):
            have |= {tuple(map(int, g)): int(b - a) for g, a, b in zip(*found, strict=True)}
            found = index.to_left(*found) if size < longest else found
        assert have == {tuple(map(int, k)): v for k, v in want.items()}


def test_scores_are_exact(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        a = rng.randrange(1, 10 ** rng.randrange(1, 14))
        rows.append((a, a + rng.randrange(10 ** rng.randrange(0, 14)), a + rng.randrange(10 ** rng.randrange(0, 14))))
    made = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert dict(made.dtypes)["s"] == "bigint"
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in made.collect())


def test_special_rows(table):
    long = "one two three. " * 4000 + "no break here " * 3000
    rows = [(None, "en"), ("", "en"), (" \t.,", None), (long, "en"), (long, None), ("x y", "fr")] + [("same row again", "de")] * 12
    assert got(collocations(table(rows), shard_bytes=10_000)) == brute(rows)
    shards = make_shards(table(rows), 10_000).select(F.size("words").alias("w"), F.length("seq").alias("n")).collect()
    assert len(shards) > 8 and max(r.n for r in shards) < 4 * 20_000
    assert collocations(table([])).collect() == []


def test_several_passes_of_the_filter(table, monkeypatch):
    rows = corpus(7, 200)
    monkeypatch.setattr(op11_collocations, "FILTER_BYTES", 512)
    monkeypatch.setattr(op11_collocations, "FILTER_BITS", 64)
    assert got(collocations(table(rows), least=3)) == brute(rows, 3)


def test_counts_come_through_the_index(table, monkeypatch):
    """Without extension to the left no phrase has three words."""
    monkeypatch.setattr(op11_collocations, "_count_triples", lambda batches, *_: iter(()))
    assert {r.phrase.count(" ") for r in collocations(table(corpus(5, 100))).collect()} == {1}
