import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from routeweave.llm import op4_lm
from routeweave.llm.op4_lm import CountFilter, build_slice, level_count, levels, score_documents
from routeweave.llm.textbytes import mix64


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def base_rows(rows):
    c = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return sorted((str(i), held(i), len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n,
                   round(sum(math.log10((c[t] + .1) / (n + .1 * (v + 1))) for t in tokens(x)), 6)) for i, x in rows)


def test_filter_counts_never_too_low():
    rng = np.random.default_rng(5)
    h = mix64(np.arange(20_000, dtype=np.uint64))
    n = rng.integers(1, 3000, 20_000)
    data, lowest = build_slice(h, n, 1 << 18)
    f = CountFilter([(0, data, lowest)], 1, 1 << 18)
    got = f.counts(h)
    assert lowest == 1 and (got >= level_count(levels(n))).all()
    assert (got == level_count(levels(n))).mean() > 0.85
    assert (f.counts(mix64(np.arange(50_000, 70_000, dtype=np.uint64))) > 0).mean() < 0.12
    assert build_slice(h, n, 1 << 12)[1] > 1        # too small: the lowest levels go


def test_scores(spark, docs, monkeypatch):
    monkeypatch.setattr(op4_lm, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(op4_lm, "REGION_BYTES", 2048)
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "The", "of", "é", "x" * rng.randrange(1, 6), "ab" * rng.randrange(1, 9)])
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(word() for _ in range(rng.randrange(0, 120)))) for i in range(200)]
    rows += [(201, None), (202, ""), (203, " \n"), (None, "the of"), (5, "the"), (5, "the")]
    got = score_documents(docs(rows), filter_bytes=1 << 16).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base_rows(rows)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert score_documents(docs([])).collect() == []
    alone = score_documents(docs([(None, "a b")])).collect()[0]
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, pytest.approx(0))


def test_no_level_is_left_out(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 4000}" for _ in range(100))) for i in range(150)]
    train = docs([r for r in rows if not held(r[0])])
    assert {r.lowest for r in op4_lm.count_ngrams(train, 16, 1 << 8).collect()} == {1}
    c = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    c2 = Counter(p for i, x in rows if not held(i) for p in zip([None, *tokens(x)], tokens(x)))
    mid = lambda n: 1.5 * 2.0 ** (n.bit_length() - 1) - 0.5 if n else 0.0
    n, v = sum(c.values()), len(c)
    for small in (1 << 8, 1 << 22):         # the score of a text does not hang on the room the filter began with
        for r in score_documents(docs(rows), filter_bytes=small).collect():
            w = tokens(dict(rows)[r.doc_id])
            want = sum(math.log10((min(mid(c2[a, b]), mid(c[a])) + 4 * (mid(c[b]) + .1) / (n + .1 * (v + 1))) / (mid(c[a]) + 4))
                       for a, b in zip([None, *w], w))
            assert r.score == pytest.approx(want, rel=0.12 if small < 1 << 20 else 0.001)


def test_model_beats_base_on_held_out_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in score_documents(df).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
