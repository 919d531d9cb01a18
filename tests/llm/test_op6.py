import random
import re

import pytest

from routeweave.llm import op6_jaccard
from routeweave.llm.graph import components
from routeweave.llm.op6_jaccard import Bands, jaccard_components


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, groups, copies):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and a in".split()) if rng.random() < .3 else "".join(rng.choice("abcde") for _ in range(5))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 5, 12, 40, 90, 200]))]
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                i = rng.randrange(len(w))
                w[i:i + rng.choice([0, 1])] = [word()] * rng.choice([0, 1, 1])
                w = w or ["x"]
            texts.append(rng.choice([" ", "\n "]).join(x.upper() if rng.random() < .1 else x for x in w))
    rng.shuffle(texts)
    return list(enumerate(texts + ["", None, " \t"], 100))


@pytest.mark.parametrize("k, percent, block", [(3, 90, 512), (5, 80, 4)])
def test_against_all_pairs(docs, monkeypatch, k, percent, block):
    monkeypatch.setattr(op6_jaccard, "BLOCK", block)
    rows = corpus(percent, 40, 10)
    got = jaccard_components(docs(rows), k, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, k, percent)


def test_sets_of_equal_names_are_told_apart(docs, monkeypatch):
    """With names of four bits nearly all sets clash at first."""
    rows, true = corpus(3, 15, 6), op6_jaccard.identity
    monkeypatch.setattr(op6_jaccard, "identity", lambda s: (true(s)[0] & 15, true(s)[1]))
    got = jaccard_components(docs(rows), 3, 90).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 3, 90)


def test_special_rows(docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text), (7, text), (7, "other words here now"), (3, text + " z"), (None, text), (None, "lonely words of null"), (9, None)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_components(docs(rows)).collect())
    assert got == sorted([("7", 58, 3), ("7", 58, 3), ("7", 2, 7), ("3", 59, 3), ("None", 58, 3), ("None", 2, None), ("9", 0, 9)])
    assert jaccard_components(docs([])).collect() == []


def test_bands_cover_linked_sizes():
    for percent in (90, 80):
        b = Bands(percent)
        for n in range(1, 3000):
            far = n * 100 // percent
            assert b.band(far) - b.band(n) <= 1
            parts, g = b.parts(b.band(n))
            assert parts == 1 or parts - b.difference(n + far) >= g


def test_components_of_chains(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(200 + i, 200) for i in range(40)] + [(5, 5), (300, 301), (300, 301)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{200 + i: 200 for i in range(40)}, 300: 300, 301: 300}
