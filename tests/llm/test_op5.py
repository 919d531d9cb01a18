import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from routeweave.llm import op5_suffix_dedup
from routeweave.llm.op5_suffix_dedup import dedup_documents, earlier_copies, longest_factors, suffix_ranks


def brute(rows, length, keep):
    raw = [(t or "").encode() for _, t in rows]
    at = defaultdict(list)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0])):
        for s in range(len(raw[i]) - length + 1):
            at[raw[i][s:s + length]].append((i, s))
    gone = [np.zeros(len(t), dtype=bool) for t in raw]
    for places in at.values():
        for i, s in places[1 if keep == "first" else 0:] if len(places) > 1 else ():
            gone[i][s:s + length] = True
    out = []
    for (d, _), t, g in zip(rows, raw, gone, strict=True):
        kept = np.frombuffer(t, np.uint8)[~g].tobytes()
        runs = int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())
        out.append((str(d), len(t), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n, a="abcdé \n": "".join(rng.choice(a) for _ in range(n))
    shared = [make(n) for n in (11, 12, 13, 30, 90)]
    rows = []
    for i in range(70):
        parts = [make(rng.randrange(0, 40)) if rng.random() < .6 else rng.choice(shared) for _ in range(rng.randrange(0, 5))]
        rows.append((i, "".join(parts)))
    rows += [(100 + k, rows[k][1]) for k in range(6)] + [(200, "a" * 50), (201, "ab" * 30), (202, " "), (203, None), (None, make(60))]
    return rows


@pytest.mark.parametrize("keep, group", [("none", 1000), ("first", 1000), ("none", 1), ("first", 1)])
def test_against_all_strings(docs, monkeypatch, keep, group):
    monkeypatch.setattr(op5_suffix_dedup, "GROUP", group)
    monkeypatch.setattr(op5_suffix_dedup, "CHUNK", 300)
    rows = corpus(3)
    got = dedup_documents(docs(rows), 12, keep, digest=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, 12, keep)


@pytest.mark.parametrize("group", [1000, 1])
def test_copies_are_compared_once(docs, monkeypatch, group):
    seen = []
    for name in ("_compare", "_compare_hot"):
        def spy(rows, *a, f=getattr(op5_suffix_dedup, name)):
            seen.extend((r.h, r.c) for r in rows.select("h", "c").collect())
            return f(rows, *a)
        monkeypatch.setattr(op5_suffix_dedup, name, spy)
    monkeypatch.setattr(op5_suffix_dedup, "GROUP", group)
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = make(60)
    copied = make(30) + passage + make(30)
    rows = [(i, copied) for i in range(40)] + [(50, make(20) + passage + make(50)), (51, passage[:40] + make(30)), (52, make(90))]
    got = dedup_documents(docs(rows), 12, "none", digest=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, 12, "none")
    assert seen and len(seen) == len(set(seen))


def test_production_length_and_segments(docs, monkeypatch):
    monkeypatch.setattr(op5_suffix_dedup, "SEGMENT", 700)
    monkeypatch.setattr("routeweave.llm.textbytes.pieces.__defaults__", (300,))
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p = make(260)
    rows = [(1, make(500) + p + make(900)), (2, make(900) + p), (3, make(199)), (4, p[:200] + make(10)), (5, p[61:] + make(1500) + p)]
    got = dedup_documents(docs(rows), 200, "none", digest=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, 200, "none")


def test_special_rows(docs):
    text = "x".join(str(i) for i in range(90))
    rows = [(1, text), (1, text), (2, text), (3, None), (4, "")]
    got = sorted((r.doc_id, r.n_removed, bytes(r.kept)) for r in dedup_documents(docs(rows), 20, "first").collect())
    assert got == [(1, 0, text.encode())] * 2 + [(2, len(text), b""), (3, 0, b""), (4, 0, b"")]
    assert dedup_documents(docs([])).collect() == []


def test_longest_previous_factors():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    for length in (3, 7, 9, 20):
        strings = [data[i:i + length].tobytes().ljust(length, b"\0") for i in range(len(data))]
        earlier, same = earlier_copies(suffix_ranks(data, length))
        full = range(len(data) - length + 1)
        assert [bool(earlier[i]) for i in full] == [strings[i] in strings[:i] for i in full]
        assert [bool(same[i]) for i in full] == [strings.count(strings[i]) > 1 for i in full]


def test_factor_lengths():
    rng = np.random.default_rng(3)
    for top, length in ((99, 12), (98, 40), (120, 7), (98, 3)):
        data = rng.integers(97, top, 300).astype(np.uint8)
        data[150:200] = data[20:70]
        at = np.sort(rng.choice(300 - length, 150, replace=False))
        own = [data[i:i + length].tobytes() for i in at]
        common = lambda x, y: next((k for k in range(length) if x[k] != y[k]), length)  # noqa: B023,E731
        found = suffix_ranks(data, length)
        assert longest_factors(found, at).tolist() == [max([common(own[i], own[j]) for j in range(i)], default=0) for i in range(150)]
        assert longest_factors(found, at, later=True).tolist() == [max([common(own[i], own[j]) for j in range(i + 1, 150)], default=0) for i in range(150)]


def test_removal_follows_the_factor_lengths(docs, monkeypatch):
    """Without factors nothing in different contexts is removed."""
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p = make(60)
    rows = [(1, make(40) + p + make(40)), (2, make(50) + p + make(20))]
    assert sum(r.n_removed for r in dedup_documents(docs(rows), 12, "none").collect()) >= 120
    monkeypatch.setattr(op5_suffix_dedup, "longest_factors", lambda s, at, later=False: np.zeros(len(at), np.int64))
    assert sum(r.n_removed for r in dedup_documents(docs(rows), 12, "none").collect()) < 120
