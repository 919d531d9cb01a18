import random
import re

from routeweave.llm.op1_licenses import FUNCTION_WORDS, TEMPLATES, scan_licenses

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    w = words(text)
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def aligned(text):
    """Templates tried at every place of the text."""
    w, out = words(text), []
    for label, t, key in TEMPLATES:
        t, key = t.split(), key.split()
        first = next(i for i in range(len(t)) if t[i:i + len(key)] == key)
        rare = [i for i, x in enumerate(t) if x not in FUNCTION_WORDS]
        for o in range(-len(t), len(w)):
            there = [0 <= o + k < len(w) and w[o + k] == x for k, x in enumerate(t)]
            if all(there[first:first + len(key)]) and sum(there) >= 0.6 * len(t) and sum(there[i] for i in rare) >= min(2, len(rare)):
                out.append((label, sum(there) / len(t)))
    return out


def texts():
    rng = random.Random(12)
    vocab = "the of by cc all rights reserved general public license gnu version 2 3 mit apache K CC BY é software free".split()
    out = [None, "", " .,", "CCK BY", "All Rights Reserved. all-rights/reserved", "cc by nc 4.0 Licensed under CC BY-NC 4.0."]
    out += [rng.choice([" ", ", "]).join(rng.choice(vocab) for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    for label, t, _ in TEMPLATES:
        w = t.split()
        out.append("intro the " + t.title() + ". end")
        w[rng.randrange(len(w))] = "other"
        out.append(" ".join(w) + " all rights reserved")
    return out


def test_against_every_alignment(docs):
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts())]
    rows += [rows[5], rows[5], (900, "Licensed under the Apache License, Version 2.0 " * 300)]
    got = scan_licenses(docs(rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        b, a = base(t), aligned(t)
        labels = ",".join(sorted({x for x in b[4].split(",") if x} | {x for x, _ in a}))
        want.append((str(i), *map(str, b), labels, round(max([1.0 if b[1] else 0.0, *(c for _, c in a)]), 9), len(a)))
    assert sorted((str(r.doc_id), str(r.n_words), str(r.n_base), str(r.first_word), str(r.last_word), r.base_labels, r.labels,
                   round(r.score, 9), r.n_aligned) for r in got) == sorted(want)
    assert any("apache-2.0" in r.labels for r in got)


def test_long_texts_of_many_notices(docs):
    filler = " person purpose terms conditions domain 0 2 3 copy modify software source license fee permitted gnu free "
    every = [t for _, t, _ in TEMPLATES]
    rows = [(1, " x. ".join(every)), (2, filler.join(every)), (3, filler * 40 + every[2] + filler * 40),
            (4, "\n".join((every[9], every[1], "Licensed under the Apache License, Version 2.0")))]
    rows += [(10 + i, "the apache license version 2 0 and the mit license") for i in range(30)]     # common words of notices
    got = {r.doc_id: r for r in scan_licenses(docs(rows)).collect()}
    for i, t in rows:
        a = aligned(t)
        labels = {x for x in base(t)[4].split(",") if x} | {x for x, _ in a}
        assert (set(got[i].labels.split(",")), got[i].n_aligned) == (labels, len(a)), i
    assert {"apache-2.0", "bsd", "mit"} <= set(got[4].labels.split(","))


def test_empty_table_and_native_plan(docs):
    df = scan_licenses(docs([]))
    assert df.collect() == []
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
