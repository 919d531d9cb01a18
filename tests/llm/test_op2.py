import random
import re
from collections import Counter

import numpy as np

import pyarrow as pa

from routeweave.llm.op2_decontaminate import RADIUS, HammingIndex, Items, drop_leaks, find_leaks
from routeweave.llm.textbytes import as_bytes


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(rows, items):
    """Best windows of all items in all documents."""
    out = []
    for d, t in rows:
        w = words(t)
        for i, x in items:
            v = words(x)
            if not v or not w:
                continue
            k = min(5, len(v))
            own, every = Counter(grams(v, k)), grams(w, k) or [tuple(w)]
            a, best = sum(own.values()), None
            for q in range(max(1, len(every) - a + 1)):
                there = Counter(every[q:q + a])
                both = sum((own & there).values())
                s = both / (a + sum(there.values()) - both)
                if s >= 0.8 and (best is None or s > best[0]):
                    best = s, q
            if best:
                out.append((str(d), i, round(best[0], 9), best[1]))
    return sorted(out)


def test_against_every_window(spark, docs):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 7, 9, 12, 16, 20, 25, 33, 41, 42, 50, 59, 90, 140, 3, 2])]
    items += [(30, "to be or not to be or not to be or not"), (31, ""), (32, None)]
    rows = []
    for d in range(260):
        w = [word() for _ in range(rng.choice([0, 3, 40]))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            x = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                if x:
                    i = rng.choice([0, len(x) - 1, rng.randrange(len(x))])
                    x[i:i + rng.choice([0, 1, 1])] = [word()] * rng.choice([0, 1, 1])
            w += x + [word() for _ in range(rng.choice([0, 5]))]
        rows.append((d, rng.choice([" ", ", ", "\n"]).join(rng.choice([x, x.upper()]) if x.isascii() else x for x in w)))
    rows += [(900, None), (901, ""), (None, items[8][1]), (5, items[9][1])]
    bench = spark.createDataFrame([(*x, "extra") for x in items + items[:2]], "item_id bigint, text string, score string")
    got = find_leaks(docs(rows), bench).collect()
    want = brute(rows, items)
    assert sorted((str(r.doc_id), r.item_id, round(r.similarity, 9), r.start_word) for r in got) == want
    assert any(r.similarity < 1 for r in got)
    left = {str(r.doc_id) for r in drop_leaks(docs([x for x in rows if x[0] != 5]), bench).collect()}
    assert left == {str(d) for d, _ in rows if d != 5} - {x[0] for x in want}


def test_swapped_halves(spark, docs):
    rng = random.Random(2)
    items = [(n * 10 + k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))) for n in range(40, 45) for k in range(4)]
    rows = []
    for i, t in items:
        w = t.split()
        for lead in range(8):       # places beside the grid
            words_ = ["x%d" % rng.randrange(10**6) for _ in range(lead)] + w[len(w) // 2:] + w[:len(w) // 2]
            rows.append((i * 10 + lead, " ".join(words_)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(rows, items)
    got = find_leaks(docs(rows), bench).collect()
    assert len(want) == len(rows)
    assert sorted((str(r.doc_id), r.item_id, round(r.similarity, 9), r.start_word) for r in got) == want


def test_blocks_find_all_within_radius():
    rng = np.random.default_rng(1)
    e = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    q = np.concatenate([e, rng.integers(0, 1 << 63, 50).astype(np.uint64)])
    for i in range(400):
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            q[i] ^= np.uint64(1) << np.uint64(b)
    far = np.bitwise_count(q[:, None] ^ e[None, :])
    assert {(int(a), int(b)) for a, b in zip(*HammingIndex(e).search(q), strict=True)} == \
        {(int(a), int(b)) for a, b in zip(*np.nonzero(far <= RADIUS), strict=True)}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert find_leaks(docs([(1, "a b c")]), none).collect() == []
    assert drop_leaks(docs([(1, "a b c")]), none).count() == 1
    one = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert find_leaks(docs([]), one).collect() == []


def hits(items, texts):
    rows = Items([i for i, _ in items], pa.array([x for _, x in items])).find(*as_bytes(pa.array(texts)))
    return sorted((str(row), items[item][0], round(sim, 9), start) for row, item, sim, start, _ in rows)


def test_repeated_phrases_in_any_order():
    """Items of one phrase many times, and texts with its parts in another order."""
    rng = random.Random(6)
    for _ in range(60):
        phrase = [f"p{i}" for i in range(rng.choice([2, 3, 4, 5]))]
        single = [f"s{i}" for i in range(rng.choice([3, 12, 24]))]
        parts = [[w] for w in single]
        item = [w for p in parts for w in phrase + p] + phrase
        texts = []
        for _ in range(4):
            rng.shuffle(parts)
            w = [f"x{rng.randrange(9)}" for _ in range(rng.randrange(8))] + [w for p in parts for w in phrase + p] + phrase
            for _ in range(rng.choice([0, 0, 1, 3])):
                w[rng.randrange(len(w))] = "new"
            texts.append(" ".join(w + ["end"] * rng.randrange(8)))
        items = [(7, " ".join(item)), (8, "p0 p1 " * 20), (9, " ".join(single))]
        assert hits(items, texts) == brute(list(enumerate(texts)), items)


def test_repetitive_text_takes_linear_time():
    import time
    items = [(i, f"start{i} " + "x " * 60 + f"end{i}") for i in range(400)]
    began = time.time()
    text = "x " * 100_000
    found = hits(items, [text, "y " * 1000])
    assert time.time() - began < 20
    assert len(found) == 400 and found[0] == brute([(0, "x " * 200)], items[:1])[0]
