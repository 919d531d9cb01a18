import random
import re
import zlib
from collections import Counter, defaultdict

from routeweave.llm import op13_spelling
from routeweave.llm.op13_spelling import follow, spelling_groups


def words_of(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = words_of(rows)
    by = defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    form, out = {}, {}
    for w in n:
        found = [v for k in (-1, 0, 1) for v in by[len(w) + k] if near(v, w)]
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
        out[w] = len(found)
    root = {}
    for w in n:
        r = w
        while form[r] is not None:
            r = form[r]
        root[w] = r
    return sorted((w, form[w] or "", root[w], n[w], out[w], n[form[w]] if form[w] else 0) for w in n)


def got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def corpus(seed):
    rng = random.Random(seed)
    letters = "aabbcéÀ×"
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 7, 8, 9]))) for _ in range(60)]
    base += ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "aabbaabb", "aabaabb"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(base[:8] if rng.random() < .6 else base)
            if rng.random() < .3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice(letters), w[k] + rng.choice(letters)]) + w[k + 1:]
            words.append(w.upper() if rng.random() < .1 else w)
        rows.append((i, rng.choice([" ", "1", ", ", "-"]).join(words)))
    return rows


def test_against_all_pairs(docs, spark):
    rows = corpus(3)
    want = brute(rows)
    assert any(x[1] for x in want) and any(x[1] != x[2] for x in want if x[1]) and max(x[4] for x in want) > 8
    assert got(spelling_groups(docs(rows).repartition(5))) == want
    for n in ("1", "37"):           # ranges of one word and of all words
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert got(spelling_groups(docs(rows))) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_special_rows(docs):
    long = "abcdefgh" * 20_000
    rows = [(1, None), (2, ""), (3, "short 12 words"), (None, "spelling spelling"), (None, "spelling " * 30), (4, long + " " + long),
            (5, long + "x " + long + "x"), (6, "spellin spellin " * 2), (6, "spellin spellin " * 2), (7, "mañana tomorrow")]
    assert got(spelling_groups(docs(rows))) == brute(rows)
    assert spelling_groups(docs([])).collect() == []


def test_forms_are_followed_to_the_last(spark):
    rows = [(i, i + 1) for i in range(19)] + [(100 + i, 7) for i in range(50)]
    found = {r.id: r.root for r in follow(spark.createDataFrame(rows, "id long, form long")).collect()}
    assert found == {**{i: 19 for i in range(19)}, **{100 + i: 19 for i in range(50)}}


def test_words_come_through_the_node_pairs(docs, monkeypatch):
    """Without the pairs no word has a neighbour."""
    monkeypatch.setattr(op13_spelling, "_node_pairs", lambda batches, *_: iter(()))
    assert all(r.n_near == 0 and r.form is None for r in spelling_groups(docs(corpus(3))).collect())
