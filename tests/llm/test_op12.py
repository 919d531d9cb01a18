import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from routeweave.llm import op12_pii as P
from routeweave.llm.op12_pii import scan_documents

#: The patterns as the contract words them.
RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for k, (kind, rule) in enumerate(RULES):
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def card(rng):
    d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if P.luhn(d + c))


def mention(rng, kind):
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return [f"user.{n(2)}@mail{n(1)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card(rng),
            f"+1 ({n(3)}) 555-{n(4)}"][kind]


FEW = "text to from see near by".split()


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of version 2.0 and né call 12, page 7 x42".split(" "))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(3, 25))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            words.insert(rng.randrange(len(words)), f"{rng.choice(FEW)} {mention(rng, rng.randrange(4))}" + rng.choice([" and", ",", ". So"]))
        rows.append((i, " ".join(words)))
    return rows


def test_base_spans_as_worded():
    rng = random.Random(4)
    pieces = ["a", "Z9", "@", ".", "-", " ", "1", "25", "255", "256", "007", "+", "(", ")", "é", "%", "x@y.z", "4111111111111111", "1.2.3.4", "\n", "__"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 24)))
        assert P.base_spans(t)[0] == brute(t), t


def test_long_runs_are_read_once():
    for unit in ("a", "1", "1.", "+(", "a@", "@", "+1", "a@b-", "a 1 ", "é"):
        began = time.time()
        t = unit * (400_000 // len(unit))
        P.base_spans(t)
        assert sum(len(r.tokens) for r in P.regions(t, {})) >= 0 and time.time() - began < 20, unit


def test_beliefs_are_exact_on_trees_and_skips_pull():
    rng = np.random.default_rng(3)
    for n in (1, 4, 6):
        scores, chain, skip = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)), rng.normal(size=(3, 3))
        tree = np.array([(rng.integers(0, i), i) for i in range(1, n)]).reshape(-1, 2)
        kind = rng.random(len(tree)) < .5
        got = np.exp(P.beliefs(scores, chain, tree[kind], skip, tree[~kind], rounds=20))
        want = np.zeros((n, 3))
        for ys in itertools.product(range(3), repeat=n):
            p = sum(scores[i, y] for i, y in enumerate(ys))
            p += sum((chain if k else skip)[ys[a], ys[b]] for (a, b), k in zip(tree, kind, strict=True))
            for i, y in enumerate(ys):
                want[i, y] += np.exp(p)
        assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-3)
    # a weak node takes the label of a strong similar one, however far away
    scores = np.array([[0., 6., 0.], [.5, 0., 0.], [5., 0., 0.]])
    none = np.zeros((0, 2), int)
    assert P.beliefs(scores, np.zeros((3, 3)), none, np.eye(3) * 2, none).argmax(1).tolist() == [1, 0, 0]
    assert P.beliefs(scores, np.zeros((3, 3)), none, np.eye(3) * 2, np.array([[0, 1]])).argmax(1).tolist() == [1, 1, 0]


@pytest.fixture(scope="module")
def field(docs):
    return P.train(docs(corpus(1, 700)).select("doc_id", "text"))


def spans_of(text, field, block=P.BLOCK):
    base, more = P.find_personal([text], field, {}, block)[0]
    return base, [(P.KINDS[k], text[a:b]) for k, a, b in more]


def test_labels_of_unseen_documents(field):
    right = total = 0
    for _, t in corpus(2, 300):
        found = list(P.regions(t, {}))
        for r, y in zip(found, P.label([found], field)[0], strict=True):
            known = P.known_labels(r, *P.base_spans(t))
            if known is not None:
                right, total = right + (known == y).sum(), total + len(y)
    assert total > 500 and right / total > 0.97


def test_field_finds_what_the_patterns_miss(field):
    rng = random.Random(9)
    for _ in range(20):
        phone, number, ip = mention(rng, 3), card(rng), mention(rng, 1)
        base, more = spans_of(f"text {phone} {number} and the rest", field)
        assert base == [] and sorted(more) == [("card", number), ("phone", phone)]
        # a part of a phone mentioned whole elsewhere
        base, more = spans_of(f"text {phone} and so on. Later text {phone[-8:]} again, {ip}", field)
        assert ("phone", phone[-8:]) in more and len(base) == 2
        assert spans_of(f"text {phone[-8:]} alone", field)[1] == []


def test_clean_texts_stay_clean(field):
    for t in ("version 2.0 of page 7, call 12", "4111 apples, 3.14159 pies @ home", "1234567890123456", "", "a @ b"):
        base, more = spans_of(t, field)
        assert base == brute(t) and more == []


def test_skip_edges_decide(field):
    """The same text without its far twin is labelled otherwise."""
    weak = P.Field(np.zeros_like(field.unary), np.zeros_like(field.chain), 3.0)
    near, far = (list(P.regions(t, {})) for t in ("+44 7700900 x", "7700900 x"))
    weak.unary[near[0].features[1][1:], 7] = 1.0       # "44" behind a plus begins a phone
    weak.chain[7, 8] = 6.0
    weak.unary[far[0].features[0][1], 0] += 0.5
    together = P.label([near + far], weak)[0]
    assert P.KIND_OF[together[1][0]] == 3 and P.KIND_OF[P.label([far], weak)[0][0][0]] == -1
    # and through the beliefs of an earlier block
    assert P.KIND_OF[P.label([near + far], weak, block=2)[0][1][0]] == 3


def test_blocks_label_alike(field):
    t = ". So ".join(x for _, x in corpus(5, 60))
    assert spans_of(t, field, 40)[1] == spans_of(t, field)[1]


def test_query_rows(docs):
    rows = corpus(1, 300) + [(900, None), (901, ""), (902, "x " * 50_000 + "a@b.co"), (None, "a@b.co"), (5, "a@b.co"), (5, "a@b.co")]
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t)
    got = scan_documents(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = [b for t in texts[r.doc_id] for b in [brute(t)]]
        counts = [r.n_email, r.n_ip, r.n_card, r.n_phone]
        i = next(i for i, b in enumerate(want) if [sum(x[0] == k for x in b) for k in range(4)] == counts
                 and r.base_sha256 == hashlib.sha256(",".join(f"{P.KINDS[k]}:{a}:{e}" for k, a, e in b).encode()).hexdigest())
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(P.KINDS[k], str(a), str(e)) for k, a, e in want[i]} <= set(spans) and len(spans) == len(want[i]) + r.n_added
        assert spans == sorted(spans, key=lambda s: (P.KINDS.index(s[0]), int(s[1])))
    assert scan_documents(docs([])).collect() == []
    assert scan_documents(docs([(1, "no number")])).collect()[0].spans == ""
