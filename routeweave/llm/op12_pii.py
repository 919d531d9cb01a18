"""Personal data by a skip-chain conditional random field.

Four patterns (email, ip, card, phone) give the base spans.  They miss what
stands next to other numbers, is a part of an earlier mention or is cut by
their own rules, so every document's numbers and addresses are labelled once
more by a random field over their tokens:

* Nodes are the tokens of all chunks (runs without white space) that hold a
  digit or ``@``; every other token is observed as no entity.  Labels: none,
  and begin and inside for each kind.
* Chain edges join a token with the next one of its region (neighbouring
  chunks of a line).  Skip edges join it with the last earlier token of the
  document that is equal or similar (``similar``), however far away, so
  labels are consistent over the document.
* Loopy belief propagation passes messages along both kinds of edges, all at
  once, in ``ROUNDS`` rounds; the most probable label of each token counts.

Labelled spans that overlap no base span are added if they are well formed for
their kind, or if they are a part (of ``PART`` digits or letters at least) of
an accepted span of the same kind elsewhere in the document.

Weights are learnt by pseudo-likelihood from the base spans of a bounded
sample: of about ``SAMPLE_DOCS`` documents, by hash, the first
``TRAIN_DOCS`` that have tokens to label, ``TRAIN_TOKENS`` at most in each;
regions with a dropped match are left out as unlabelled, and each step sees a
random half of the features (of a fixed seed).  All documents are
scanned whole.

Results for special inputs: a null text is the empty text (no spans); a very
long text is labelled in blocks of ``BLOCK`` tokens, and skip edges into an
earlier block carry its final beliefs; a line of more than ``BLOCK`` tokens is
cut between two chunks; repeated rows give repeated results; of equally
probable labels the first counts; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
NONE = 0                                    # label; 1 + 2 * kind begins an entity, 2 + 2 * kind is inside one
LABELS = 1 + 2 * len(KINDS)
KIND_OF = np.array([-1] + [k for k in range(len(KINDS)) for _ in (0, 1)])
SAME_KIND = (KIND_OF[:, None] == KIND_OF[None, :]).astype(np.float64)
#: Inside follows only begin or inside of its kind.
FORBIDDEN = np.zeros((LABELS, LABELS))
for _k in range(len(KINDS)):
    FORBIDDEN[:, 2 + 2 * _k] = -12.0
    FORBIDDEN[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = 0.0

WEIGHTS = 1 << 12       # rows of the table of feature weights
ROUNDS = 15
BLOCK = 100_000
PART = 7
SAMPLE_DOCS = 20_000
TRAIN_DOCS = 2000
TRAIN_TOKENS = 400
STEPS = 120
#: Mean and strength of the prior of the skip edges' weight: where features
#: tell the sample's labels apart by themselves it stays near the mean.
SKIP_PRIOR = (1.0, 0.01)

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL = re.compile(rf"[A-Za-z0-9._%+-]+{DOMAIN.pattern}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")           # no run of digits is tried twice
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WANTED = re.compile("[0-9@]")
CHUNK = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
SPACE = re.compile(r"[\x20\t]{1,3}")
TOKEN = re.compile(r"[0-9]+|[^\s0-9!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]")
WORD_BEFORE = re.compile(r"(\w{1,24})\W{0,3}\Z")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL, each looked for from its ``@``."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, (end := m.end())
        at = m.end() if m else at + 1


def well_formed(kind: int, text: str) -> bool:
    """Whether a match of a kind's pattern keeps its rules."""
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == 2:
        return 13 <= len(d := digits(text)) <= 19 and luhn(d)
    if kind == 3:
        return 9 <= len(digits(text)) <= 15
    return True


PATTERNS = (EMAIL, IP, CARD, PHONE)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((kind, start, end) of the base spans by kind and start, matches that
    were dropped)."""
    found, dropped = [], []
    if WANTED.search(text):
        for kind, pattern in enumerate(PATTERNS):
            for a, b in _emails(text) if kind == 0 else (m.span() for m in pattern.finditer(text)):
                (found if well_formed(kind, text[a:b]) else dropped).append((kind, a, b))
    return found, [d for d in dropped if d[0] != 2 or len(digits(text[d[1]:d[2]])) >= 13]


# --- tokens and their features ------------------------------------------------

class Region:
    """Neighbouring chunks of a line: tokens, their places and features."""

    __slots__ = ("start", "end", "places", "tokens", "features")

    def __init__(self, text: str, chunks: list[tuple[int, int]], memo: dict):
        self.start, self.end = chunks[0][0], chunks[-1][1]
        before = WORD_BEFORE.search(text, max(0, self.start - 28), self.start)
        word = before[1].lower() if before else ""
        self.places, self.tokens, classes, about = [], [], [], []
        for a, b in chunks:
            chunk = text[a:b]
            first = True
            shape = re.sub("[0-9]+", "9", chunk)[:24]
            shape = ("@" in chunk, re.sub("[A-Za-z]+", "a", shape), chunk.count("."))
            for m in TOKEN.finditer(chunk):
                t = m[0]
                self.places.append((a + m.start(), a + m.end()))
                self.tokens.append(t)
                if t[0] in "0123456789":
                    c = f"d{min(len(t), 20)}"
                    if len(t) <= 3:
                        c += "v" * (int(t) <= 255)
                    elif 13 <= len(t) <= 19:
                        c += "l" * luhn(t)
                elif len(t) == 1 and not t.isalnum():
                    c = t
                else:
                    c = f"a{min(len(t), 6)}"
                classes.append("_" * first + c)
                about.append(shape)
                first = False
        edge = ["^", "^", *classes, "$", "$"]
        self.features = []
        for i in range(len(classes)):
            key = *edge[i:i + 5], about[i], word if i == 0 else ""
            if key not in memo:
                if len(memo) >= 1 << 16:
                    memo.clear()
                memo[key] = _features(key)
            self.features.append(memo[key])


N_FEATURES = 12


def _features(key: tuple) -> list[int]:
    p2, p1, c, n1, n2, (at, shape, dots), word = key
    plain = (x.lstrip("_") for x in (p1, c, n1))
    names = ("", f"c{c}", f"p{p1}", f"n{n1}", f"pc{p1} {c}", f"cn{c} {n1}", f"pcn{p1} {c} {n1}", f"ppc{p2} {p1} {c}",
             f"cnn{c} {n1} {n2}", f"sh{shape} {' '.join(plain)}", f"at{at}{c[:2]}{min(dots, 4)}", f"w{word}{c[:2]}")
    return [zlib.crc32(x.encode()) % WEIGHTS for x in names]


def regions(text: str, memo: dict, block: int = BLOCK) -> Iterator[Region]:
    chunks, size = [], 0
    if not WANTED.search(text):
        return
    for m in CHUNK.finditer(text):
        a, b = m.span()
        if chunks and (size > block or not SPACE.fullmatch(text, chunks[-1][1], a)):
            yield Region(text, chunks, memo)
            chunks, size = [], 0
        chunks.append((a, b))
        size += b - a
    if chunks:
        yield Region(text, chunks, memo)


def similar(token: str) -> str | None:
    """What similar tokens have in common: numbers of three digits or more
    their digits, words of four letters or more their lower-case letters."""
    if token[0] in "0123456789":
        return token if len(token) >= 3 else None
    return token.lower() if len(token) >= 4 else None


# --- the field ----------------------------------------------------------------

class Field:
    """Weights of features, chain and skip edges."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: float):
        self.unary, self.chain, self.skip = unary, chain + FORBIDDEN, skip
        self.live = bool(np.any(unary))

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.unary[features].sum(1)


def _normal(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def beliefs(scores: np.ndarray, chain: np.ndarray, chain_edges: np.ndarray, skip: np.ndarray, skip_edges: np.ndarray,
            rounds: int = ROUNDS) -> np.ndarray:
    """Log beliefs of all nodes after so many rounds of messages; edges are
    rows (from, to), potentials logarithms (from label, to label)."""
    out = _normal(scores)
    parts = [(edges, np.exp(potential)) for edges, potential in ((chain_edges, chain), (skip_edges, skip)) if len(edges)]
    ahead = [np.zeros((len(e), scores.shape[1])) for e, _ in parts]
    back = [np.zeros((len(e), scores.shape[1])) for e, _ in parts]

    def send(source, known, potential):
        x = out[source] - known
        top = x.max(1, keepdims=True)
        return _normal(np.log(np.exp(x - top) @ potential + 1e-30))

    for _ in range(rounds if parts else 0):
        new = [(send(e[:, 0], back[i], p), send(e[:, 1], ahead[i], p.T)) for i, (e, p) in enumerate(parts)]
        total = scores.copy()
        change = 0.0
        for i, ((e, _), (a, b)) in enumerate(zip(parts, new, strict=True)):
            change = max(change, np.abs(a - ahead[i]).max(initial=0), np.abs(b - back[i]).max(initial=0))
            ahead[i], back[i] = a, b
            np.add.at(total, e[:, 1], a)
            np.add.at(total, e[:, 0], b)
        out = _normal(total)
        if change < 1e-4:
            break
    return out


def _edges(found: list[Region], last: dict, begin: int) -> tuple[list, list, list]:
    """(chain edges, skip edges, (node, earlier belief) of links into an
    earlier block) of regions whose nodes count from ``begin``; ``last`` holds
    the last node or belief of each kind of similar tokens."""
    chain, skip, fixed = [], [], []
    for r in found:
        n = len(r.tokens)
        chain += [(begin + i, begin + i + 1) for i in range(n - 1)]
        for i, t in enumerate(r.tokens):
            key = similar(t)
            if key is not None:
                before = last.get(key)
                if isinstance(before, int):
                    skip.append((before, begin + i))
                elif before is not None:
                    fixed.append((begin + i, before))
                last[key] = begin + i
        begin += n
    return chain, skip, fixed


def label(docs: list[list[Region]], field: Field, block: int = BLOCK) -> list[list[np.ndarray]]:
    """The labels of every region of every document, in blocks."""
    out: list[list[np.ndarray]] = [[] for _ in docs]
    work: list[tuple[int, list[Region], dict]] = []
    size = 0

    def flush():
        nonlocal size
        if not size:
            return
        scores = field.scores(np.array([f for _, found, _ in work for r in found for f in r.features]))
        chain, skip, begin = [], [], 0
        potential = field.skip * SAME_KIND
        for _, found, last in work:
            c, s, fixed = _edges(found, last, begin)
            chain += c
            skip += s
            for node, belief in fixed:
                scores[node] += np.log(np.exp(belief) @ np.exp(potential))
            begin += sum(len(r.tokens) for r in found)
        made = beliefs(scores, field.chain, np.array(chain).reshape(-1, 2), potential, np.array(skip).reshape(-1, 2))
        best, begin = made.argmax(1), 0
        for doc, found, last in work:
            for r in found:
                out[doc].append(best[begin:begin + len(r.tokens)])
                begin += len(r.tokens)
            for key, node in last.items():
                if isinstance(node, int):
                    last[key] = made[node]
        work.clear()
        size = 0

    for doc, found in enumerate(docs):
        last: dict = {}
        part: list[Region] = []
        for r in found:
            part.append(r)
            size += len(r.tokens)
            if size >= block:
                work.append((doc, part, last))
                part = []
                flush()
        if part:
            work.append((doc, part, last))
    flush()
    return out


# --- learning -----------------------------------------------------------------

def known_labels(region: Region, found: list, dropped: list) -> np.ndarray | None:
    """Labels of a region's tokens by the base spans (of overlapping ones the
    longest); none where a match was dropped or a span cuts a token."""
    inside = lambda s: s[1] < region.end and region.start < s[2]
    if any(map(inside, dropped)):
        return None
    out = np.zeros(len(region.tokens), np.int64)
    for kind, a, b in sorted(filter(inside, found), key=lambda s: s[2] - s[1]):
        first = True
        for i, (x, y) in enumerate(region.places):
            if x < b and a < y:
                if x < a or y > b:
                    return None
                out[i] = (1 if first else 2) + 2 * kind
                first = False
    return out


def _examples(batches) -> Iterator[pa.RecordBatch]:
    memo: dict = {}
    for batch in batches:
        rows = []
        for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not t or not WANTED.search(t):
                continue
            spans = base_spans(t)
            found, size = [], 0
            for r in regions(t, memo):
                size += len(r.tokens)
                if size > TRAIN_TOKENS:
                    break
                y = known_labels(r, *spans)
                if y is not None:
                    found.append((r, y))
            if not found or size > TRAIN_TOKENS:
                continue
            chain, skip, _ = _edges([r for r, _ in found], {}, 0)
            rows.append((h, [f for r, _ in found for x in r.features for f in x], np.concatenate([y for _, y in found]).tolist(),
                         [x for e in chain for x in e], [x for e in skip for x in e]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in range(1, 5))],
            names=["h", "features", "labels", "chain", "skip"])


def fit(rows: list, steps: int = STEPS, decay: float = 2e-5) -> Field:
    """Weights of the greatest pseudo-likelihood: each label is predicted from
    its token's features and the labels at the other ends of its edges."""
    unary, chain, skip = np.zeros((WEIGHTS, LABELS)), np.zeros((LABELS, LABELS)), 0.0
    y = np.concatenate([np.array(r[2], np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    if not (y > 0).any():
        return Field(unary, chain, skip)
    features = np.concatenate([np.array(r[1], np.int64) for r in rows]).reshape(-1, N_FEATURES)
    begin = np.cumsum([0] + [len(r[2]) for r in rows])
    edges = [np.concatenate([np.array(r[i], np.int64).reshape(-1, 2) + b for r, b in zip(rows, begin, strict=False)]) for i in (3, 4)]
    n = len(y)
    goal = np.zeros((n, LABELS))
    goal[np.arange(n), y] = 1
    (c0, c1), (s0, s1) = edges[0].T, edges[1].T
    around = np.zeros((n, LABELS))          # what the labels at skip edges say, for a weight of one
    np.add.at(around, s0, SAME_KIND[y[s1]])
    np.add.at(around, s1, SAME_KIND[y[s0]])
    state = [[x, np.zeros_like(x), np.zeros_like(x)] for x in (unary, chain, np.array([SKIP_PRIOR[0]]))]
    draw = np.random.default_rng(0)
    for step in range(1, steps + 1):
        # each step sees half of the features, so no feature leans on others that may be absent
        seen = draw.random(features.shape) < 0.5
        score = (state[0][0][features] * seen[:, :, None]).sum(1) + state[2][0][0] * around
        potential = state[1][0] + FORBIDDEN
        np.add.at(score, c1, potential[y[c0]])
        np.add.at(score, c0, potential[:, y[c1]].T)
        miss = (np.exp(_normal(score)) - goal) / n
        grads = [np.stack([np.bincount(features.ravel(), (miss[:, k, None] * seen).ravel(), WEIGHTS) for k in range(LABELS)], axis=1),
                 np.zeros_like(chain), np.array([(miss * around).sum() + SKIP_PRIOR[1] * (state[2][0][0] - SKIP_PRIOR[0])])]
        np.add.at(grads[1], y[c0], miss[c1])
        np.add.at(grads[1].T, y[c1], miss[c0])
        grads[0] += decay * state[0][0]
        grads[1] += decay * state[1][0]
        for (x, mean, square), g in zip(state, grads, strict=True):     # Adam
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            x -= 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return Field(state[0][0], state[1][0], max(0.0, float(state[2][0][0])))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, train_docs: int = TRAIN_DOCS) -> Field:
    """A field learnt from a bounded sample of (doc_id, text) rows."""
    n = docs.count()
    h = F.xxhash64("doc_id", "text")
    drawn = docs.select(h.alias("h"), "text")
    if n > sample_docs:
        drawn = drawn.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * sample_docs / n))
    found = drawn.mapInArrow(_examples, "h bigint, features array<int>, labels array<int>, chain array<int>, skip array<int>")
    return fit(found.orderBy("h", "labels").limit(train_docs).collect())


# --- scanning -----------------------------------------------------------------

def added_spans(text: str, found: list[Region], labels: list[np.ndarray], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The labelled spans that join the base ones."""
    spans = []
    for r, y in zip(found, labels, strict=True):
        open_ = None
        for i, k in enumerate(KIND_OF[y].tolist()):
            a, b = r.places[i]
            if open_ and (k != open_[0] or y[i] % 2):
                spans.append(tuple(open_))
                open_ = None
            if k >= 0:
                open_ = [k, open_[1] if open_ else a, b]
        if open_:
            spans.append(tuple(open_))
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else starts
    free = lambda s: not len(starts) or (i := np.searchsorted(starts, s[2])) == 0 or ends[i - 1] <= s[1]
    spans = [s for s in spans if free(s)]
    good = [s for s in spans if PATTERNS[s[0]].fullmatch(text, s[1], s[2]) and well_formed(s[0], text[s[1]:s[2]])]
    whole = set(good)
    known = {kind: {w for k, a, b in (*base, *good) if k == kind for w in _parts(text[a:b])} for kind in {s[0] for s in spans}}
    return sorted(whole | {s for s in spans if s not in whole and _core(text[s[1]:s[2]]) in known[s[0]]})


def _core(text: str) -> str:
    return "".join(filter(str.isalnum, text)).lower()


def _parts(text: str) -> Iterator[str]:
    """The runs of whole tokens of an entity that are long enough to tell it."""
    tokens = [t[0].lower() for t in TOKEN.finditer(text) if t[0].isalnum()][:12]
    for i in range(len(tokens)):
        for j in range(i + 1, len(tokens) + 1):
            part = "".join(tokens[i:j])
            if len(part) >= PART:
                yield part


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_personal(texts: list[str], field: Field, memo: dict, block: int = BLOCK) -> list[tuple[list, list]]:
    """Per text: (base spans, added spans), each by kind and start."""
    base = [base_spans(t)[0] for t in texts]
    found = [list(regions(t, memo, block)) if field.live else [] for t in texts]
    labels = label(found, field, block)
    return [(b, added_spans(t, r, y, b) if r else []) for t, r, y, b in zip(texts, found, labels, base, strict=True)]


def scan_documents(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, and the
    number of spans that the field adds."""
    src = docs.select("doc_id", "text")
    field = train(src) if field is None else field
    id_type = src.schema["doc_id"].dataType.simpleString()
    shared = src.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        memo: dict = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                some = batch.slice(begin, 500)
                rows = find_personal([t or "" for t in some.column(1).to_pylist()], shared.value, memo)
                count = [[sum(s[0] == k for s in b) for b, _ in rows] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, pa.int64()) for c in count),
                     pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in rows], pa.string()),
                     pa.array([_joined(sorted(b + more)) for b, more in rows], pa.string()),
                     pa.array([len(more) for _, more in rows], pa.int64())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return src.mapInArrow(run, f"doc_id {id_type}, {counts}, base_sha256 string, spans string, n_added bigint")
