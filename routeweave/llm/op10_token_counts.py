"""Token counts by prefix dynamic programming.

For a byte-pair vocabulary the encoding of a prefix of a word ends in exactly
one token: the token t ending there for which (last token of the prefix before
t, t) stays two tokens when merged on its own.  So one pass over a word's
positions gives last token and exact token count of every prefix, from the
counts of shorter prefixes.  Word prefixes add up to text prefixes, and
questions about budgets (how many tokens has this prefix, which is the longest
prefix of at most b tokens) are look-ups, with nothing encoded again.

Results for special inputs: a null text is the empty text (0 tokens);
repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.  A special token's string inside a text counts as
that one token (the library's default); a prefix that ends inside the string
is ordinary text.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from routeweave.llm import bpe

MEMO_WORDS = 400_000        # memory bound of a worker's memo, not of the work
SLOTS = 1 << 18             # memo of checked token pairs

#: Endings that the splitting pattern takes as words.
LONG_ENDINGS = ("'re", "'ve", "'ll")


def byte_of_letter() -> dict[str, int]:
    """Byte-level alphabets write printable bytes as themselves and the
    others as the letters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Prefix counts for one tokenizer file (byte-level BPE with merges)."""

    def __init__(self, spec: dict, pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special))).finditer if self.special else None
        byte, vocab = byte_of_letter(), spec["model"]["vocab"]
        ids = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        self.first_id = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        size = max(ids.values()) + 1
        # merges happen in the order of the list: rank of the merge that makes a token, -1 for a byte
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        first = np.unique(made, return_index=True)[1]
        self.rank[made[first]], self.left[made[first]], self.right[made[first]] = first, left[first], right[first]
        self.pairs = bpe.Merges(left, right, np.arange(len(pairs)))
        self._trie([t for t in ids if self._stable(ids[t])], ids)
        self.seen = np.full(SLOTS, -1, dtype=np.int64)
        self.good = np.zeros(SLOTS, dtype=bool)
        self.memo: dict[str, bytes] = {}

    def _stable(self, token: int) -> bool:
        """Whether the encoding of the token's bytes is the token itself:
        its two parts are, and no merge inside comes before."""
        if self.rank[token] < 0:
            return bool((self.first_id == token).any())
        known = self.__dict__.setdefault("_known", {})
        if token not in known:
            a, b = int(self.left[token]), int(self.right[token])
            known[token] = self._stable(a) and self._stable(b) and \
                bool(self._apart(np.array([a]), np.array([b]), np.array([self.rank[token]]))[0])
        return known[token]

    def _trie(self, tokens: list[bytes], ids: dict[bytes, int]) -> None:
        """Tokens by their bytes from the last to the first."""
        child: dict[int, int] = {}
        token_at = [-1]
        for t in tokens:
            node = 0
            for b in reversed(t):
                key = node << 8 | b
                node = child.get(key, 0)
                if not node:
                    node = child[key] = len(token_at)
                    token_at.append(-1)
            token_at[node] = ids[t]
        self.child = child
        self.edges = np.array(sorted(child), dtype=np.int64)
        self.edge_to = np.array([child[k] for k in self.edges.tolist()], dtype=np.int64)
        self.token_at = np.array(token_at, dtype=np.int64)

    def _apart(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether encoding two tokens side by side never merges across the
        border before a merge of rank ``limit``.  Merges are undone from the
        last to the first: while x and y face each other at the border, their
        pair must not have a rank below that of the next merge of either."""
        ok = np.ones(len(x), dtype=bool)
        rows, x, y, limit = np.arange(len(x)), x.copy(), y.copy(), limit.copy()
        while len(rows):
            rank = self.pairs.look_up(x, y)
            bad = (rank >= 0) & (rank < limit)
            ok[rows[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            undo_x = rx > ry            # of equal ranks the left one merged first
            limit = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            rows, x, y, limit = rows[go], x[go], y[go], limit[go]
        return ok

    def follows(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the token can come after ``last`` (-1: nothing)."""
        key = (last + 1) << 32 | token
        slot = ((key * np.int64(0x9E3779B97F4A7C15 - (1 << 64))) >> np.int64(40)) & (SLOTS - 1)
        good = self.good[slot]
        new = np.flatnonzero(self.seen[slot] != key)
        if len(new):
            l, t = last[new], token[new]
            fresh = l < 0
            fresh[~fresh] = self._apart(l[~fresh], t[~fresh], np.full(int((~fresh).sum()), len(self.pairs.keys)))
            good[new] = fresh
            self.seen[slot[new]] = key[new]
            # slots met twice in one call keep the last writer, for key and flag alike
            self.good[slot[new]] = fresh
        return good

    def byte_prefixes(self, words: list[bytes]) -> list[np.ndarray]:
        """Token counts of all byte prefixes (1 to n) of words."""
        out: list = [None] * len(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(length > bpe.LONG):
            out[i] = self._long(words[i])
        p = 1
        while p <= bpe.LONG:
            group = np.flatnonzero((length > p // 2) & (length <= p))
            for k in range(0, len(group), bpe.ROWS):
                part = group[k:k + bpe.ROWS]
                part = part[np.argsort(-length[part], kind="stable")]      # rows still going come first
                flat = np.frombuffer(b"".join(words[i].ljust(p, b"\0") for i in part), np.uint8)
                counts = self._group(flat.reshape(-1, p).astype(np.int64), length[part])
                for row, i in enumerate(part):
                    out[i] = counts[row, 1:length[i] + 1]
            p *= 2
        return out

    def _group(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        w, p = data.shape
        last = np.full((w, p + 1), -1, dtype=np.int64)
        count = np.zeros((w, p + 1), dtype=np.int32)
        for i in range(1, p + 1):
            n = int(np.searchsorted(-length, -i, side="right"))     # rows of at least i bytes
            rows, node, found = np.arange(n), np.zeros(n, np.int64), []
            for size in range(1, i + 1):
                key = node << 8 | data[rows, i - size]
                at = np.searchsorted(self.edges, key)
                at[at >= len(self.edges)] = 0
                hit = self.edges[at] == key
                rows, node = rows[hit], self.edge_to[at[hit]]
                if not len(rows):
                    break
                token = self.token_at[node]
                is_token = token >= 0
                found.append((size, rows[is_token], token[is_token]))
            open_ = np.ones(n, dtype=bool)
            for size, r, token in reversed(found):
                keep = open_[r]
                r, token = r[keep], token[keep]
                good = self.follows(last[r, i - size], token)
                r, token = r[good], token[good]
                last[r, i], count[r, i], open_[r] = token, count[r, i - size] + 1, False
        return count

    def _long(self, word: bytes) -> np.ndarray:
        n = len(word)
        last, count = [-1] * (n + 1), np.zeros(n + 1, dtype=np.int32)
        child, token_at, checked = self.child, self.token_at, {}
        for i in range(1, n + 1):
            node, found, size = 0, [], 0
            while size < i:
                node = child.get(node << 8 | word[i - size - 1], 0)
                if not node:
                    break
                size += 1
                if token_at[node] >= 0:
                    found.append((size, int(token_at[node])))
            for size, token in reversed(found):
                pair = last[i - size], token
                if pair not in checked:
                    checked[pair] = bool(self.follows(np.array([pair[0]]), np.array([token]))[0])
                if checked[pair]:
                    last[i], count[i] = token, count[i - size] + 1
                    break
        return count[1:]

    # words and texts -------------------------------------------------------

    def learn(self, words) -> list[str]:
        """Memoise the character-prefix counts of words; returns the long
        ones, which the caller drops again."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        fresh = [w for w in words if w not in self.memo]
        data = [w.encode() for w in fresh]
        for w, raw, c in zip(fresh, data, self.byte_prefixes(data), strict=True):
            if len(raw) != len(w):      # counts at the ends of characters only
                b = np.frombuffer(raw, np.uint8)
                c = c[np.append((b[1:] & 0xC0) != 0x80, True)]
            if w in LONG_ENDINGS:       # its first two characters are two words
                c = np.array([1, 2, c[-1]])
            self.memo[w] = bytes(c.tolist()) if len(raw) <= bpe.LONG else c.tolist()
        return [w for w, raw in zip(fresh, data, strict=True) if len(raw) > bpe.LONG]

    def _spread(self, words: list[str], base: int) -> list[int]:
        """Counts of all character prefixes (1 to n) of joined words."""
        get, out, c = self.memo.__getitem__, [], base
        for k, w in enumerate(words):
            own = [c + x for x in get(w)]
            if k and w[0].isspace() and words[k - 1].isspace():
                # the prefix that ends here is one run of white space
                run = words[k - 1] + w[0]
                long = self.learn([run])
                own[0] = c - get(words[k - 1])[-1] + get(run)[-1]
                for x in long:
                    del self.memo[x]
            out += own
            c += get(w)[-1]
        return out

    def prefix_counts(self, text: str) -> list[int]:
        """Exact token counts of all prefixes of 0 to len(text) characters."""
        out, at = [0], 0
        for m in [*(self.cut_special(text) if self.cut_special else ()), None]:
            end = m.start() if m else len(text)
            piece = text[at:end] + (m[0][:-1] if m else "")
            words = self.split(piece)
            long = self.learn(set(words))
            out += self._spread(words, out[-1])
            for w in long:
                del self.memo[w]
            if m:
                at = m.end()
                out.append(out[len(out) - len(m[0])] + 1)
        return out

    def fit(self, words: list[str], counts: list[int], budget: int) -> tuple[int, int]:
        """Longest prefix of at most ``budget`` tokens of a text without
        special tokens: (characters, tokens)."""
        before = list(accumulate(counts, initial=0))
        j = max(0, bisect_right(before, budget) - 3)
        chars, best = sum(map(len, words[:j])), (0, before[j])
        for k, c in enumerate(self._spread(words[j:j + 4], before[j]), 1):
            if c <= budget:
                best = k, c
        return chars + best[0], best[1]


_counters: dict[int, PrefixCounter] = {}


def _counter(spec: str, pattern: str, key: int) -> PrefixCounter:
    if key not in _counters:
        _counters.clear()
        _counters[key] = PrefixCounter(json.loads(spec), pattern)
    return _counters[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_documents(docs: DataFrame, tokenizer_path: str, pattern: str, limit: int) -> DataFrame:
    """Per document: bytes, tokens, whether it has more than ``limit``
    tokens, and the longest prefix of at most ``limit`` tokens (fit_chars,
    fit_tokens)."""
    spec = _read(tokenizer_path)
    key = hash((spec, pattern))
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = _counter(spec, pattern, key)
        get = counter.memo.__getitem__
        for batch in batches:
            column = batch.column(1).fill_null("")
            n_tokens, fit_chars, fit_tokens = [], [], []
            texts = column.to_pylist()
            for k in range(0, len(texts), 256):
                split = [counter.split(t) for t in texts[k:k + 256]]
                long = counter.learn(set().union(*split))
                for t, words in zip(texts[k:k + 256], split, strict=True):
                    if any(s in t for s in counter.special):
                        every = counter.prefix_counts(t)
                        n, chars = every[-1], max(i for i, c in enumerate(every) if c <= limit)
                        tokens = every[chars]
                        counter.learn(set(words))
                    else:
                        counts = [get(w)[-1] for w in words]
                        n = sum(counts)
                        chars, tokens = (len(t), n) if n <= limit else counter.fit(words, counts, limit)
                    n_tokens.append(n)
                    fit_chars.append(chars)
                    fit_tokens.append(tokens)
                for w in long:
                    counter.memo.pop(w, None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(column).cast(pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(fit_chars, pa.int64()),
                 pa.array(fit_tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "fit_tokens"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean, "
                               "fit_chars bigint, fit_tokens bigint")


def prefix_counts(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``prefix_counts array<int>``: the token count of every
    prefix of 0 to n characters, to answer any later budget question."""
    spec = _read(tokenizer_path)
    key = hash((spec, pattern))
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = _counter(spec, pattern, key)
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([counter.prefix_counts(text or "")], pa.list_(pa.int32()))],
                    names=["doc_id", "prefix_counts"])

    return src.mapInArrow(run, f"doc_id {id_type}, prefix_counts array<int>")
