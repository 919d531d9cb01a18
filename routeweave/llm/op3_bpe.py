"""Byte-level BPE encoding and decoding.

Each match of the splitting pattern is a word.  A segment tree over the
word's byte positions keeps, at its root, the leftmost pair of least rank;
a merge kills one position and updates three leaves (the merged position,
the dead one and the live neighbour before), each in logarithmic time.
Trees of many words run side by side as array rows; words over
``bpe.LONG`` bytes run alone on the same tree.  Words met before come from a
bounded per-worker memo.

Results for special inputs: a null text is the empty text (no ids, digests
of the empty string); repeated rows give repeated results; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from routeweave.llm import bpe

MEMO_BYTES = 150 << 20      # memory bound of a worker's memo, not of the work
ENTRY_BYTES = 400           # of an entry, besides some bytes for each of its word


class Codec:
    """Encoder and decoder for one rank file (lines: base64 bytes, rank)."""

    def __init__(self, lines: list[bytes], pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.first_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.merges = bpe.Merges(*zip(*pairs, strict=True))
        self.memo: dict[str, tuple[str, bytes, bytes]] = {}
        self.memo_bytes = 0

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        return [i for ids in bpe.encode_words(self.merges, self.first_id, [w.encode() for w in words]) for i in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def learn(self, split: list[list[str]]) -> None:
        """Fill the memo with the words of some texts: (ids as text, the
        bytes that the ids decode to, ids as 32-bit integers)."""
        if self.memo_bytes > MEMO_BYTES:
            self.memo.clear()
            self.memo_bytes = 0
        fresh = list(set().union(*split).difference(self.memo))
        ids = bpe.encode_words(self.merges, self.first_id, [w.encode() for w in fresh])
        for w, x in zip(fresh, ids, strict=True):
            self.memo[w] = " ".join(map(str, x)), self.decode(x), array("i", x).tobytes()
            self.memo_bytes += ENTRY_BYTES + 16 * len(w)


_codecs: dict[int, Codec] = {}


def _codec(lines: list[bytes], pattern: str, key: int) -> Codec:
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(lines, pattern)
    return _codecs[key]


def _groups(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    """Consecutive texts of about ``limit`` characters together."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _read(path: str) -> list[bytes]:
    with open(path, "rb") as f:
        return f.readlines()


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Token ids of every text: ``id_col``, the columns of ``keep``,
    ``token_ids array<int>`` and ``n_tokens``.

    The rank file is read once on the driver and travels with the task
    closure: a vocabulary is of fixed size, independent of the corpus.
    """
    lines = _read(ranks_path)
    key = hash((pattern, *lines))
    src = docs.select(id_col, text_col, *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.drop(text_col).schema)

    def run(batches):
        codec = _codec(lines, pattern, key)
        for batch in batches:
            at, rest = 0, batch.drop_columns([text_col])
            for group in _groups([t or "" for t in batch.column(text_col).to_pylist()]):
                split = [codec.split(t) for t in group]
                codec.learn(split)
                get = codec.memo.__getitem__
                ids = [np.frombuffer(b"".join([get(w)[2] for w in words]), np.int32) for words in split]
                sizes = np.array([len(x) for x in ids], dtype=np.int64)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                                                 pa.array(np.concatenate(ids), pa.int32()))
                part = rest.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(sizes)],
                                                 names=[*part.schema.names, "token_ids", "n_tokens"])
                at += len(group)

    return src.mapInArrow(run, f"{fields}, token_ids array<int>, n_tokens bigint")


def decode_documents(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Texts of token ids: ``id_col`` and ``text`` as bytes (a cut list of ids
    need not be valid UTF-8).  Null ids decode to null."""
    lines = _read(ranks_path)
    src = encoded.select(id_col, ids_col)
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches):
        codec = _codec(lines, "", hash(("", *lines)))
        for batch in batches:
            out = [None if x is None else codec.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, "text"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, text binary")


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids and digest of what the
    ids decode to, without writing the ids."""
    lines = _read(ranks_path)
    key = hash((pattern, *lines))
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = _codec(lines, pattern, key)
        sha = hashlib.sha256
        for batch in batches:
            n, ids, back = [], [], []
            for group in _groups([t or "" for t in batch.column(1).to_pylist()]):
                split = [codec.split(t) for t in group]
                codec.learn(split)
                get = codec.memo.__getitem__
                for words in split:
                    pairs = [get(w) for w in words]
                    s = " ".join([p[0] for p in pairs])
                    n.append(s.count(" ") + 1 if s else 0)
                    ids.append(sha(s.encode()).hexdigest())
                    back.append(sha(b"".join([p[1] for p in pairs])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
