import base64
import hashlib
import random

import public_tokenizers as P
import pytest

from routeweave.llm.op3_bpe import Codec, decode_documents, encode_digests, encode_documents

FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def truth():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(4)
    out = [None, "", " ", "a", "it's  <|endoftext|>\n\n x", "aaaa" * 700, " " * 333, "\x1c\x1d \x85 　z", "don't 'll 'LL"]
    letters = "ab  \n\t'stre1290.,!éßñ中文🙂́‍"
    out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 400))) for _ in range(150)]
    out += ["".join(rng.choice("thereationing ") for _ in range(600)) for _ in range(30)]
    return out


def test_codec_over_all_code_points(truth):
    codec = Codec(open(FILE, "rb").readlines(), P.PATTERN)
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(chars), 4096):
        text = " x".join(chars[k:k + 4096]) + "".join(chars[k:k + 4096])
        assert codec.encode(text) == truth.encode_ordinary(text)


def test_encode_matches_library_and_decodes_back(spark, docs, truth):
    rows = list(enumerate(texts())) + [(3, "a"), (None, "null id")]
    df = docs(rows)
    got = encode_digests(df, FILE, P.PATTERN).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len(x := truth.encode_ordinary(t or "")),
                   hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == want
    enc = encode_documents(df, FILE, P.PATTERN, keep=("score",))
    back = {r.doc_id: bytes(r.text) for r in decode_documents(enc, FILE).collect()}
    assert all(back[i] == (t or "").encode() for i, t in rows)
    assert {r.doc_id: r.token_ids for r in enc.collect()}[8] == truth.encode_ordinary(rows[8][1])


def test_empty_table(docs):
    assert encode_digests(docs([]), FILE, P.PATTERN).collect() == []
    assert encode_documents(docs([]), FILE, P.PATTERN).collect() == []
