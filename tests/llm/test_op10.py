import json
import random

import public_tokenizers as P
import pytest

from routeweave.llm.op10_token_counts import PrefixCounter, count_documents, prefix_counts

FILE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def truth():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(json.load(open(FILE)), P.PATTERN)


def n_tokens(truth, text):
    return len(truth.encode(text, add_special_tokens=False).ids)


def texts():
    rng = random.Random(9)
    letters = "ab  \n\t'strevel1290.,!éß中🙂́"
    out = ["", " ", "it's  we'll 'rea 're x", "a!<|endoftext|>  \n b", "  <|endoftext|><|endoftext|>", "a <|endof", "x" * 200, " " * 90]
    out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    return out + ["".join(rng.choice("thereationing ") for _ in range(80)) for _ in range(30)]


def test_every_prefix(counter, truth):
    for t in texts():
        assert counter.prefix_counts(t) == [n_tokens(truth, t[:i]) for i in range(len(t) + 1)], t


def test_all_code_points(counter, truth):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(chars), 8192):
        text = " x".join(chars[k:k + 8192])
        assert counter.prefix_counts(text)[-1] == n_tokens(truth, text)


def test_table(spark, docs, truth):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("thereationing .\n") for _ in range(rng.choice([5, 60, 3000])))) for i in range(60)]
    rows += [(70, None), (71, ""), (None, "x"), (3, "again"), (72, "word " * 600 + "<|endoftext|>" + "é " * 300)]
    rows += [(73, "".join(rng.choice(" \n'rel") for _ in range(2000)))]
    got = count_documents(docs(rows), FILE, P.PATTERN, 512).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_bytes): r for r in got}
    for i, t in rows:
        r, t = by[i, len((t or "").encode())], t or ""
        assert r.n_tokens == n_tokens(truth, t) and r.over_limit == (r.n_tokens > 512)
        assert r.fit_tokens == n_tokens(truth, t[:r.fit_chars]) <= 512
        assert all(n_tokens(truth, t[:k]) > 512 for k in range(r.fit_chars + 1, min(len(t), r.fit_chars + 12) + 1))
    one = prefix_counts(docs(rows[:3]), FILE, P.PATTERN).collect()
    assert [len(r.prefix_counts) for r in one] == [len(t) + 1 for _, t in rows[:3]]
    assert count_documents(docs([]), FILE, P.PATTERN, 512).collect() == []
