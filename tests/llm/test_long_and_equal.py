"""Texts longer than what a worker handles at once, and rows given twice."""

import base64
import random
import zlib

import public_tokenizers as P
import pytest

from routeweave.llm import op7_language
from routeweave.llm.op10_token_counts import count_documents
from routeweave.llm.op2_decontaminate import drop_leaks, find_leaks
from routeweave.llm.op3_bpe import encode_documents
from routeweave.llm.op4_lm import score_documents
from routeweave.llm.op6_jaccard import jaccard_components
from routeweave.llm.op7_language import identify
from routeweave.llm.op9_secrets import scan_documents
from tests.llm.test_op2 import brute as leaks
from tests.llm.test_op4 import base_rows
from tests.llm.test_op6 import brute as components
from tests.llm.test_op9 import brute as spans


@pytest.fixture(scope="module")
def long_rows():
    """Over two pieces of 1 MB, with a near copy, and short rows twice."""
    rng = random.Random(8)
    words = ["".join(rng.choice("thaenriosé") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]
    w = [rng.choice(words) for _ in range(380_000)]
    near = list(w)
    near[200_000] = "changed"
    short = " ".join(w[:300])
    rows = [(1, " ".join(w)), (2, " ".join(near)), (3, short), (3, short), (4, 'x token = "0123456789abcdef0123"'), (4, 'x token = "0123456789abcdef0123"')]
    assert len(rows[0][1].encode()) > 2 << 20
    return rows


def test_jaccard(docs, long_rows):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs(long_rows)).collect())
    assert got == components(long_rows, 3, 90) and got[1][2] == 1


def test_decontamination(spark, docs, long_rows):
    w = long_rows[0][1].split()
    items = [(0, " ".join(w[300_000:300_040])), (1, " ".join(w[10:30])), (2, "no such words in any of these texts at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, round(r.similarity, 9), r.start_word) for r in find_leaks(docs(long_rows[2:]), bench).collect())
    assert got == leaks(long_rows[2:], items)
    found = {(r.doc_id, r.item_id, r.start_word) for r in find_leaks(docs(long_rows), bench).filter("similarity = 1").collect()}
    assert {(1, 0, 300_000), (2, 0, 300_000), (1, 1, 10), (2, 1, 10), (3, 1, 10)} <= found
    assert [r.doc_id for r in drop_leaks(docs(long_rows), bench).collect()] == [4, 4]


def test_tokens(docs, long_rows):
    import tiktoken
    from tokenizers import Tokenizer

    file = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(file, "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = encode_documents(docs(long_rows), file, P.PATTERN).collect()
    texts = dict(long_rows)
    assert len(got) == len(long_rows) and all(r.token_ids == own.encode_ordinary(texts[r.doc_id]) for r in got)
    json_file = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(json_file)
    counts = count_documents(docs(long_rows), json_file, P.PATTERN, 512).collect()
    assert len(counts) == len(long_rows)
    assert all(r.n_tokens == len(tok.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in counts)


def test_scores(docs, long_rows):
    got = score_documents(docs(long_rows)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base_rows(long_rows)
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_secrets(docs, long_rows):
    got = scan_documents(docs(long_rows)).collect()
    assert len(got) == len(long_rows)
    assert all(r.n_assign + r.n_hex == len(spans(dict(long_rows)[r.doc_id])) for r in got)
    assert len({r.spans for r in got if r.doc_id == 4}) == 1


def test_languages(spark, long_rows, monkeypatch):
    monkeypatch.setattr(op7_language, "PIECE", 1000)
    rows = [(i, t, "en") for i, t in long_rows] + [(10 + i, "la casa de los niños está", "es") for i in range(9)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"en"}
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 3}) == 1


def test_languages_that_tie_take_the_first_name(spark):
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:18]
    rows = [(i, "the same words", "bac"[k % 3]) for k, i in enumerate(learnt)] + [(100, "the same words", None), (101, "words", None)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} == {"a"} and all(abs(r.score - 1 / 3) < 1e-6 for r in got)
