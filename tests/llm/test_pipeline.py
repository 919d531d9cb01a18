import random

import public_tokenizers as P
import pytest

import corpus_pipeline
from routeweave.llm.op3_bpe import Codec
from tests.llm.test_op2 import brute as leaks
from tests.llm.test_op6 import brute as groups
from tests.llm.test_op9 import brute as spans

HEXED = "0123456789abcdef0123"


def rows_of(seed=7):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("thaenrios") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([18, 40])]
    rows = []
    for i in range(60):
        t = text(rng.choice([5, 30, 80]))
        if i % 7 == 1:
            t += " " + rng.choice(items)[1]
        if i % 9 == 2:
            t = f'{t} token = "{HEXED}" end'
        rows.append((i, t))
    for i in range(20):
        w = rows[rng.randrange(60)][1].split()
        if len(w) > 25:
            w[0] = "changed"
        rows.append((100 + i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, "12 34!"), (203, "mañana " * 9), rows[3], rows[3], (None, text(30)), (None, rows[5][1])]
    return rows, items


def expected(rows, items):
    rows = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    named = [(d, t) for d, t in rows if d is not None]
    stay = {d for d, _, c in groups(named, 5, 80) if d == c}
    out = {(d, t) for d, t in named if d in stay} | {(d, t) for d, t in rows if d is None and t not in dict(map(reversed, named))}
    bad = {d for d, *_ in leaks(sorted(out, key=str), items)}
    done = set()
    for d, t in out:
        if str(d) not in bad:
            at, parts = 0, []
            for a, _, b in spans(t):
                if a >= at:
                    parts += [t[at:a], "[secret]"]
                at = max(at, b)
            done.add((d, "".join(parts) + t[at:]))
    return done


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows, items = rows_of()
    d = str(tmp_path_factory.mktemp("pipeline"))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, sid string"
    spark.createDataFrame([(i, t, "xx" if k % 3 else None, None if k % 5 else "s", len(t or ""), "e", "f") for k, (i, t) in enumerate(rows)],
                          schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_against_brute_force(spark, sf_dir):
    codec = Codec(open(P.path("byte_bpe_50k.tiktoken"), "rb").readlines(), P.PATTERN)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    want = expected(*rows_of())
    assert sorted((str(r.doc_id), codec.decode(r.token_ids).decode()) for r in got) == sorted((str(d), t) for d, t in want)
    assert all(r.n_tokens == len(r.token_ids) and r.lang == "xx" for r in got)
    assert any("[secret]" in t for _, t in want)


def test_stages_keep_columns_and_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0, name
        assert stage(spark, docs, sf_dir).schema.simpleString() == docs.schema.simpleString(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0
