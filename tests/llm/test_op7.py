import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from routeweave.llm.op7_language import Trees, _gram_codes, identify
from routeweave.llm.textbytes import pieces

SF = "/root/testdata/sf0.01/documents.parquet"


def brute_bits(train: list[bytes], text: bytes) -> float:
    """Code length by dictionaries of contexts, escape method C."""
    tree = defaultdict(Counter)
    for t in train:
        s = [0, 0, 0] + [b + 1 for b in t]
        for i in range(3, len(s)):
            for k in range(4):
                tree[tuple(s[i - k:i])][s[i]] += 1
    bits, s = 0.0, [0, 0, 0] + [b + 1 for b in text]
    for i in range(3, len(s)):
        for k in range(3, -1, -1):
            c = tree.get(tuple(s[i - k:i]))
            if not c:
                continue
            total = sum(c.values()) + len(c)
            if s[i] in c:
                bits -= math.log2(c[s[i]] / total)
                break
            bits -= math.log2(len(c) / total)
        else:
            bits += math.log2(257)
    return bits


def test_code_lengths_against_dictionaries():
    corpora = [["the cat is on the mat", "then they thanked the other"], ["der hund ist da", "die ände der straße"]]

    def grams(texts):
        (_, _, v, o), = pieces(pa.array(texts))
        return np.unique(_gram_codes(v, o), return_counts=True)

    trees = Trees(["en", "de"], [grams(x) for x in corpora])
    texts = ["the", "straße!", "", "zzz 中", "on the land der"]
    (_, _, v, o), = pieces(pa.array(texts))
    got = trees.lengths(v, o)
    want = [[brute_bits([t.encode() for t in c], x.encode()) for c in corpora] for x in texts]
    # bytes unseen in any sample share one symbol, as in the trees
    assert np.allclose(got, want, rtol=1e-4), (got, want)


def test_held_out_accuracy(spark):
    df = spark.read.parquet(SF)
    got = identify(df).join(df.select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and len(got) == df.count()


def test_special_rows(spark, docs):
    df = docs([(1, None), (2, ""), (3, "123 !"), (4, "日本"), (None, "abc"), (5, "x")])
    assert {r.lang_pred for r in identify(df).collect()} == {"und"}        # nothing labelled
    lab = spark.createDataFrame([(i, t, lang) for i, t, lang in [
        (0, "the other thing", "en"), (2, "die katze", "de"), (6, None, "fr"), (None, "the", None), (7, "123", "en"), (7, "日", None)]],
        "doc_id bigint, text string, lang string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify(lab).collect()]
    assert len(got) == 6 and (6, "und", 0.0) in got
    assert {x[1] for x in got if x[0] == 7} <= {"und", "en", "de"}
    assert identify(docs([])).collect() == []
