import random
import re
from collections import Counter

import pytest

from routeweave.llm import op8_quality
from routeweave.llm.op8_quality import quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def texts():
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "b", "cé", "#x*", "|", "🙂d", "\x1c", " ", "<p>"])
    sep = lambda: rng.choice([" ", " ", "\n", "\t", "\r\n", "\x0b", "  "])
    out = [None, "", " ", "\n\n", "a", "a b", " a b c ", "x y z " * 400, "aaa " * 5000]
    return out + ["".join(word() + sep() for _ in range(rng.choice([2, 5, 30, 200]))) for _ in range(150)]


def test_base_measures(spark):
    rows = [(i if i % 9 else None, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "s", "clash") for i, t in enumerate(texts())]
    got = quality(spark.createDataFrame(rows + rows[3:5], SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == \
        sorted((str(r[0]), *brute(r[1])) for r in rows + rows[3:5])
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("small", [0, 10_000])
def test_thresholds_follow_the_group(spark, monkeypatch, small):
    monkeypatch.setattr(op8_quality, "SMALL_GROUP", small)
    rng = random.Random(8)
    plain = lambda mark: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) + mark for _ in range(80))
    rows = [(i, plain(""), "en", "a", "") for i in range(60)] + [(100 + i, plain("##"), "xx", "b", "") for i in range(60)]
    rows += [(200, plain("***"), "en", "a", ""), (201, plain("##"), "en", "a", ""), (202, plain("#####"), "xx", "b", "")]
    got = {r.doc_id: r for r in quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {d for d, r in got.items() if not r.kept} == {200, 201, 202}
    assert got[200].failed_rules == "symbol_rate"


SCHEMA_OF_RATES = "lang string, source string, n_words bigint, symbol_rate double, dup_line_rate double, repeat_rate double, word_length double"


def test_thresholds_change_little_by_one_document(spark):
    limits = []
    for n in (199, 200, 201):
        rows = [("en", "hot", 80, *[0.0] * 4)] * 900 + [("en", "own", 80, *[1.0] * 4)] * n
        found = op8_quality.thresholds(spark.createDataFrame(rows, SCHEMA_OF_RATES)).filter("source = 'own'").collect()
        limits.append(found[0].middle_symbol_rate)
    assert max(limits) - min(limits) < 0.01 and 0.4 < limits[1] < 0.6


def test_quartiles_are_true_to_the_width_of_a_bin(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["en", None]), rng.choice(["a", "b", None]), 80, *[rng.choice([0.0, rng.random() ** 3 * 50]) for _ in range(4)]) for _ in range(3000)]
    found = op8_quality.quartiles(op8_quality.sketches(spark.createDataFrame(rows, SCHEMA_OF_RATES).repartition(7)), ["lang", "source"]).collect()
    assert len(found) == 2 * 3 * 4
    for r in found:
        k = 3 + list(op8_quality.UNITS).index(r.rate)
        x = sorted(row[k] for row in rows if row[:2] == (r.lang, r.source))
        assert r.n == len(x)
        for q in (1, 2, 3):
            true = x[-(-q * len(x) // 4) - 1]
            assert abs(r[f"q{q}"] - true) <= 0.0101 * true


def test_verdicts_repeat(spark):
    rows = [(i, t, "en", "s", "") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA)
    first = sorted(map(str, quality(df).collect()))
    assert all(sorted(map(str, quality(df.repartition(n)).collect())) == first for n in (1, 6))


def test_plan_is_native(spark):
    df = quality(spark.createDataFrame([(1, "a", "en", "s", "")], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
