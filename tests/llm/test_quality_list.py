import random
import re

import pytest

from parcelyard.llm import quality_list as ql
from tests.llm import helpers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


def _texts():
    rng = random.Random(1)
    texts = [t for _, t in helpers.odd_rows() if t is None or len(t) < 5000]
    texts += ["a a a a", "a b c a b c", "x\x0by\x0cz\r\nq # ü|< >", "a\n\na\na b", "\n", "a b"]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in range(12)]
    texts += ["\n".join(rng.choice(["a b c", "d", "", " "]) for _ in range(9)) for _ in range(9)]
    return texts


def test_counts_equal_brute_force(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r.asDict() for r in ql.judged(df, []).collect()}
    for k, text in enumerate(texts):
        want = _brute(text)
        assert {c: got[k][c] for c in want} == want, text
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got[k]["base_failed"] == failed and got[k]["kept"] == (not failed)


def test_learned_list_finds_planted_junk_and_keeps_clean_texts(spark):
    rng = random.Random(4)
    clean = [helpers.words(rng, 80, 900) for _ in range(120)]
    junk = [t.replace(" ", "### ") for t in clean[:40]] + [t.upper() for t in clean[40:70]]
    rows = list(enumerate(clean + junk))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k < 120)) for k, _ in rows], "doc_id long, quality int")
    rules = ql.learn(ql.labelled_rows(df, marks))
    assert 1 <= len(rules) <= 6
    got = {r["doc_id"]: r for r in ql.judged(df, rules).collect()}
    assert all(got[k]["kept"] == (k < 120) for k, _ in rows)
    assert all((got[k]["rule"] is None) == (k < 120) for k, _ in rows)
    kept = ql.accepted(df.withColumn("n_words", df.doc_id), rules)
    assert kept.columns == ["doc_id", "text", "n_words"]
    assert {r["doc_id"] for r in kept.collect()} == set(range(120))


def test_rules_are_ordered_and_stop_without_evidence():
    assert ql.learn([]) == []
    row = {n: 0.0 for n in ql.FEATURES}
    assert ql.learn([(row, i % 2 == 0) for i in range(60)]) == []
    rows = [({**row, "symbol_share": i / 300}, i >= 180) for i in range(300)]
    ((condition,),) = ql.learn(rows)
    assert (condition.name, condition.at_least) == ("symbol_share", True)
    assert condition.threshold == pytest.approx(0.6, abs=0.01)
    mixed = [({**row, "symbol_share": i / 300}, i >= 180 and i % 4 != 0) for i in range(300)]
    assert ql.learn(mixed) == []


def test_odd_rows_and_clashing_names(spark):
    rows = helpers.odd_rows()
    df = helpers.documents(spark, rows).withColumnsRenamed({"lang": "kept", "source": "n_words"})
    out = ql.judged(df, []).collect()
    assert len(out) == len(rows)
    assert all(not r["kept"] for r in out if r["doc_id"] in (3, 4, 5, 8))
    assert [r["kept"] for r in out if r["doc_id"] == 10] == [True] * 3
    assert ql.accepted(df, []).columns == df.columns
    assert ql.judged(helpers.documents(spark, []), []).count() == 0
    assert ql.labelled_rows(df, helpers.labels(spark, [])) == []
    assert ql.labelled_rows(df, helpers.labels(spark, rows))
    from tests.helpers import plan

    text = plan(ql.accepted(df, []))
    assert not any(x in text for x in ("EvalPython", "InPandas", "InArrow"))
