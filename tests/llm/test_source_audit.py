import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from parcelyard.llm import source_audit as sa
from tests.llm import helpers

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _expected(rows, least=10):
    by_lang = defaultdict(lambda: defaultdict(list))
    for lang, source, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        by_lang[lang or ""][source or ""].append(TERM.findall(text))
    out = set()
    for lang, sources in by_lang.items():
        seen = Counter(t for docs in sources.values() for d in docs for t in set(d))
        kept = {t for t, n in seen.items() if n >= least}
        count = {s: Counter(t for d in docs for t in d if t in kept) for s, docs in sources.items()}
        count[None] = sum((c for s, c in count.items()), Counter())
        p = {
            s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
            for s, c in count.items()
        }
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            words = [
                (-f(p[s][t], p[None][t]), t) for t in kept if count[s][t] and p[s][t] > p[None][t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", words, 10)):
                by_bytes = sorted(found, key=lambda x: (x[0], x[1].encode()))
                for n, (v, item) in enumerate(by_bytes[:most], 1):
                    out.add((lang, s, part, item, -v, n))
    return out


def _rows(seed=3):
    rng = random.Random(seed)
    stock = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Äb", "日本", "ZZ", "straße"]
    rows = []
    for i in range(240):
        lang = rng.choice(["en", "en", "en", "de", None, "x/y= %"])
        own = rng.randrange(12)
        words = rng.choices(stock[own * 3 : own * 3 + 25] + stock[-4:], k=rng.randrange(0, 40))
        rows.append((lang, rng.choice([f"s{own}", f"s{own}", None]), "_1 ".join(words)))
    rows += [("rare", "s1", "only a few words"), ("rare", "s2", None), ("solo", "s", "one")]
    rows += [("plain", f"p{i}", f"own{'abcdefghijklmn'[i]}") for i in range(14)]  # no common term
    rows += [("en", "empty", None), ("en", "", "12 34"), ("en", "s0", "wa " * 5000)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)


def _found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(spark):
    rows = _rows()
    found = sa.audit_sources(_frame(spark, rows).withColumn("value", F.lit("clash")))
    assert found.columns == sa.COLUMNS
    assert _found(found) == _expected(rows)


def test_many_blocks(spark, monkeypatch):
    rows = [r for r in _rows(4) if r[0] in ("en", "rare")]
    monkeypatch.setattr(sa, "TERM_BLOCK", 7)
    monkeypatch.setattr(sa, "SOURCE_BLOCK", 4)
    assert _found(sa.audit_sources(_frame(spark, rows))) == _expected(rows)


def test_shares_beyond_64_bits(spark):
    big = 3 * 10**17
    row = spark.range(1).select(
        F.lit(big).alias("c"), F.lit(7 * big).alias("t"), F.lit(1000).cast("long").alias("v")
    )
    got = row.select(sa.share("c", "t", "v").alias("p")).first()["p"]
    assert got == 1 + 10**9 * (big + 2) // (7 * big + 2000)


def test_empty_tables(spark):
    assert sa.audit_sources(_frame(spark, [])).count() == 0
    few = [("en", "a", "x"), ("en", "b", "y")]
    assert _found(sa.audit_sources(_frame(spark, few))) == _expected(few)
    odd = helpers.documents(spark, helpers.odd_rows())
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert _found(sa.audit_sources(odd)) == _expected(rows)


def test_terms_are_counted_by_merged_rows(spark):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(12)
    texts = [helpers.words(rng, 40, 30) for _ in range(60)] + ["", None, "One one ONE two"]
    langs, sources = [rng.randrange(2) for _ in texts], [rng.choice("xyz") for _ in texts]
    batch = pa.record_batch(
        [pa.array(langs, pa.int64()), pa.array(sources), pa.array(texts, pa.string())], names=["n", "source", "text"]
    )
    occurs, within, held = Counter(), Counter(), 0
    for part in sa._term_batches(iter([batch]), 10):
        for n, source, weight, terms in zip(*(part.column(c).to_pylist() for c in ("n", "source", "weight", "terms"))):
            held += len(terms)
            assert len(set(terms)) == len(terms)
            for t in terms:
                if weight:
                    occurs[n, source, t] += weight
                else:
                    within[n, t] += 1
    want, docs = Counter(), Counter()
    for n, source, text in zip(langs, sources, texts):
        found = TERM.findall((text or "").lower())
        want.update((n, source, t) for t in found)
        docs.update((n, t) for t in {"", *found})
    assert occurs == want
    assert within == {k: min(v, 10) for k, v in docs.items()}
    assert held < np.sum(list(want.values()))


def test_pieces_of_a_task_are_merged(monkeypatch):
    import pyarrow as pa

    rng = random.Random(12)
    rows = [(k % 2, f"s{k % 3}", " ".join(f"{chr(97 + i)}{chr(97 + i)}é" for i in rng.choices(range(20), k=30))) for k in range(90)]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows[a : a + 30]], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))],
            names=["n", "source", "text"],
        )
        for a in (0, 30, 60)
    ]
    monkeypatch.setattr(sa, "PIECE_BYTES", 300)
    want, docs = Counter(), Counter()
    for n, source, text in rows:
        want.update((n, source, t) for t in text.split())
        docs.update((n, t) for t in {"", *text.split()})
    for most, bound in ((sa.MOST_CELLS, 10), (50, 10**6)):
        monkeypatch.setattr(sa, "MOST_CELLS", most)
        occurs, within = Counter(), Counter()
        for part in sa._term_batches(iter(batches), 10):
            for r in part.to_pylist():
                assert len(set(r["terms"])) == len(r["terms"])
                if r["weight"]:
                    occurs.update({(r["n"], r["source"], t): r["weight"] for t in r["terms"]})
                else:
                    within.update((r["n"], t) for t in r["terms"])
        assert occurs == want and max(within.values()) <= bound
        assert {k for k, v in within.items() if v >= 10} == {k for k, v in docs.items() if v >= 10}
