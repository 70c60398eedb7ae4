import random
from itertools import combinations

import numpy as np

from parcelyard.llm import ngram_join as nj
from tests.llm import helpers


def _sets(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _brute(rows):
    texts = {" ".join((t or "").split()) for _, t in rows}
    sets = {t: _sets(t) for t in texts}
    links = {t: 0 for t in texts}
    head = {t: t for t in texts}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in combinations(texts, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            head[find(a)] = find(b)
    least = {}
    copies = {}
    for k, t in rows:
        t = " ".join((t or "").split())
        copies[t] = copies.get(t, 0) + 1
        if k is not None:
            least[find(t)] = min(k, least.get(find(t), k))
    named = lambda t: " ".join((t or "").split())
    return sorted(
        ((k, least.get(find(named(t))), links[named(t)], copies[named(t)]) for k, t in rows),
        key=str,
    )


def _family(rng, n):
    base = helpers.words(rng, 150, 2000).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(999)}"
        out.append(" ".join(w))
    return out


def _got(df, **options):
    found = nj.similar_documents(df, **options).collect()
    return sorted(((r["doc"], r["class_id"], r["n_links"], r["n_copies"]) for r in found), key=str)


def test_links_and_classes_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [t for _ in range(4) for t in _family(rng, 12)] + [helpers.words(rng, 40) for _ in range(20)]
    rows = list(enumerate(texts)) + helpers.odd_rows()[3:]
    df = helpers.documents(spark, rows)
    want = _brute(rows)
    assert any(n > 3 for _, _, n, _ in want)
    assert _got(df) == want
    assert _got(df, block=5) == want


def test_one_row_of_each_class_stays(spark):
    rows = helpers.odd_rows()
    df = helpers.documents(spark, rows).withColumnsRenamed({"lang": "node", "source": "class_id"})
    out = nj.one_per_class(df)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert 0 in dict(got) and 1 not in dict(got) and 2 not in dict(got)
    assert sum(1 for k, t in got if not (t or "").strip()) == 1
    assert len([t for k, t in got if k == 10]) == 2 and len([t for k, t in got if k is None]) == 1
    classes = {r["owner"] for r in nj.similar_documents(df).collect()}
    assert len(got) == len(classes)
    assert nj.one_per_class(helpers.documents(spark, [])).count() == 0


def test_no_pair_above_the_threshold_is_pruned_early():
    least = nj.least_matches()
    rng = np.random.default_rng(0)
    lost = 0
    for _ in range(2000):
        same = rng.random(nj.HASHES) < 0.8
        total = np.cumsum(same)
        lost += any(total[n - 1] < least[n // nj.STEP] for n in range(nj.STEP, nj.HASHES + 1, nj.STEP))
    assert lost == 0
    assert least == sorted(least) and least[-1] > nj.HASHES // 2
