import hashlib
import random
from collections import Counter

import numpy as np

from parcelyard.llm import suffix_dedup as sd
from tests.llm import helpers


def _brute(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def _texts(rng, length):
    passage = helpers.words(rng, length // 3)
    texts = []
    for _ in range(14):
        a = rng.randrange(len(passage) - length - 5)
        texts.append(helpers.words(rng, 40) + passage[a : a + length + rng.randrange(-3, 40)] + helpers.words(rng, 30))
    texts += [passage + "é" + passage, passage[:length], passage[: length - 1], "ab" * length, "z" * (2 * length)]
    texts += ["\0" * (length + 9), None, "", "é" * length, passage + "x" * length]
    return texts


def _check(spark, texts, length, **options):
    df = helpers.documents(spark, list(enumerate(texts))).withColumnsRenamed({"lang": "kept", "source": "version"})
    got = {}
    for r in sd.cut_repeats(df, length=length, **options).collect():
        gone = sum(s["end"] - s["start"] for s in r["removed"])
        got[r["doc_id"]] = (gone, len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest())
    want = _brute(texts, length)
    assert [got[i] for i in range(len(texts))] == want
    assert any(n for n, _, _ in want)


def test_bytes_equal_brute_force(spark):
    texts = _texts(random.Random(2), 400)
    _check(spark, texts, 400)
    _check(spark, texts, 400, most_windows=2)


def test_copies_and_odd_rows(spark):
    rng = random.Random(3)
    long = helpers.words(rng, 3000, 4000)
    _check(spark, [long, long, long[:700], "x" + long[900:1500], helpers.words(rng, 20)], 400)
    rows = [(7, long), (7, long), (None, long[:500]), (None, None), (8, "short"), (8, "short")]
    got = sd.cut_repeats(helpers.documents(spark, rows)).collect()
    assert sorted(str((r["doc_id"], len(r["kept"]))) for r in got) == sorted(
        str(x) for x in [(7, 0), (7, 0), (None, 0), (None, 0), (8, 5), (8, 5)]
    )
    assert sd.cut_repeats(helpers.documents(spark, [])).count() == 0


def test_anchors_cover_all_starts_and_follow_content():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    anchor, at, low, high = sd.anchors(data, 400)
    assert low[0] == 0 and high[-1] == len(data) - 400 and (low[1:] == high[:-1] + 1).all()
    assert (at >= low).all() and (at + sd.ANCHOR <= high + 400).all() and (at <= low + 400 - sd.ANCHOR).all()
    other = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), data[1000:1400]])
    found, place, first, last = sd.anchors(other, 400)
    k = np.flatnonzero((first <= 333) & (last >= 333))[0]
    j = np.flatnonzero((low <= 1000) & (high >= 1000))[0]
    assert found[k] == anchor[j] and place[k] - 333 == at[j] - 1000


def test_rolling_hashes_name_strings():
    data = np.frombuffer(b"abcabcabdabcabcabd", np.uint8)
    for size in (1, 3, 6, 7):
        found = sd.rolling(data, size)
        strings = [data[i : i + size].tobytes() for i in range(len(data) - size + 1)]
        assert len(set(found.tolist())) == len(set(strings)) and len(found) == len(strings)
