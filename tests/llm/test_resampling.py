import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from parcelyard.llm import interning as it
from parcelyard.llm import resampling as rs
from tests.llm import helpers

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _features(text):
    w = WORD.findall(_lower(text))
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def _bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def _expected(rows, target):
    s = Counter(_bucket(f) for _, t in rows for f in _features(t))
    t = Counter(_bucket(f) for x in target for f in _features(x))
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))

    out = []
    for k, text in rows:
        found = _features(text)
        weight = sum(gain(_bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((k, len(WORD.findall(_lower(text))), len(found), weight, weight + noise))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, [(r[0], r[4]) for r in able[: 5 * len(able) // 100]]


def test_equals_brute_force(spark):
    rows = helpers.odd_rows()
    rows += [(300 + i, "MiXed Ünï-CODÉ x1 日本 " + helpers.words(random.Random(i), 15 + i)) for i in range(80)]
    rows += [(400, "z" * 5000 + " " + "ab " * 3000), (401, "a\x7fb\x00c`d{e 0/9:")]
    target = [helpers.words(random.Random(9), 100, 100), None, "", "mixed x1 x1"]
    want, drawn = _expected(rows, target)
    docs = helpers.documents(spark, rows).repartition(5)
    aims = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    for size in (1 << 20, 700):  # the second cuts most texts into parts
        found = rs.resample(docs, aims, piece_bytes=size).collect()
        got = Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in found)
        assert got == Counter(want)
        ranks = sorted((r.rank, r.doc_id, r.score) for r in found if r["rank"] is not None)
        assert [(k, s) for _, k, s in ranks] == drawn
        assert [n for n, _, _ in ranks] == list(range(1, len(drawn) + 1))


def test_hashes_and_checksums_equal_the_libraries():
    rng = random.Random(2)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(70), 500, 5000, 0, 31, 32]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array([len(t) for t in texts])
    begin = np.cumsum(length) - length
    got = it.hashes(data, it._lanes(data), begin, length)
    assert got.tolist() == [xxhash.xxh64_intdigest(t) for t in texts]
    crc = it.crcs(data, begin, length)
    assert crc.tolist() == [zlib.crc32(t) for t in texts]
    joined = it.joined_crc(crc[:-1], crc[1:], length[1:])
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in zip(texts, texts[1:])]


def test_bytes_tell_colliding_keys_apart(monkeypatch):
    monkeypatch.setattr(it, "hashes", lambda data, lanes, begin, length: np.zeros(len(begin), np.uint64))
    text = b"aa ab aa abc ab aa ab"
    found = it.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    grams = it.intern(found, 2, 10000, np.zeros(1, np.int64))
    want = Counter(_features(text.decode()))
    want = {k: v for k, v in want.items() if k.count(" ") < 2}
    assert sorted(grams.count[grams.count > 0]) == sorted(want.values())
    assert Counter(grams.bucket[grams.slot].tolist()) == Counter(
        b for k, v in want.items() for b in [_bucket(k)] * v
    )


def test_ranks_over_many_ranges(spark):
    rows = [(i, i * 7919 % 1000 // 10, i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "id long, score long, at long").repartition(6)
    got = sorted((r["rank"], -r.score, r.id) for r in rs._ranked(frame).collect())
    assert [x[0] for x in got] == list(range(1, 1001))
    assert [x[1:] for x in got] == sorted((-s, k) for k, s, _ in rows)


def test_odd_tables(spark):
    docs, aims = helpers.documents(spark, []), spark.createDataFrame([], "item_id int, text string")
    assert rs.resample(docs, aims).count() == 0
    rows = [(i, helpers.words(random.Random(i), 30)) for i in range(40)]
    clash = helpers.documents(spark, rows).select(
        "doc_id", "text", *[F.lit(-1).alias(c) for c in ("id", "at", "place", "part", "row", "score", "a.b")]
    )
    found = rs.resample(clash, aims)
    assert found.columns == ["doc_id", "id", "at", "place", "part", "row", "a.b", *rs.COLUMNS]
    assert found.filter("`a.b` <> -1 OR id <> -1").count() == 0 and found.filter("rank IS NOT NULL").count() == 2
