import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from parcelyard.llm import attention as at
from parcelyard.llm import lm_scoring as lm
from tests.llm import helpers

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def _base(rows):
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0 for k, _ in rows]
    tokens = [[*_words(t), None] for _, t in rows]
    counts = Counter(w for h, ws in zip(held, tokens) if not h for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for h, ws in zip(held, tokens):
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        out.append((h, len(ws), sum(counts[w] > 0 for w in ws), total, round(score, 6)))
    return out


@pytest.mark.parametrize("frequent", [1 << 18, 5])
def test_base_scores_equal_brute_force(spark, frequent):
    rows = helpers.odd_rows() + [(700 + i, f"Ä Ünique{i} A\x0bB\x85c THE the") for i in range(30)]
    df = helpers.documents(spark, rows).withColumnsRenamed({"lang": "score", "source": "row"})
    found = lm.score_texts(df, PATH, frequent=frequent).collect()
    got = [(r["doc"], (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))) for r in found]
    want = [(k, x) for (k, _), x in zip(rows, _base(rows))]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_empty_table_and_no_training_texts(spark):
    assert lm.score_texts(helpers.documents(spark, []), PATH).count() == 0
    key = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    (row,) = lm.score_texts(helpers.documents(spark, [(key, "a b")]), PATH).collect()
    assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0 and row["n_tokens"] == 3
    assert math.isfinite(row["score"]) and math.isfinite(row["base_score"])


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    weights = {n: w.astype(np.float64) for n, w in at.initial(np.full(at.CLASSES, 1 / at.CLASSES)).items()}
    x = rng.integers(0, at.BUCKETS, (3, at.WINDOW))
    x[0, :5], x[0, 5] = at.PAD, at.START
    y = rng.integers(0, at.CLASSES, x.shape)
    y[0, :5] = -1
    _, gradient = at.loss_and_gradient(weights, x, y)
    for name in at.SHAPES:
        spot = tuple(rng.integers(0, n) for n in weights[name].shape)
        if name == "inputs":
            spot = (int(x[1, 4]), 3)
        weights[name][spot] += 1e-5
        high, _ = at.loss_and_gradient(weights, x, y)
        weights[name][spot] -= 2e-5
        low, _ = at.loss_and_gradient(weights, x, y)
        weights[name][spot] += 1e-5
        assert gradient[name][spot] == pytest.approx((high - low) / 2e-5, rel=1e-2, abs=1e-8)


@pytest.mark.parametrize("size", [1, 40])
def test_windows_score_every_token_once(size):
    rng = np.random.default_rng(1)
    weights = at.initial(np.full(at.CLASSES, 1 / at.CLASSES))
    weights["inputs"] *= np.float32(size)
    scorer = at.Scorer(weights, 3)
    assert scorer.tame_scores == (size == 1)
    counts = np.array([1, 70, 2 * at.BLOCK, 2 * at.BLOCK + 1, 5])
    ids, classes = rng.integers(0, lm.IDS, counts.sum()), rng.integers(0, at.CLASSES, counts.sum())
    got = scorer.score(ids, classes, counts)
    first = 0
    for n in counts:
        inputs = np.concatenate([[at.START], at.bucket(ids[first : first + n - 1])])
        for i in range(n):
            seen = inputs[max(0, i // at.BLOCK - 1) * at.BLOCK : i + 1]
            x, y = np.full((1, at.WINDOW), at.PAD), np.full((1, at.WINDOW), -1)
            x[0, : len(seen)], y[0, len(seen) - 1] = seen, classes[first + i]
            loss, _ = at.loss_and_gradient(weights, x, y)
            assert got[first + i] == pytest.approx(-loss / math.log(10), abs=1e-4, rel=1e-3)
        first += n


def test_class_shares_are_probabilities():
    counts = np.random.default_rng(2).zipf(1.3, lm.IDS)
    classes, shares, total = lm.class_table(counts)
    assert np.allclose(np.bincount(classes, 10**shares, at.CLASSES)[np.unique(classes)], 1)
    assert total.sum() == pytest.approx(1) and classes.max() < at.CLASSES


def _paired_documents(spark, n=1500):
    rng = random.Random(3)
    pairs = {w: rng.choice("abcdefghij") * 3 for w in "klmnopqrst"}
    make = lambda: " ".join(x for w in rng.choices(list(pairs), k=60) for x in (w * 3, pairs[w]))
    return helpers.documents(spark, [(i, make()) for i in range(n)])


def _held_out_score(df):
    return lm.score_texts(df, PATH).filter("held_out").agg({"score": "sum"}).first()[0]


def test_training_beats_the_counts_alone_whatever_the_layout(spark, monkeypatch):
    df = _paired_documents(spark)
    monkeypatch.setattr(lm, "SHARD_IDS", 40_000)
    found = [_held_out_score(df.repartition(files)) for files in (1, 8, 64)]
    found.append(_held_out_score(df.repartition(5).orderBy(F.desc("doc_id"))))
    assert found == pytest.approx([found[0]] * 4, rel=1e-6)
    monkeypatch.setattr(lm, "RATE", 0.0)
    assert found[0] > 0.75 * _held_out_score(df)


def test_rounds_repeat_the_shards_of_a_small_corpus(spark, monkeypatch):
    df = _paired_documents(spark, 150)
    one = _held_out_score(df)
    monkeypatch.setattr(lm, "ROUNDS", 1)
    assert one > 0.95 * _held_out_score(df)


@pytest.mark.parametrize("shards, parts", [(1, 1), (7, 3)])
def test_pieces_hold_every_id_once_behind_the_one_before(spark, monkeypatch, shards, parts):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(lm, "PIECE_IDS", 64)
    texts = [rng.integers(0, lm.IDS, n).astype("<u2") for n in (1, 64 * 3 + 7, 64, 65, 2, 32, 33)]
    texts += [texts[1], texts[1]]
    rows = [(i if i < 8 else 1, bytearray(t.tobytes())) for i, t in enumerate(texts)]
    learned = spark.createDataFrame([*rows, (None, rows[1][1])], "doc long, ids binary")
    texts.append(texts[1])
    classes = rng.integers(0, at.CLASSES, lm.IDS)
    got, used = Counter(), set()
    for row in lm.dealt_pieces(learned, shards, parts).collect():
        assert row["part"] == row["shard"] % parts and 0 <= row["shard"] < shards
        used.add(row["shard"])
        ids = np.frombuffer(row["ids"], "<u2")
        inputs, targets = lm.training_arrays(ids, np.array([len(ids)]), classes)
        real = targets >= 0
        assert ((inputs != at.PAD) == real).all()
        got.update(zip(inputs[real].tolist(), targets[real].tolist()))
    want = Counter()
    for t in texts:
        before = [at.START, *at.bucket(t[:-1]).tolist()]
        want.update(zip(before, classes[t].tolist()))
    assert got == want and len(used) > shards // 2


def test_several_pieces_fill_windows_like_each_alone():
    rng = np.random.default_rng(8)
    classes = rng.integers(0, at.CLASSES, lm.IDS)
    pieces = [rng.integers(0, lm.IDS, n).astype("<u2") for n in (2, 33, 34, 100)]
    alone = [lm.training_arrays(p, np.array([len(p)]), classes) for p in pieces]
    both = lm.training_arrays(np.concatenate(pieces), np.array([len(p) for p in pieces]), classes)
    for i in range(2):
        assert (both[i] == np.concatenate([a[i] for a in alone])).all()


def test_trainer_takes_the_same_steps_however_windows_arrive():
    rng = np.random.default_rng(9)
    start = at.initial(np.full(at.CLASSES, 1 / at.CLASSES))
    x = rng.integers(0, at.BUCKETS, (37, at.WINDOW)).astype(np.int32)
    y = rng.integers(0, at.CLASSES, x.shape)
    whole, parts = at.Trainer(start, 8), at.Trainer(start, 8)
    whole.add(x, y)
    for a, b in ((0, 3), (3, 20), (20, 21), (21, 37)):
        parts.add(x[a:b], y[a:b])
    assert (whole.summed() == parts.summed()).all() and whole.steps == parts.steps == 5
