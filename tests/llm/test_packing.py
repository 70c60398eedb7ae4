import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelyard.llm import packing as pk
from parcelyard.llm.bytepair import Encoder
from tests.llm import helpers

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(tokenizer):
    rng = random.Random(1)
    signs = " \n\t a\u00e9bC1\u00b2\u00bd.,!'\u00a0\u0085\u001c\u0107\u00df\u0436\u65e5s"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["it's we'll 'tis", "x<|endoftext|>y", "", " ", "a" * 9000, " " * 9000, helpers.words(rng, 3000)]
    with open(PATH, encoding="utf-8") as file:
        encoder = Encoder(file.read(), most_words=200)
    for at in range(0, len(texts), 400):
        part = texts[at : at + 400]
        ids, counts = encoder.encode(part)
        found = np.split(ids, np.cumsum(counts)[:-1])
        for text, got in zip(part, found):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_pieces_fill_sequences_without_gaps(spark, tokenizer):
    rows = helpers.odd_rows()
    df = helpers.documents(spark, rows).select("doc_id", "text", F.lit(1).alias("start"))
    pieces = pk.cut_pieces(df.drop("start"), PATH)
    placed = pk.place_pieces(pieces.withColumn("crc", F.crc32("ids")), group=64).collect()
    by_doc = defaultdict(list)
    for r in placed:
        by_doc[r["doc_id"]].append(r)
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for k, t in rows if k not in (None, 10, 11)}
    for k, want in ids.items():
        parts = sorted(by_doc[k], key=lambda r: r["piece"])
        got = [np.frombuffer(r["ids"], "<u4") for r in parts]
        assert np.concatenate(got).tolist() == want
        assert [r["start"] for r in parts] == np.cumsum([0, *map(len, got[:-1])]).tolist()
        assert all(len(x) == 1024 for x in got[1:]) and 1 <= len(got[0]) <= 1024
        assert len(parts) == -(-len(want) // 1024)
        assert [r["crc"] for r in parts] == [zlib.crc32(x.astype("<u4").tobytes()) for x in got]
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert pk.place_pieces(pk.cut_pieces(helpers.documents(spark, []), PATH)).count() == 0
    assert pk.cut_pieces(df, PATH).columns == ["doc_id", "piece", "start", "length", "ids"]


def _direct(lengths, size):
    """The rule as stated: try every open gap and a new sequence, take the least sum."""
    gaps = []
    for n in lengths:
        def total(after):
            count = defaultdict(int)
            for g in after:
                if g:
                    count[g] += 1
            return sum(c * c for c in count.values())

        options = [(total([*gaps[:i], g - n, *gaps[i + 1 :]]), 0, g - n, i) for i, g in enumerate(gaps) if g >= n]
        options.append((total([*gaps, size - n]), 1, size - n, None))
        _, _, left, i = min(options, key=lambda o: o[:3])
        if i is None:
            gaps.append(left)
        else:
            gaps[i] = left
    return sorted(gaps)


def test_sum_of_squares_rule():
    rng = random.Random(3)
    for _ in range(30):
        size = rng.randrange(5, 30)
        lengths = [rng.randrange(1, size + 1) for _ in range(60)]
        opened = pk.OpenSequences(size)
        fill = defaultdict(int)
        for n in lengths:
            sequence, offset = opened.place(n)
            assert offset == fill[sequence]
            fill[sequence] += n
        assert sorted(size - x for x in fill.values()) == _direct(lengths, size)


def test_few_sequences():
    rng = random.Random(4)
    lengths = [min(1024, int(rng.lognormvariate(5.5, 1)) + 1) for _ in range(20000)]
    opened = pk.OpenSequences()
    for n in sorted(lengths, key=lambda n: -max(n, 512)):
        opened.place(n)
    assert opened.made <= 1.005 * sum(lengths) / 1024 + 1


def test_groups_hold_no_ids(spark):
    rows = [(i % 7, " ".join(["word"] * (i % 40))) for i in range(60)]
    pieces = pk.cut_pieces(helpers.documents(spark, rows).select("doc_id", "text"), PATH, size=16)
    placed = pk.place_pieces(pieces, size=16, group=25)
    assert placed.columns == [*pieces.columns, "sequence_id", "offset"]
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    packed = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert len(packed) == 1 and "ids#" not in packed[0]
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"]))
    assert sorted(map(key, placed.collect())) == sorted(map(key, pieces.collect()))
