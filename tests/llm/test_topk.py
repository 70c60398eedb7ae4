import math
import random

from pyspark.sql import functions as F

from parcelyard.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, k=5, every=5):
    usable = []
    for key, v in rows:
        if key is None or v is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        import numpy as np

        usable.append((key, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for q, v in usable:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in usable if c != q)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores)]
    return sorted(out)


def _got(spark, rows, **options):
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA).withColumnRenamed("label", "score")
    return sorted(tuple(r) for r in topk.top_products(df, F.col("vec_id") % 5 == 0, **options).collect())


def test_results_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1 + i % 7) for _ in range(9)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]
    rows += [(400 + i, [0.25] * 9) for i in range(60)]
    rows += [(None, [1.0] * 9), (900, None), (901, [1.0, None] + [0.0] * 7), (905, [float("nan")] * 9)]
    rows += [(910, [float("inf")] + [0.0] * 8), (915, [])]
    want = _brute(rows)
    assert _got(spark, rows) == want
    assert _got(spark, rows, head=16, block=20, chunk=7) == want


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert _got(spark, rows) == _brute(rows)
    assert _got(spark, [(5, [1.0])]) == []
    assert _got(spark, []) == []
    assert _got(spark, [(5, [1.0]), (5, [1.0]), (6, [2.0])]) == [(5, 1, 6, 256 * 512)]


def test_far_away_norms_are_skipped_but_signs_matter(spark):
    rows = [(i, [(-1.0) ** i * 2.0 ** (i % 12), 1.0, 0.0]) for i in range(200)]
    assert _got(spark, rows, head=8, block=16, chunk=4) == _brute(rows)
