import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelyard.llm import mixing as mx
from tests.llm import helpers


def _members(spark, rows):
    return spark.createDataFrame(
        [(i, i, n, p) for i, (n, p) in enumerate(rows)], "doc long, version long, n_tokens long, posterior array<double>"
    )


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(3) * 0.5, 400)
    n = rng.integers(1, 500, 400)
    rated, reached, aim = mx.fit_rates(_members(spark, list(zip(n.tolist(), p.tolist()))), [0.5, 0.3, 0.2])
    rows = rated.collect()
    rate = np.array([r["rate"] for r in rows])
    t = np.array([r["n_tokens"] for r in rows])
    post = np.array([list(r["posterior"]) for r in rows])
    totals = (rate * t) @ post
    assert np.allclose(totals, reached)
    assert np.abs(totals - np.array([0.5, 0.3, 0.2]) * n.sum()).max() <= 1.1e-3 * n.sum()
    assert rate.min() >= 0


def test_a_rare_domain_reaches_its_target(spark):
    rng = np.random.default_rng(5)
    p = np.where(rng.random(2000)[:, None] < 0.03, [0.05, 0.95], [0.995, 0.005])
    members = _members(spark, list(zip(rng.integers(50, 400, 2000).tolist(), p.tolist())))
    _, reached, aim = mx.fit_rates(members, [0.6, 0.4])
    assert np.abs(np.array(reached) - aim).max() <= 1.1e-3 * sum(aim)
    with pytest.warns(UserWarning, match="miss their targets"):
        rated, reached, aim = mx.fit_rates(members, [0.6, 0.4], most_rate=4.0)
    assert reached[1] < 0.9 * aim[1] and rated.agg({"rate": "max"}).first()[0] <= 4


def test_texts_of_another_column(spark):
    rows = [(i, f"{'good' if i % 2 else 'bad'} words {i % 7}") for i in range(60)]
    docs = helpers.documents(spark, rows).withColumnRenamed("text", "body").withColumn("text", F.lit("same"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    texts, domains = mx.labelled_texts(docs, labels, text="body")
    assert set(zip(texts, domains)) == {(t, 2 * (i % 2)) for i, t in rows}
    found = mx.mix(docs, labels, text="body").collect()
    assert all((np.argmax(r["posterior"]) == 2) == bool(r["doc"] % 2) for r in found)


def test_projected_steps_equal_a_direct_computation(spark):
    n = np.array([10, 1000, 20, 5])
    p = np.array([[1, 0], [0.1, 0.9], [0.7, 0.3], [0.2, 0.8]], float)
    aim = np.array([0.9, 0.1])
    rated, reached, _ = mx.fit_rates(_members(spark, list(zip(n.tolist(), p.tolist()))), aim, most_rounds=6, most_rate=None)
    a = n[:, None] * p
    gram = a.T @ a
    inverse = np.linalg.pinv(gram + 1e-9 * np.trace(gram) / 2 * np.eye(2))
    rate, ahead = np.ones(4), np.ones(4)
    for k in range(6):
        if np.abs(rate @ a - aim * a.sum()).max() <= 1e-3 * a.sum():
            break
        new = np.maximum(0, ahead - a @ (inverse @ (ahead @ a - aim * a.sum())))
        rate, ahead = new, new + k / (k + 3) * (new - rate)
    assert np.allclose([r["rate"] for r in rated.orderBy("doc").collect()], rate)
    assert np.allclose(rate @ a, reached)


def test_classifier_on_held_out_texts():
    rng = random.Random(1)
    mark = {0: "alpha", 1: "beta", 2: "gamma", 3: "delta"}
    make = lambda k: " ".join(rng.choice([mark[k], *helpers.words(rng, 6).split()]) for _ in range(40))
    texts = [(make(i % 4), i % 4) for i in range(400)]
    weights = mx.fit_classifier([t for t, _ in texts[:300]], [k for _, k in texts[:300]], 4)
    import pyarrow as pa

    held = texts[300:]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(100)), pa.array(range(100)), pa.array([t for t, _ in held])], ["doc", "version", "text"]
    )
    (out,) = mx._posterior_batches([batch], weights)
    found = [int(np.argmax(x)) for x in out.column("posterior").to_pylist()]
    assert np.mean([a == k for a, (_, k) in zip(found, held)]) > 0.95
    assert np.allclose([sum(x) for x in out.column("posterior").to_pylist()], 1)


def test_odd_rows_and_copies(spark):
    rows = helpers.odd_rows()
    df = helpers.documents(spark, rows).withColumnsRenamed({"lang": "rate", "source": "doc"})
    found = mx.mix(df, helpers.labels(spark, rows)).collect()
    assert len(found) == len(rows)
    assert all(r["rate"] == 1 and r["n_tokens"] == 0 and r["n_copies"] == 1 for r in found if r["doc"] in (3, 4, 5))
    assert all(r["n_copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in found)
    out = mx.mixed_documents(df, helpers.labels(spark, rows))
    assert out.columns == df.columns
    assert out.count() == sum(r["n_copies"] for r in found)
    assert mx.mix(helpers.documents(spark, []), helpers.labels(spark, [])).count() == 0
    assert mx.mix(df, helpers.labels(spark, [])).count() == len(rows)


def test_rounds_run_over_whole_batches(spark):
    rows = [(100, [0.9, 0.1]), (50, [0.2, 0.8]), (None, [0.5, 0.5]), (70, None)]
    rated, reached, _ = mx.fit_rates(_members(spark, rows), [0.4, 0.6], most_rounds=30)
    assert "ArrayAggregate" not in rated._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in rated._jdf.queryExecution().optimizedPlan().toString()
    found = rated.orderBy("doc").collect()
    assert rated.columns == ["doc", "version", "n_tokens", "posterior", "rate"]
    assert [r["rate"] for r in found[2:]] == [0.0, 0.0]
    totals = sum(r["rate"] * r["n_tokens"] * np.array(r["posterior"]) for r in found[:2])
    assert np.allclose(totals, reached)
