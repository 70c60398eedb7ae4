"""Differences by fingerprints equal those by counting all rows."""

import random

import pytest

from parcelyard.operators import compare
from tests.helpers import rows

SCHEMA = "k string, i short, v double, w double"


def _table(seed=1, n=3000):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 0.0, 1.5, rng.random()])
    out = [(rng.choice([None, f"k{rng.randrange(n)}"]), rng.randrange(5), value(), value()) for _ in range(n)]
    return out + out[:50] + [("hot", 1, 2.0, None)] * 500


def _changed(table, seed=2, n=7):
    rng, out = random.Random(seed), list(table)
    for at in rng.sample(range(len(out)), n):
        k, i, v, w = out[at]
        out[at] = rng.choice([(k, i, w, v), (k, i, 9.75, w), (k, i, None, w), (None, i, v, w)])
    return out[3:] + out[100:102]


@pytest.mark.parametrize("change", ["none", "few", "all", "empty"])
def test_equal_to_counting_every_row(spark, change):
    table = _table()
    other = {"none": table[::-1], "few": _changed(table), "all": _table(5), "empty": []}[change]
    left, right = (spark.createDataFrame(t, SCHEMA) for t in (table, other))
    for a, b in ((left, right), (right.repartition(3), left)):
        expected = compare.row_differences(a, b, ["k", "i"], ["v", "w"])
        got = compare.differing_rows(a, b, ["k", "i"], ["v", "w"])
        assert got.columns == expected.columns and rows(got) == rows(expected)
        assert (got.count() == 0) == (change == "none")


def test_nulls_in_other_columns_differ(spark):
    a = spark.createDataFrame([("x", 1, 2.0, None)], SCHEMA)
    b = spark.createDataFrame([("x", 1, None, 2.0)], SCHEMA)
    assert compare.differing_rows(a, b, ["k", "i"], ["v", "w"]).count() == 2


def _shuffled_rows(spark, df):
    """Rows that the plan's shuffles carried in the run that follows."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if name.endswith("QueryStage"):
            return visit(node.plan())
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for k in range(children.size()):
            visit(children.apply(k))

    visit(plan)
    return sum(found)


def test_tables_that_agree_shuffle_sums_only(spark, tmp_path):
    spark.range(0, 200_000).selectExpr("cast(id as string) k", "cast(id % 5 as short) i", "rand(3) v", "rand(4) w").write.parquet(str(tmp_path / "t"))
    left, right = (spark.read.parquet(str(tmp_path / "t")) for _ in range(2))
    whole = _shuffled_rows(spark, compare.row_differences(left, right, ["k", "i"], ["v", "w"]))
    same = compare.differing_rows(left, right, ["k", "i"], ["v", "w"])
    assert whole == 400_000 and _shuffled_rows(spark, same) == 0
    # with no unequal range, all that follows the sums is dropped while the query runs
    assert "EmptyRelation" in same._jdf.queryExecution().executedPlan().toString()
    few = right.selectExpr("k", "i", "if(k = '777', v + 1, v) v", "w")
    some = _shuffled_rows(spark, compare.differing_rows(left, few, ["k", "i"], ["v", "w"]))
    assert 4096 <= some <= 16 * 4096 + 2000
