import math
import random

import pytest

from parcelyard.operators.quantile import exact_quantile


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("ranges", [3, 4096])
def test_against_sorting(spark, q, ranges):
    rng = random.Random(3)
    # A third of the rows share one value; a few lie very far out.
    values = [0.25 if rng.random() < 0.33 else rng.random() for _ in range(20_000)]
    values += [1e300, -1e300, 5e-324, 0.0, -0.5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(16)
    df.cache()
    expected = sorted(values)[max(math.ceil(q * len(values)), 1) - 1]
    assert exact_quantile(df, "x", q, ranges) == expected


def test_single_value_and_empty(spark):
    one = spark.createDataFrame([(2.0,)], "x double")
    assert exact_quantile(one, "x") == 2.0
    assert exact_quantile(one.filter("x is null"), "x") is None
