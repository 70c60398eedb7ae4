import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelyard import schema as S
from parcelyard.functions.metrics import weighted_score
from parcelyard.plans.score import logistics_score
from tests.helpers import by

_SCHEMA = """order_id string, order_purchase_timestamp timestamp_ntz, delivery_severity string,
             review_score short, freight_ratio double, seller_count long"""


def _orders(spark, *orders):
    rows = [
        (str(i), dt.datetime(2018, month, 5) if month else None, sev, score, ratio, sellers)
        for i, (month, sev, score, ratio, sellers) in enumerate(orders)
    ]
    return spark.createDataFrame(rows, _SCHEMA)


def _months(df):
    return {m.month: r for m, r in by(df, "order_month").items()}


def test_components(spark):
    got = _months(
        logistics_score(
            _orders(
                spark,
                (1, S.ON_TIME, 5, 0.1, 1),
                (1, S.LATE_1_3, 3, 0.3, 3),
                (1, S.LATE_8_UP, None, None, None),
                (1, S.CLOSED, 1, 0.5, 1),
                (2, S.LATE_4_7, 2, 1.1, 2),
                (None, S.ON_TIME, 5, 99.0, 1),
            )
        )
    )
    jan, feb = got[1], got[2]
    assert set(got) == {1, 2}
    assert jan.delivery_score == pytest.approx((100 + 70 + 0) / 3)
    assert jan.customer_experience_score == pytest.approx((3 - 1) / 4 * 100)
    assert jan.logistics_cost_score == pytest.approx(100 * (1 - (0.3 - 0.1) / (1.1 - 0.1)))
    assert jan.seller_score == pytest.approx((100 + 3 * 70) / 4)
    assert (jan.order_count, jan.delivery_coverage) == (4, 0.75)
    assert jan.final_score == pytest.approx(
        0.4 * jan.delivery_score
        + 0.3 * jan.customer_experience_score
        + 0.2 * jan.logistics_cost_score
        + 0.1 * jan.seller_score
    )
    assert feb.logistics_cost_score == pytest.approx(0.0)


def test_missing_component_rescales_the_others(spark):
    got = _months(
        logistics_score(
            _orders(spark, (1, S.ON_TIME, 3, None, 1), (2, S.ON_TIME, 5, 0.2, 1))
        )
    )
    jan = got[1]
    assert jan.logistics_cost_score is None
    assert jan.final_score == pytest.approx((0.4 * 100 + 0.3 * 50 + 0.1 * 100) / 0.8)


def test_month_without_any_component_is_left_out(spark):
    got = _months(
        logistics_score(
            _orders(spark, (1, S.CLOSED, None, None, 1), (2, S.CLOSED, 4, None, None))
        )
    )
    assert set(got) == {2}
    assert got[2].final_score == pytest.approx(75.0)
    assert got[2].delivery_coverage == 0.0


def test_equal_freight_ratios_score_100(spark):
    got = _months(
        logistics_score(
            _orders(spark, (1, S.ON_TIME, 5, 0.2, 1), (2, S.LATE_8_UP, 1, 0.2, 1))
        )
    )
    assert got[1].logistics_cost_score == got[2].logistics_cost_score == 100.0


def test_final_score_stays_within_its_components(models):
    for row in models.mart_logistics_performance_score.collect():
        parts = [row[c] for c in S.SCORE_WEIGHTS if row[c] is not None]
        assert min(parts) - 1e-9 <= row.final_score <= max(parts) + 1e-9


def test_weights_add_up_and_empty_input_is_null(spark):
    assert sum(S.SCORE_WEIGHTS.values()) == pytest.approx(1.0)
    df = spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in S.SCORE_WEIGHTS])
    assert df.select(weighted_score(S.SCORE_WEIGHTS).alias("v")).first().v is None
