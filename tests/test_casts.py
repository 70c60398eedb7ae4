import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelyard.functions import casts


def _cast(spark, function, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def test_uint8(spark):
    texts = ["", " 5 ", "10.0", "1.5d", "abc", "300", "-1", "0", "255", "256", None, "99999"]
    expected = [None, 5, None, None, None, None, None, 0, 255, None, None, None]
    assert _cast(spark, casts.to_uint8, *texts) == expected


def test_uint32(spark):
    texts = ["4294967295", "4294967296", "-1", "12", "1e3", "x"]
    assert _cast(spark, casts.to_uint32, *texts) == [4294967295, None, None, 12, None, None]


def test_double(spark):
    texts = ["1.5", " 2 ", "1.5d", "1.5f", "abc", "", None, "-0.25", "1e3", ".5", "5."]
    expected = [1.5, 2.0, None, None, None, None, None, -0.25, 1000.0, 0.5, 5.0]
    assert _cast(spark, casts.to_double, *texts) == expected


def test_second(spark):
    texts = [
        "2017-01-02 03:04:05",
        " 2017-01-02 03:04:05 ",
        "2017-01-02",
        "2017",
        "2017-01-02 03:04:05.999",
        "2017-13-01",
        "2017-02-30 00:00:00",
        "",
        None,
    ]
    instant = dt.datetime(2017, 1, 2, 3, 4, 5)
    expected = [instant, instant, dt.datetime(2017, 1, 2), None, instant, None, None, None, None]
    assert _cast(spark, casts.to_second, *texts) == expected


def test_second_ignores_the_session_zone(spark):
    # 00:30 did not exist on this day in the session zone of the tests.
    assert spark.conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
    assert _cast(spark, casts.to_second, "2017-10-15 00:30:00") == [
        dt.datetime(2017, 10, 15, 0, 30)
    ]


@pytest.mark.parametrize(("ascii_only", "expected"), [(False, "são paulo"), (True, "sÃo paulo")])
def test_clean_text(spark, ascii_only, expected):
    got = _cast(spark, lambda c: casts.clean_text(c, ascii_only), "  SÃO Paulo ", "\tX", None)
    assert got == [expected, "\tx", None]
