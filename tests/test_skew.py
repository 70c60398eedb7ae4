"""Hot keys: same results, and no single task that gets them all."""

import pytest
from pyspark.sql import functions as F

from parcelyard.operators.spread import hot_keys, spread_left_join
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def hot(spark):
    # A third of the rows on one key, some on null and on a key the lookup lacks.
    key = "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else 'k' || id % 97 end"
    return spark.range(3000).selectExpr("string(id) as row", f"{key} as k")


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(90).selectExpr(
        "if(id = 0, 'hot', 'k' || id) as k", "'name' || id as name", "id as number"
    )


def test_hot_keys_are_few_and_exact(hot):
    assert [r.k for r in hot_keys(hot, "k", 8).collect()] == ["hot"]
    assert hot_keys(hot, "k", 2).count() == 0
    assert hot_keys(hot, "k", 3000).count() <= 3000


@pytest.mark.parametrize("ways", [None, 1, 8, 1000])
def test_spread_join_equals_plain_join(hot, names, ways):
    plain = hot.join(names, "k", "left")
    spread = spread_left_join(hot, names, "k", "row", ways)
    assert sorted(spread.columns) == sorted(plain.columns)
    assert rows(spread) == rows(plain)


def test_unread_lookup_leaves_the_plan(hot, names):
    text = plan(spread_left_join(hot, names, "k", "row", 8).groupBy("row").count(), "simple")
    assert "Join" not in text


def test_hot_branch_runs_in_the_registered_query(spark, small_dir):
    from queryset.catalog import HotInputs

    hot_inputs = HotInputs(spark, small_dir)
    customers, orders = (hot_inputs.staged[t] for t in ("stg_customers", "stg_orders"))
    assert "0" in {r.customer_unique_id for r in hot_keys(customers, "customer_unique_id", 4).collect()}
    assert [r.customer_id for r in hot_keys(orders, "customer_id", 4).collect()] == ["1"]
    text = plan(hot_inputs.models.fct_orders, "simple")
    assert text.count("_slot") >= 2 and "CartesianProduct" not in text


def test_spread_join_divides_the_hot_key(spark, hot, names):
    before = {
        k: spark.conf.get(k)
        for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    }
    try:
        for k in before:
            spark.conf.set(k, "false" if k.endswith("enabled") else "-1")

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(hot.join(names, "k", "left").select("row", "name")) > 1000
        spread = spread_left_join(hot, names, "k", "row", ways=64)
        assert largest(spread.select("row", "name")) < 1000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_orders_of_a_hot_person(spark):
    from parcelyard.plans.orders import fct_orders
    from parcelyard.plans.orders import order_freight
    from parcelyard.plans.staging import stage
    from tests.helpers import order, raw_tables

    staged = stage(raw_tables(spark, orders=[order(str(i)) for i in range(60)]))
    customers = spark.range(60).selectExpr(
        "'c-' || id as customer_id",
        "if(id < 40, 'ann', 'p' || id) as customer_unique_id",
        "'1' as customer_zip_code_prefix",
        "'c' || id % 2 as customer_city",
        "'s' as customer_state",
    )
    from parcelyard.plans.dimensions import dim_customer

    df = fct_orders(
        staged["stg_orders"],
        order_freight(staged["stg_order_items"]),
        staged["stg_order_reviews"],
        customers,
        dim_customer(customers),
    )
    got = {r.order_id: r.customer_city for r in df.collect()}
    assert len(got) == 60
    assert {got[str(i)] for i in range(40)} == {"c0"}
    assert all(got[str(i)] == f"c{i % 2}" for i in range(40, 60))
