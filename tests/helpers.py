"""Hand-made tables and plan inspection."""

from __future__ import annotations

from collections import Counter
from contextlib import redirect_stdout
from io import StringIO

from parcelyard.schema import RAW_COLUMNS, raw_schema


def raw_table(spark, table, rows):
    """An all-string raw table from dicts; missing columns are null."""
    values = [tuple(row.get(c) for c in RAW_COLUMNS[table]) for row in rows]
    return spark.createDataFrame(values, raw_schema(table))


def raw_tables(spark, **tables):
    """All raw tables, the ones not given empty."""
    return {t: raw_table(spark, t, tables.get(t, [])) for t in RAW_COLUMNS}


def order(order_id, delivered=None, estimated="2018-01-10 00:00:00", **more):
    return {
        "order_id": order_id,
        "customer_id": f"c-{order_id}",
        "order_status": "delivered",
        "order_purchase_timestamp": "2018-01-01 10:00:00",
        "order_delivered_customer_date": delivered,
        "order_estimated_delivery_date": estimated,
        **more,
    }


def item(order_id, seller="s1", price="100.0", freight="10.0", n="1", product="p1"):
    return {
        "order_id": order_id,
        "order_item_id": n,
        "product_id": product,
        "seller_id": seller,
        "price": price,
        "freight_value": freight,
    }


def review(order_id, review_id, score="5", created=None, answered=None):
    return {
        "order_id": order_id,
        "review_id": review_id,
        "review_score": score,
        "review_creation_date": created,
        "review_answer_timestamp": answered,
    }


def rows(df, *columns):
    """Rows as a multiset, with floats rounded."""
    columns = columns or tuple(sorted(df.columns))

    def plain(v):
        return round(v, 6) if isinstance(v, float) else v

    return Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())


def by(df, key):
    return {r[key]: r for r in df.collect()}


def plan(df, mode="formatted"):
    out = StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
