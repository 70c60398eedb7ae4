"""Raw strings as a careless source writes them, and what is left of them when cleaned.

Both sides are stated by key arithmetic. Padding, capitals, fractions of seconds and
blank keys must vanish; what is no number, no date or out of range must become null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryset.planted import number

_TEXTS = {
    "customers": "customer_city customer_state",
    "sellers": "seller_city seller_state",
    "orders": "order_status",
    "order_payments": "payment_type",
    "order_reviews": "review_comment_title review_comment_message",
    "geolocation": "geolocation_city geolocation_state",
}
_SMALL = {
    "order_items": "order_item_id",
    "order_payments": "payment_installments",
    "order_reviews": "review_score",
}
_LARGE = {"products": "product_name_lenght product_description_lenght product_photos_qty"}
_DOUBLES = {
    "order_items": "price freight_value",
    "order_payments": "payment_value",
    "products": "product_weight_g product_length_cm",
}
_TIMES = {
    "orders": "order_approved_at order_delivered_carrier_date",
    "order_items": "shipping_limit_date",
    "order_reviews": "review_creation_date review_answer_timestamp",
}

#: By kind: (remainder of the row's number by 11, the raw string, the clean value).
_CASES = {
    "text": [(1, "'  ' || upper({c}) || ' '", "{c}"), (2, "upper({c})", "{c}")],
    "small": [(1, "'300'", "NULL"), (2, "'-1'", "NULL"), (3, "'2.5'", "NULL"), (4, "' ' || {c} || ' '", "{c}")],
    "large": [(1, "'4294967296'", "NULL"), (2, "'many'", "NULL"), (3, "'4294967295'", "4294967295")],
    "double": [
        (1, "'1.5d'", "NULL"), (2, "'NaN'", "NULL"), (3, "' ' || {c} || ' '", "{c}"),
        (4, "'12e1'", "CAST(120 AS DOUBLE)"), (5, "'1,5'", "NULL"), (6, "''", "NULL"),
    ],
    "time": [
        (1, "'2017'", "NULL"), (2, "'2017-13-01 00:00:00'", "NULL"), (3, "{c} || '.75'", "{c}"),
        (4, "'2017-02-03'", "TIMESTAMP '2017-02-03 00:00:00'"), (5, "'03/02/2017'", "NULL"),
    ],
}
_KINDS = {"text": _TEXTS, "small": _SMALL, "large": _LARGE, "double": _DOUBLES, "time": _TIMES}


def _changes(table: str, clean: bool) -> dict[str, str]:
    n = number(f"raw.{table}") if table != "order_reviews" else "CAST(review_id AS BIGINT)"
    out = {}
    for kind, columns in _KINDS.items():
        for c in columns.get(table, "").split():
            cases = " ".join(
                f"WHEN {n} % 11 = {k} THEN {(after if clean else before).format(c=c)}"
                for k, before, after in _CASES[kind]
            )
            out[c] = f"CASE {cases} ELSE {c} END"
    return out


def dirty(table: str, raw: DataFrame) -> DataFrame:
    """A raw table as it might arrive; geolocation also gets rows without a prefix."""
    df = raw.withColumns({c: F.expr(sql) for c, sql in _changes(table, clean=False).items()})
    if table == "geolocation":
        df = df.withColumn(
            "geolocation_lat",
            F.expr("CASE WHEN lower(trim(geolocation_city)) = 'building' THEN '1.5d' ELSE geolocation_lat END"),
        )
        df = df.unionAll(df.withColumn("geolocation_zip_code_prefix", F.lit("  ")))
    return df


def cleaned_sql(table: str) -> str:
    """DuckDB: the typed source table as it should come out of ``dirty`` strings."""
    replaced = ", ".join(f"{sql} AS {c}" for c, sql in _changes(table, clean=True).items())
    if table == "geolocation":
        replaced += ", CASE WHEN geolocation_city <> 'building' THEN geolocation_lat END AS geolocation_lat"
    return f"SELECT * REPLACE ({replaced}) FROM src_{table}" if replaced else f"SELECT * FROM src_{table}"
