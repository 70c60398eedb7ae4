"""A refresh rebuilds the months whose inputs changed, and only these; the result is a full build's."""

import datetime as dt
from pathlib import Path

import pytest

from parcelyard import Models
from parcelyard.plans.models import STAGING
from parcelyard.sources import refresh
from parcelyard.sources.calendar import fixed_range
from tests.helpers import item, order, plan, raw_tables, review, rows

MARTS = (
    "fct_orders",
    "mart_data_quality",
    "mart_logistics_performance_score",
    "mart_seller_freight",
    "mart_seller_performance",
)
JAN, FEB, MAR, MAY = (dt.date(2018, m, 1) for m in (1, 2, 3, 5))


def _order(name, month, **more):
    return order(
        name,
        f"2018-{month:02d}-09 00:00:00",
        estimated=f"2018-{month:02d}-10 00:00:00",
        order_purchase_timestamp=f"2018-{month:02d}-01 10:00:00",
        **more,
    )


def _shop():
    """Two orders a month, one of them by a person with two customer ids, and one undated order."""
    names = [(f"o{m}{n}", m) for m in (1, 2, 3) for n in "ab"]
    return {
        "orders": [_order(n, m) for n, m in names]
        + [{**_order("o0", 1), "order_purchase_timestamp": None}],
        "order_items": [item(n, f"s{m % 2}", str(10.0 * m), "2.5") for n, m in names]
        + [item("lost", "s1"), item("o1a", "s0", "7.0", "1.0", n="2")],
        "order_reviews": [review(n, f"r-{n}", "4") for n, m in names if n.endswith("a")],
        "customers": [
            {"customer_id": f"c-{n}", "customer_unique_id": f"u{i % 4}", "customer_zip_code_prefix": "1",
             "customer_city": "lima", "customer_state": "LI"}
            for i, (n, m) in enumerate(names)
        ],
        "sellers": [{"seller_id": f"s{i}", "seller_city": "rome", "seller_state": "RM"} for i in (0, 1)],
    }


def _models(spark, shop):
    return Models.from_raw(raw_tables(spark, **shop), lambda: fixed_range(spark))


def _same_as_full(spark, path, models):
    stored = refresh.read_refreshed(spark, path)
    for name in MARTS:
        full = models[name]
        assert rows(stored[name], *sorted(full.columns)) == rows(full), name


def _months(report):
    return {r["order_month"]: r["orders"] for r in report.collect()}


def _changes():
    """Name, change of the shop, months that a refresh must build or drop with their orders."""

    def drop(table, key, value):
        return lambda s: s[table].__setitem__(slice(None), [r for r in s[table] if r[key] != value])

    def first(table, **values):
        return lambda s: s[table][0].update(values)

    def keep(table, start, end):
        return lambda s: s[table].__setitem__(slice(None), s[table][start:end])

    return [
        ("nothing", lambda s: None, {}),
        ("one price", first("order_items", price="11.0"), {JAN: 2}),
        ("one item more", lambda s: s["order_items"].append(item("o2a", "s1", "1.0", n="9")), {FEB: 2}),
        ("an item twice", lambda s: s["order_items"].append(item("o2b", "s0", "20.0", "2.5")), {FEB: 2}),
        ("a score", first("order_reviews", review_score="1"), {JAN: 2}),
        ("no reviews in march", drop("order_reviews", "order_id", "o3a"), {MAR: 2}),
        ("a delivery", lambda s: s["orders"][2].update(order_delivered_customer_date="2018-02-20 00:00:00"), {FEB: 2}),
        ("an order moves", lambda s: s["orders"][0].update(order_purchase_timestamp="2018-05-03 00:00:00"), {JAN: 1, MAY: 1}),
        ("a month goes", keep("orders", 2, None), {JAN: 0}),
        ("a month loses its items", lambda s: s.update(order_items=[i for i in s["order_items"] if i["order_id"][:2] != "o3"]), {MAR: 2}),
        ("the undated order", lambda s: s["orders"][6].update(order_status="shipped"), {None: 1}),
        ("an item without an order", lambda s: s["order_items"][6].update(price="1.0"), {}),
        ("a seller's city", first("sellers", seller_city="oslo"), {}),
        # o1a and o3a are the same person's; both customer ids move, so the address does
        ("a person moves", lambda s: [c.update(customer_city="cusco") for c in s["customers"] if c["customer_unique_id"] == "u0"], {JAN: 2, MAR: 2}),
    ]


def _fingerprints(models):
    found = refresh.month_fingerprints(models, models["dim_customer"]).collect()
    return {r["order_month"]: r for r in found}


def test_each_change_shows_in_its_months(spark):
    sound = _fingerprints(_models(spark, _shop()))
    for name, change, expected in _changes():
        shop = _shop()
        change(shop)
        now = _fingerprints(_models(spark, shop))
        found = {m: now[m]["orders"] if m in now else 0 for m in {*sound, *now} if sound.get(m) != now.get(m)}
        assert found == expected, name


def test_refreshes_equal_full_builds(spark, tmp_path):
    path = str(tmp_path)
    sound = _models(spark, _shop())
    assert _months(refresh.refresh_marts(sound, path)) == {JAN: 2, FEB: 2, MAR: 2, None: 1}
    _same_as_full(spark, path, sound)
    changes = {name: change for name, change, _ in _changes()}
    for names, expected in (
        (["a month loses its items", "the undated order", "a seller's city"], {MAR: 2, None: 1}),
        (["an order moves", "a person moves", "one item more"], {JAN: 1, FEB: 2, MAR: 2, MAY: 1, None: 1}),
        (["a month goes"], {JAN: 0, FEB: 2, MAR: 2, MAY: 0}),
    ):
        shop = _shop()
        for name in names:
            changes[name](shop)
        models = _models(spark, shop)
        assert _months(refresh.refresh_marts(models, path)) == expected, names
        _same_as_full(spark, path, models)


def test_a_change_writes_one_folder(spark, tmp_path):
    path = str(tmp_path)
    refresh.refresh_marts(_models(spark, _shop()), path)
    files = {f: f.stat().st_mtime_ns for f in Path(path, "fct_orders").rglob("*.parquet")}
    shop = _shop()
    shop["order_items"][0]["price"] = "99.0"
    refresh.refresh_marts(_models(spark, shop), path)
    later = {f: f.stat().st_mtime_ns for f in Path(path, "fct_orders").rglob("*.parquet")}
    assert files.items() <= later.items()
    assert {f.parent.parent.name for f in later.keys() - files.keys()} == {"order_month=2018-01-01"}
    stale = refresh.stale_folders(spark, path).collect()
    assert {r["order_month"] for r in stale} == {JAN}
    assert {r["mart"] for r in stale} == set(refresh.MONTHLY)


def test_a_broken_run_is_not_seen_and_is_made_good(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    sound = _models(spark, _shop())
    refresh.refresh_marts(sound, path)
    shop = _shop()
    shop["order_items"][0]["price"] = "99.0"
    later = _models(spark, shop)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh.sellers, "seller_months", broken)
        with pytest.raises(RuntimeError):
            refresh.refresh_marts(later, path)
    _same_as_full(spark, path, sound)
    assert _months(refresh.refresh_marts(sound, path)) == {}
    assert _months(refresh.refresh_marts(later, path)) == {JAN: 2}
    _same_as_full(spark, path, later)


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError):
        refresh.read_refreshed(spark, path)
    nothing = _models(spark, {})
    assert _months(refresh.refresh_marts(nothing, path)) == {}
    _same_as_full(spark, path, nothing)
    sound = _models(spark, _shop())
    refresh.refresh_marts(sound, path)
    _same_as_full(spark, path, sound)
    assert set(_months(refresh.refresh_marts(nothing, path)).values()) == {0}
    _same_as_full(spark, path, nothing)


def test_a_month_filter_reads_one_live_folder(spark, tmp_path):
    path = str(tmp_path)
    refresh.refresh_marts(_models(spark, _shop()), path)
    one = refresh.read_refreshed(spark, path)["fct_orders"].filter("order_month = date'2018-02-01'")
    assert "PartitionFilters" in plan(one) and len(one.inputFiles()) >= 1
    scan = [line for line in plan(one).splitlines() if "PartitionFilters" in line][0]
    assert "refresh_run" in scan and "order_month" in scan


def test_fingerprints_do_not_depend_on_partitions(spark, models):
    got = rows(refresh.month_fingerprints(models, models["dim_customer"]))
    spread = Models({n: models[n].repartition(7) for n in STAGING})
    assert rows(refresh.month_fingerprints(spread, spread["dim_customer"])) == got


def test_fingerprints_move_hashes_only(spark):
    models = _models(spark, _shop())
    text = plan(refresh.month_fingerprints(models, models["dim_customer"]), "simple")
    moved = text[: text.index("order_status")]
    assert "_sold_1" in moved and "order_delivered_carrier_date" not in moved
    joins = [line for line in text.splitlines() if "Project" in line and "_order_1" in line]
    assert joins and not any("order_approved_at#" in line.split("xxhash64")[0] for line in joins)
