from datetime import date, datetime
from decimal import Decimal

import pytest

from orderloom.operators import kpi, model, quality, sales


@pytest.fixture()
def shop(spark):
    """Two accounts of one person, a person without id, a delivered order without
    items that is the newest of all, mixed-case statuses, a NULL time, missing money."""
    t = lambda d: datetime(2020, 1, d)
    orders = spark.createDataFrame(
        [
            ("o1", "a1", "delivered", t(1)),
            ("o2", "a2", "delivered", t(2)),
            ("o3", "a3", "delivered", t(3)),
            ("o4", "a1", "delivered", t(20)),
            ("o5", "a1", "Delivered", t(4)),
            ("o6", "a4", "canceled", t(5)),
            ("o7", "a4", "delivered", None),
            ("o8", "gone", "delivered", t(6)),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz",
    )
    items = spark.createDataFrame(
        [("o1", 1, 10), ("o1", 2, None), ("o2", 1, 5), ("o3", 1, 7), ("o5", 1, 100), ("o7", 1, 3), ("o8", 1, 9)],
        "order_id string, order_item_id bigint, r int",
    ).selectExpr("order_id", "order_item_id", "'p' product_id", "cast(r as decimal(18,2)) revenue",
                 "cast(r as decimal(18,2)) price", "cast(1 as decimal(18,2)) freight_value")
    customers = spark.createDataFrame(
        [("a1", "P"), ("a2", "P"), ("a3", None), ("a4", "Q")], "customer_id string, customer_unique_id string"
    ).selectExpr("*", "'z' customer_zip_code_prefix", "'city' customer_city", "'st' customer_state")
    return orders, items, customers


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_tx_keeps_null_groups(shop):
    tx = sales.transactions(*shop)
    monthly = _by(kpi.monthly_revenue_tx(tx), "year_month")
    assert monthly["2020-01"][1:] == (Decimal("22.00"), 3, 1)  # the NULL person is not a customer
    assert monthly[None][1:] == (Decimal("3.00"), 1, 1)
    rfm = _by(kpi.customer_rfm_tx(tx), "customer_id")
    assert set(rfm) == {"P", "Q", None}
    assert rfm["P"][1:] == (1, 2, Decimal("15.00"), date(2020, 1, 2))  # o4 has no items
    assert rfm["Q"]["last_order_date"] is None and rfm["Q"]["recency_days"] is None


def test_order_grain_equals_line_grain(shop):
    lines, orders = sales.transaction_lines(*shop), sales.transactions(*shop)
    for f in (kpi.monthly_revenue_tx, kpi.daily_revenue_tx, kpi.customer_rfm_tx):
        assert sorted(f(lines).collect(), key=repr) == sorted(f(orders).collect(), key=repr)


def test_model_sees_orders_without_items(shop):
    orders, items, customers = shop
    fact, lines = model.fact_orders(orders, customers), model.fact_order_items(items)
    rfm = _by(kpi.customer_rfm_model(fact, lines), "customer_id")
    assert set(rfm) == {"P"}  # no id: dropped; Q has no timed delivered order
    assert rfm["P"][1:] == (0, 3, Decimal("15.00"), date(2020, 1, 20))
    monthly = kpi.monthly_revenue_model(fact, lines, model.dim_date(orders)).collect()
    assert monthly == [("2020-01", Decimal("22.00"), 3, 1)]


def test_dimensions(shop):
    orders, _, customers = shop
    people = model.dim_customer(customers).collect()
    assert sorted(r["customer_key"] for r in people) == ["P", "P", "Q"]
    assert model.dim_date(orders).count() == 7


def test_customer_orders_ignores_case_and_fills_zero(shop):
    rows = _by(sales.customer_orders(*shop), "order_id")
    assert set(rows) == {"o1", "o2", "o4", "o5"}
    assert rows["o4"]["order_revenue"] == 0 and rows["o5"]["order_revenue"] == 100


def test_customer_features_fill_each_part(shop):
    orders, items, _ = shop
    dated = orders.selectExpr("*", "to_date(order_purchase_ts) order_date")
    rows = _by(sales.customer_features(dated, items), "customer_id")
    assert rows["a1"]["total_revenue"] == Decimal("113.00") and rows["a1"]["order_count"] == 2


def test_missing_references(shop):
    orders, _, customers = shop
    fact = model.fact_orders(orders, customers)
    check = quality.missing_reference_check(fact, "customer_key", model.dim_customer(customers), "customer_key", "x")
    assert check.collect() == [("x", "FAIL", 1)]  # the person without id
    dates = quality.missing_reference_check(fact, "order_date", model.dim_date(orders), "date_key", "y")
    assert dates.collect() == [("y", "PASS", 0)]


def test_empty_gold_fails(spark):
    empty = spark.createDataFrame([], "year_month string")
    assert quality.rowcount_checks({"T": empty}).collect() == [("T rowcount > 0", "FAIL", 0)]
    check = quality.not_null_checks({"T": (empty, "year_month")})
    assert check.collect() == [("T: YEAR_MONTH is NOT NULL", "FAIL", None)]
    assert quality.failed(check).collect() == [("T: YEAR_MONTH is NOT NULL",)]


def test_duplicate_keys_are_counted_once(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 1)], "order_id string, order_item_id int")
    assert quality.duplicate_key_check(df, ["order_id", "order_item_id"], "t").first()["dup_keys"] == 1
    assert quality.duplicate_key_check(df.distinct(), ["order_id"], "t").first()["status"] == "PASS"


def test_declared_order_rows_give_the_same_reports_without_expand(shop):
    tx = sales.transactions(*shop)
    for f in (kpi.monthly_revenue_tx, kpi.daily_revenue_tx, kpi.customer_rfm_tx):
        declared = f(tx, one_row_per_order=True)
        assert sorted(declared.collect(), key=repr) == sorted(f(tx).collect(), key=repr)
        assert "Expand" not in declared._jdf.queryExecution().toString()
    orders, items, customers = shop
    facts = model.fact_orders(orders, customers), model.fact_order_items(items)
    days = model.dim_date(orders)
    monthly = kpi.monthly_revenue_model(*facts, days, one_row_per_order=True)
    assert sorted(monthly.collect()) == sorted(kpi.monthly_revenue_model(*facts, days).collect())
    assert "Expand" not in monthly._jdf.queryExecution().toString()
