from decimal import Decimal

import pytest

from orderloom.operators import silver
from orderloom.sources import raw_csv

ITEMS_HEADER = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"


def _write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_dialect(spark, tmp_path):
    folder = _write(
        tmp_path,
        "x_customers_dataset.csv",
        "id,person,zip,town,state\n"  # header names do not matter, positions do
        'c1,p1,01037,"sao paulo, sp",SP\n'
        '  c2 , p2 ,00001,"  rio  ",RJ\n'
        'c3,,"",,\n',
    )
    rows = {r["customer_id"]: r for r in raw_csv.load_customers(spark, folder).collect()}
    assert rows["c1"]["customer_city"] == "sao paulo, sp"
    assert rows["c1"]["customer_zip_code_prefix"] == "01037"
    assert rows["c2"]["customer_city"] == "rio" and rows["c2"]["customer_unique_id"] == "p2"
    assert rows["c3"]["customer_unique_id"] is None and rows["c3"]["customer_zip_code_prefix"] is None
    assert rows["c1"]["ingested_at"] is not None


SHORT, LONG, BAD_NUMBER = "o2,2,p,s\n", "o2,2,p,s,2017-01-01,1.00,0.10,9\n", "o2,x,p,s,2017-01-01,1.00,0.10\n"


def _items_with(spark, tmp_path, bad):
    folder = _write(tmp_path, "order_items_dataset.csv", ITEMS_HEADER + "o1,1,p,s,2017-01-01,1.00,0.10\n" + bad)
    return raw_csv.load_order_items(spark, folder)


@pytest.mark.parametrize("bad", [SHORT, LONG, BAD_NUMBER])
def test_one_bad_row_stops_the_load(spark, tmp_path, bad):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        _items_with(spark, tmp_path, bad).collect()


@pytest.mark.parametrize("bad", [SHORT, LONG])
def test_misshapen_rows_stop_a_narrow_read_too(spark, tmp_path, bad):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        _items_with(spark, tmp_path, bad).select("order_id").collect()


def test_as_text_keeps_null(spark):
    df = spark.createDataFrame([("a", 1, None)], "k string, n int, d decimal(18,2)")
    assert raw_csv.as_text(df).collect() == [("a", "1", None)]


def test_timestamps_are_tried_not_trusted(spark):
    raw = spark.createDataFrame(
        [(str(i), "c", "s", t, None, None, None, None) for i, t in enumerate(["", "not a date", "2017-02-30", "2017-02-28 10:11:12"])],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string,"
        "order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string",
    )
    parsed = [str(r["order_purchase_ts"]) for r in silver.silver_orders(raw).orderBy("order_id").collect()]
    assert parsed == ["None", "None", "None", "2017-02-28 10:11:12"]


def test_revenue_needs_both_parts(spark):
    raw = spark.createDataFrame(
        [("o", 1, Decimal("1.10"), Decimal("0.20")), ("o", 2, None, Decimal("0.20")), ("o", 3, Decimal("1.10"), None)],
        "order_id string, order_item_id bigint, price decimal(18,2), freight_value decimal(18,2)",
    ).selectExpr("order_id", "order_item_id", "'p' product_id", "'s' seller_id", "'' shipping_limit_date", "price", "freight_value")
    rows = silver.silver_order_items(raw).orderBy("order_item_id").collect()
    assert [r["revenue"] for r in rows] == [Decimal("1.30"), None, None]
