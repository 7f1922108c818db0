"""One key holding a third of the rows: results stay right and the plan splits it."""

from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import functions as F

from orderloom.functions.ordered import _splitters, running_sums
from orderloom.operators import evaluation, kpi, quality, sales, snapshots

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_shop(spark, n=60000):
    """Account 0 placed a third of the orders; order 0 has a third of the lines."""
    orders = spark.range(n).selectExpr(
        "cast(id as string) order_id",
        "cast(if(id % 3 = 0, 0, id % 500 + 1) as string) customer_id",
        "'delivered' order_status",
        "timestamp_ntz'2020-01-01' + make_dt_interval(cast(id % 700 as int)) order_purchase_ts",
    )
    items = spark.range(n * 2).selectExpr(
        "cast(if(id % 3 = 0, 0, id div 2) as string) order_id",
        "id order_item_id",
        "'p' product_id",
        "cast(1.25 as decimal(18,2)) revenue",
    )
    customers = spark.range(501).selectExpr("cast(id as string) customer_id", "concat('P', id) customer_unique_id")
    return orders, items, customers


def test_hot_account_is_split(spark):
    with settings(spark, NO_BROADCAST):
        shop = hot_shop(spark)
        monthly = kpi.monthly_revenue_tx(sales.transactions(*shop))
        rows = monthly.collect()
        plan = monthly._jdf.queryExecution().executedPlan().toString()
        lines = kpi.monthly_revenue_tx(sales.transaction_lines(*shop)).collect()
    assert "skew=true" in plan.split("Initial Plan")[0]
    assert sorted(rows) == sorted(lines)
    assert sum(r["revenue"] for r in rows) == Decimal("1.25") * 120000


def test_hot_customer_snapshots(spark):
    """The hot customer's order counts equal a plain count of the orders up to the snapshot."""
    orders = sales.customer_orders(*hot_shop(spark, 6000))
    ds = snapshots.build_snapshot_dataset(orders)
    hot = {r["snapshot_date"]: r["orders_lifetime"] for r in ds.filter("customer_id = 'P0'").collect()}
    dates = [r["order_date"] for r in orders.filter("customer_id = 'P0'").collect()]
    assert len(hot) > 10
    assert hot == {s: sum(d <= s for d in dates) for s in hot}


def test_hot_key_in_checks(spark):
    orders, items, customers = hot_shop(spark, 3000)
    few = customers.filter("customer_id <> '0'")
    check = quality.missing_reference_check(orders, "customer_id", few, "customer_id", "x").first()
    assert check["bad_rows"] == 1000


def test_ranges_are_balanced(spark):
    """Values crowded near 0 still spread over the ranges."""
    df = spark.range(5000).select(F.pow(F.col("id") / 5000.0, 8).alias("x"), F.lit(1).alias("one"))
    cut = df.withColumn("s", _splitters(df, F.col("x"), ["one"], 32))
    sizes = cut.groupBy(F.expr("size(filter(s, v -> v < x))")).count().agg(F.max("count")).first()[0]
    assert sizes < 1000
    out = running_sums(df, ["x"], ["one"], ranges=32)
    assert out.count() == 5000 and out.agg(F.max("cum_one")).first()[0] == 5000


def test_a_third_of_the_rows_share_the_cut_score(spark):
    scored = spark.range(3000).selectExpr(
        "format_string('k%05d', id) customer_id", "cast(id % 2 as int) y", "if(id % 3 = 0, 0.9, id / 10000.0) score"
    )
    row = evaluation.eval_metrics(scored, 0.1).first()
    first_tied = [i for i in range(3000) if i % 3 == 0][:300]
    assert row["precision_at_k"] == sum(i % 2 for i in first_tied) / 300
