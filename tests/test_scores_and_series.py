from datetime import date
from decimal import Decimal

import numpy as np
import pytest

from orderloom.operators import noise, scoring, series

RFM = "customer_id string, recency_days int, frequency bigint, monetary decimal(18,2), last_order_date date"


def test_scores_and_labels(spark):
    rfm = spark.createDataFrame(
        [("a", 0, 5, Decimal(100), date(2020, 2, 1)), ("b", 100, 1, None, date(2019, 10, 24)), ("c", 50, 3, Decimal(50), date(2019, 12, 13))],
        RFM,
    )
    scored = scoring.score_rfm(rfm)
    rows = {r["customer_id"]: r for r in scored.collect()}
    assert [rows[c]["churn_score"] for c in "abc"] == pytest.approx([0.0, 1.0, 0.5])
    assert [rows[c]["churn_label"] for c in "abc"] == ["LOW", "HIGH", "MEDIUM"]
    assert rows["b"]["monetary"] is None  # filled for the score only
    assert {r["snapshot_date"] for r in scoring.current_churn_rows(scored, "v").collect()} == {date(2020, 2, 1)}


def test_equal_profiles_scale_to_zero(spark):
    rfm = spark.createDataFrame([(c, 5, 2, Decimal(7), date(2020, 1, 1)) for c in "ab"], RFM)
    assert [r["churn_score"] for r in scoring.score_rfm(rfm).collect()] == pytest.approx([0.4, 0.4])


def test_label_churn(spark):
    df = spark.createDataFrame([(89,), (90,), (None,)], "recency_days int")
    assert [r["is_churn"] for r in scoring.label_churn(df).collect()] == [0, 1, 0]
    with pytest.raises(ValueError):
        scoring.label_churn(df.withColumnRenamed("recency_days", "x"))


def test_eval_dataset(spark):
    days = [date(2020, 1, d) for d in range(1, 11)]
    orders = [("a", f"a{i}", d) for i, d in enumerate(days)] + [("b", "b0", days[0]), ("c", "c0", days[9])]
    df = spark.createDataFrame(orders, "customer_id string, order_id string, order_date date")
    assert scoring.cutoff_dates(df).first() == (days[7], days[7], days[9])
    rows = {r["customer_id"]: r for r in scoring.build_eval_dataset(df, churn_window_days=1).collect()}
    assert set(rows) == {"a", "b"}  # c has no history
    assert (rows["a"]["frequency"], rows["a"]["days_to_next"], rows["a"]["is_churn"]) == (8, 1, 0)
    assert (rows["b"]["recency_days"], rows["b"]["is_churn"], rows["b"]["score"]) == (7, 1, 1.0)


def _z(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "revenue double")
    return [(r["z_score"], r["is_anomaly"]) for r in series.detect_anomalies(df, **options).collect()]


def test_z_scores_skip_nulls(spark):
    values = [1.0] * 20 + [100.0]
    got = _z(spark, values + [None, float("nan")])
    expected = (np.array(values) - np.mean(values)) / np.std(values)
    assert [z for z, _ in got[:-2]] == pytest.approx(expected)
    assert [a for _, a in got] == [False] * 20 + [True, False, False]
    assert got[-1][0] is None and got[-2][0] is None


@pytest.mark.parametrize("values", [[0.1] * 7, [5.0], [0.1, None]])
def test_constant_series_has_no_anomaly(spark, values):
    assert _z(spark, values) == [(0.0, False)] * len(values)


def test_missing_column(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    for f in (series.detect_anomalies, series.forecast_next_period):
        with pytest.raises(ValueError, match="missing column: revenue"):
            f(df)


def test_forecast(spark):
    rows = [(date(2020, 1, d), float(d)) for d in range(1, 10)]
    df = spark.createDataFrame(rows + [(date(2020, 1, 10), None)], "order_date date, revenue double")
    assert series.forecast_next_period(df, window=3).first()[0] == 8.5
    assert series.forecast_next_period(df, window=99).first()[0] == 5.0
    with pytest.raises(Exception, match="series must not be empty"):
        series.forecast_next_period(df.filter("revenue < 0")).collect()


def test_daily_anomaly_fills_null_revenue_for_the_score_only(spark):
    rows = [(date(2020, 1, d), Decimal(10), 1) for d in range(1, 4)] + [(None, None, 1)]
    df = spark.createDataFrame(rows, "order_date date, revenue decimal(18,2), orders bigint")
    got = {r["order_date"]: r for r in series.score_daily_anomaly(df).collect()}
    assert got[None]["revenue"] is None and got[None]["z_score"] == Decimal("-1.732051")


def test_winsor_limits_can_come_from_training_rows(spark):
    cols = "monetary_30d, monetary_90d, monetary_lifetime, avg_order_value_lifetime".split(", ")
    make = lambda lo, hi: spark.range(lo, hi).selectExpr(
        *[f"cast(id as double) {c}" for c in cols], "1 frequency_30d", "3 frequency_90d", "2 orders_lifetime", "0 tenure_days"
    )
    train, everything = make(0, 101), make(0, 1001)
    fitted = noise.add_noise_reduction_features(everything, fit_on=train).toPandas()
    assert (fitted.monetary_30d.min(), fitted.monetary_30d.max()) == (1.0, 99.0)
    own = noise.add_noise_reduction_features(everything).toPandas()
    assert (own.monetary_30d.min(), own.monetary_30d.max()) == (10.0, 990.0)
    assert set(own.freq_delta_30_vs_90) == {0.0} and set(own.order_rate_lifetime) == {2.0}
    assert own.log_monetary_90d.max() == pytest.approx(np.log1p(990))
