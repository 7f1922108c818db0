from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from orderloom.operators import snapshots
from orderloom.operators.snapshots import build_snapshot_dataset

TX = "customer_id string, order_id string, order_date date, order_revenue decimal(18,2)"


def brute_force(tx, horizon=30, lookback=120, min_orders=2):
    """The definition, one snapshot and one customer at a time."""
    tx = pd.DataFrame(tx, columns=["c", "o", "d", "r"])
    tx["r"] = tx["r"].astype(float)
    start, end = tx.d.min() + timedelta(days=120), tx.d.max() - timedelta(days=horizon)
    snaps = [t.date() for t in pd.date_range(start, end, freq="MS")]
    if len(snaps) < 6:
        snaps = [start + timedelta(days=14 * k) for k in range((end - start).days // 14 + 1)]
    out = {}
    for s in snaps:
        for c, rows in tx.groupby("c"):
            past = rows[rows.d <= s]
            if past.empty or (s - past.d.max()).days > lookback or past.o.nunique() < min_orders:
                continue
            w30, w90 = past[past.d > s - timedelta(days=30)], past[past.d > s - timedelta(days=90)]
            future = rows[(rows.d > s) & (rows.d <= s + timedelta(days=horizon))]
            out[c, s] = (
                past.d.max(), past.d.min(), past.o.nunique(), w30.o.nunique(), w90.o.nunique(),
                round(w30.r.sum(), 2), round(w90.r.sum(), 2), round(past.r.sum(), 2), int(len(future) > 0),
            )
    return out


def computed(spark, tx, **options):
    rows = build_snapshot_dataset(spark.createDataFrame(tx, TX), **options).collect()
    return {
        (r["customer_id"], r["snapshot_date"]): (
            r["last_order_date"], r["first_order_date"], r["orders_lifetime"], r["frequency_30d"], r["frequency_90d"],
            round(r["monetary_30d"], 2), round(r["monetary_90d"], 2), round(r["monetary_lifetime"], 2), r["target_1"],
        )
        for r in rows
    }


def random_orders(seed, days, n, returning=0.0):
    rng = np.random.default_rng(seed)
    tx = [("first", "x0", date(2019, 12, 15), Decimal(1)), ("last", "x1", date(2019, 12, 15) + timedelta(days=days), Decimal(1))]
    for i in range(n):
        order = f"o{rng.integers(0, i + 1)}" if rng.random() < returning else f"o{i}"
        tx.append(
            (f"c{rng.integers(0, 8)}", order, date(2019, 12, 15) + timedelta(days=int(rng.integers(0, days + 1))),
             Decimal(int(rng.integers(-500, 9000))) / 100)
        )
    return tx


@pytest.mark.parametrize("seed", [1, 2])
def test_month_starts(spark, seed):
    tx = random_orders(seed, 500, 150)
    expected = brute_force(tx)
    assert len(expected) > 40
    assert computed(spark, tx) == expected


def test_fourteen_day_steps_when_months_are_few(spark):
    tx = random_orders(3, 260, 90)
    assert computed(spark, tx) == brute_force(tx)


def test_order_ids_on_several_dates_and_lines(spark):
    tx = random_orders(4, 450, 200, returning=0.4)
    tx += tx[20:60]  # further lines of the same order and day
    assert computed(spark, tx, active_lookback_days=60, min_orders_lifetime=3, horizon_days=45) == brute_force(tx, 45, 60, 3)


def test_bounds(spark):
    snap = date(2020, 9, 1)
    offsets = {"at": 0, "m30": -30, "m29": -29, "m90": -90, "m89": -89, "p1": 1, "p30": 30, "p31": 31, "m120": -120, "m121": -121}
    tx = [("edge", "e0", date(2020, 1, 1), Decimal(1)), ("edge", "e1", date(2021, 6, 1), Decimal(1))]
    for name, days in offsets.items():
        tx += [(name, f"{name}a", snap + timedelta(days=days), Decimal(5)), (name, f"{name}b", date(2020, 1, 2), Decimal(1))]
        if days > 0:
            tx.append((name, f"{name}c", snap, Decimal(2)))
    got = {c: v for (c, s), v in computed(spark, tx).items() if s == snap}
    assert {c: got[c][3] for c in ("at", "m30", "m29")} == {"at": 1, "m30": 0, "m29": 1}
    assert {c: got[c][4] for c in ("m90", "m89")} == {"m90": 0, "m89": 1}
    assert {c: got[c][8] for c in ("at", "p1", "p30", "p31")} == {"at": 0, "p1": 1, "p30": 1, "p31": 0}
    assert "m120" in got and "m121" not in got
    assert computed(spark, tx) == brute_force(tx)


def test_short_span_is_an_error(spark):
    tx = [("a", "1", date(2020, 1, 1), Decimal(1)), ("a", "2", date(2020, 5, 30), Decimal(1))]
    with pytest.raises(Exception, match="Not enough date span"):
        computed(spark, tx)


def test_no_nested_loop_and_one_customer_shuffle(spark):
    tx = spark.createDataFrame(random_orders(1, 500, 50), TX)
    plan = build_snapshot_dataset(tx)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_splits(spark):
    ds = spark.createDataFrame([(date(2020, m, 1),) for m in range(1, 13)] * 2, "snapshot_date date")
    split = {r["snapshot_date"].month: r["split"] for r in snapshots.snapshot_splits(ds).collect()}
    assert [m for m, s in sorted(split.items()) if s == "holdout"] == [8, 9, 10, 11, 12]
    with pytest.raises(Exception, match="Not enough snapshots left"):
        snapshots.snapshot_splits(ds, holdout_snapshots=7).collect()
