import numpy as np
import pytest

from orderloom.operators import evaluation

SCORED = "customer_id string, y int, score double"


def _frame(spark, y, s):
    return spark.createDataFrame([(f"k{i:04d}", int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], SCORED)


def expected_metrics(y, s, fraction):
    """From the definitions, pair by pair and cut by cut."""
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    pos, neg = s[y == 1], s[y == 0]
    auc = pr = None
    if len(pos) and len(neg):
        auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
        recall = pr = 0.0
        for t in sorted(set(s), reverse=True):
            hit = s >= t
            r = y[hit].sum() / y.sum()
            pr += (r - recall) * y[hit].mean()
            recall = r
    k = max(1, int(len(s) * fraction))
    top = sorted(range(len(s)), key=lambda i: (-s[i], i))[:k]
    rate = y[top].mean()
    base = y.mean()
    return auc, pr, rate, rate / base if base else None, base, float(len(y))


CASES = {
    "continuous": lambda g: (g.random(120) < 0.3, g.random(120), 0.1),
    "heavy_ties": lambda g: (g.random(200) < 0.4, g.integers(0, 4, 200) / 4, 0.25),
    "all_equal": lambda g: (g.random(50) < 0.5, np.full(50, 0.5), 0.2),
    "only_negatives": lambda g: (np.zeros(20), g.random(20), 0.1),
    "only_positives": lambda g: (np.ones(20), g.random(20), 0.1),
    "k_rounds_to_zero": lambda g: (np.array([0, 1, 1]), np.array([0.1, 0.9, 0.2]), 0.1),
}


@pytest.mark.parametrize("case", CASES)
def test_metrics(spark, case):
    y, s, fraction = CASES[case](np.random.default_rng(7))
    row = evaluation.eval_metrics(_frame(spark, y, s), fraction).first()
    for got, want in zip(row, expected_metrics(np.asarray(y, int), s, fraction)):
        assert got == (None if want is None else pytest.approx(want))


def test_lift_without_positives_can_be_zero(spark):
    row = evaluation.eval_metrics(_frame(spark, [0, 0], [0.1, 0.2]), lift_without_positives=0.0).first()
    assert row["lift_at_k"] == 0.0


def test_groups_are_evaluated_apart(spark):
    g = np.random.default_rng(3)
    a, b = (g.random(60) < 0.5, g.integers(0, 5, 60) / 5), (g.random(30) < 0.2, g.random(30))
    both = _frame(spark, *a).selectExpr("*", "'a' g").unionByName(_frame(spark, *b).selectExpr("*", "'b' g"))
    rows = {r["g"]: tuple(r)[1:] for r in evaluation.eval_metrics(both, 0.2, by=["g"]).collect()}
    assert rows["a"] == pytest.approx(expected_metrics(np.asarray(a[0], int), a[1], 0.2))
    assert rows["b"] == pytest.approx(expected_metrics(np.asarray(b[0], int), b[1], 0.2))


def expected_threshold(y, s):
    best, best_f1 = 0.5, -1.0
    for t in np.linspace(0.05, 0.95, 19):
        hit = s >= t
        tp = (hit & (y == 1)).sum()
        p, r = tp / hit.sum() if hit.any() else 0.0, tp / (y == 1).sum() if (y == 1).any() else 0.0
        f1 = 2 * p * r / (p + r) if p + r else 0.0
        if f1 > best_f1:
            best, best_f1 = float(t), f1
    return best


@pytest.mark.parametrize("seed", range(3))
def test_threshold(spark, seed):
    g = np.random.default_rng(seed)
    s = g.random(80)
    y = (g.random(80) < s).astype(int)
    assert evaluation.choose_threshold(_frame(spark, y, s)).first()["threshold"] == expected_threshold(y, s)


def test_threshold_grid_is_exact(spark):
    """0.4 of the grid is really a hair below 0.4, so both rows reach it."""
    y, s = np.array([1, 1, 0]), np.array([0.39999999999999997, 0.4, 0.36])
    assert evaluation.choose_threshold(_frame(spark, y, s)).first()["threshold"] == expected_threshold(y, s)
    assert evaluation.choose_threshold(_frame(spark, [0, 0], [0.2, 0.7])).first()["threshold"] == 0.05


def test_one_score_is_one_bin(spark):
    df = _frame(spark, [0, 1, 1, 1], [0.25] * 4)
    dec = evaluation.decile_diagnostics(df).collect()
    assert [(r["decile"], r["positive_rate"], r["sample_size"]) for r in dec] == [(1, 0.75, 4)]
    cal = evaluation.calibration_by_bin(df).collect()
    assert [(r["bin"], r["abs_gap"]) for r in cal] == [(1, 0.5)]


def test_brier(spark):
    assert evaluation.brier_score(_frame(spark, [0, 1], [0.5, 0.9])).first()[0] == pytest.approx(0.13)


def test_long_metrics_skip_missing_values(spark):
    wide = spark.createDataFrame([("m", 0.5, float("nan"), None)], "model_name string, auc double, pr_auc double, lift_at_k double")
    rows = evaluation.long_metrics(wide, ["model_name"], ["auc", "pr_auc", "lift_at_k"]).collect()
    assert rows == [("m", "auc", 0.5)]


def test_plan_has_no_nested_loop(spark):
    plan = evaluation.eval_metrics(_frame(spark, [0, 1], [0.1, 0.2]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
