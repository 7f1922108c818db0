from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.operators import boosting, evaluation, registry, training
from orderloom.operators.training import Fold, expanding_folds

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 1500
    a, b = rng.normal(10, 3, n), rng.normal(0, 1, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.8 * (a - 12) - b)))).astype(int)
    rows = [
        (f"c{i}", date(2020, 1 + i % 8, 1), None if i % 50 == 0 else float(a[i]), float(b[i]), int(y[i])) for i in range(n)
    ]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date date, a double, b double, target_1 int")
    return df.cache()


def _auc(scored):
    rows = scored.withColumnRenamed("target_1", "y")
    return evaluation.eval_metrics(rows, keys=training.KEYS).first()["auc"]


def _thirds(pdf):
    """The part of each row: its rank in its class by snapshot and key hash, modulo three."""
    order = pdf.sort_values(["snapshot_date", "h", "customer_id"])
    return (order.groupby("target_1").cumcount() % 3).reindex(pdf.index)


def _hashed(data):
    return data.withColumn("h", F.xxhash64(*training.KEYS)).toPandas()


def test_parts_are_fitted_on_exact_medians_and_reach_the_optimum(data):
    """Against Newton steps on the same penalised, balanced loss, for the rows of each part."""
    model, pdf = training.fit_calibrated_logistic(data, COLUMNS), _hashed(data)
    part = _thirds(pdf)
    assert pdf.groupby(["target_1", part]).size().groupby("target_1").agg(lambda n: n.max() - n.min()).max() <= 1
    for p, fitted in enumerate(model.parts):
        own = pdf[part != p]
        filled = own[COLUMNS].fillna(own[COLUMNS].median())
        assert fitted.stats.median == tuple(own[COLUMNS].median())
        assert fitted.stats.mean == pytest.approx(tuple(filled.mean())) and fitted.stats.std == pytest.approx(tuple(filled.std(ddof=0)))
        x = np.column_stack([(filled - filled.mean()) / filled.std(ddof=0), np.ones(len(own))])
        y = own.target_1.to_numpy()
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
        beta, ridge = np.zeros(3), np.diag([1.0, 1.0, 0.0])
        for _ in range(30):
            q = 1 / (1 + np.exp(-x @ beta))
            beta -= np.linalg.solve(x.T @ (x * (w * q * (1 - q))[:, None]) + ridge, x.T @ (w * (q - y)) + ridge @ beta)
        assert (*fitted.weights, fitted.intercept) == pytest.approx(beta, rel=1e-6, abs=1e-6)


def test_three_positives_in_a_thousand_rows_can_be_fitted(spark):
    rows = [(f"c{i}", date(2020, 1 + i % 4, 1), float(i % 17), float(i % 5), int(i in (100, 500, 900))) for i in range(1000)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date date, a double, b double, target_1 int")
    scored = training.fit_calibrated_logistic(df, COLUMNS).score(df).toPandas()
    assert scored.score.between(0, 1).all()


def test_calibrated_logistic(data):
    scored = training.fit_calibrated_logistic(data, COLUMNS).score(data)
    row = scored.selectExpr("min(score) lo", "max(score) hi", "avg(score) p", "avg(target_1) y").first()
    assert 0 < row["lo"] < row["hi"] < 1
    assert row["p"] == pytest.approx(row["y"], abs=0.02)  # calibration undoes the balancing
    assert _auc(scored) > 0.8


def test_boosted_trees(data):
    scored = training.fit_boosted_trees(data, COLUMNS, max_iter=10).score(data)
    assert _auc(scored) > 0.8
    assert set(scored.columns) == {*data.columns, "score"}


def test_folds_grown_by_level_equal_folds_grown_in_one_task(data):
    """Missing values, several folds, and margins that are written out on the way."""
    days = [date(2020, m, 1) for m in (5, 7)]
    folds = [Fold(f"cv_fold_{i + 1}", date(2020, 1, 1), d) for i, d in enumerate(days)]
    trees = boosting.MARGIN_TREES + 2
    whole = training.fit_boosted_by_fold(data, folds, COLUMNS, trees)
    by_level = training.fit_boosted_by_fold(data, folds, COLUMNS, trees, task_rows=0)
    for a, b in zip(whole, by_level):
        x, y = (m.score(data).orderBy(*training.KEYS).toPandas() for m in (a, b))
        assert len(a.model.trees) == len(b.model.trees) == trees + 1
        assert np.abs(x.score - y.score).max() < 1e-9


def test_growth_stops_when_the_held_rows_stop_improving():
    rng = np.random.default_rng(2)
    layout = boosting.Layout((tuple(np.linspace(-2, 2, 31)),) * 2)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    settings = boosting.Settings(400, 6, 0.3, 50, 255)
    held = np.arange(4000) % 10 == 0
    start, trees = boosting.grow_whole(layout, layout.binned(x), y, held, settings)
    assert 10 < len(trees) < 400
    losses, margin = [], np.full(held.sum(), start)
    for tree in trees:
        margin = margin + tree.values(layout.binned(x)[held])
        losses.append(boosting.loss_sum(y[held], margin))
    assert losses[-1] > min(losses) - 1e-9 and int(np.argmin(losses)) <= len(losses) - settings.patience


def test_a_tree_is_the_best_first_tree():
    """Against growth one leaf at a time, by a plain search over all cuts."""
    rng = np.random.default_rng(3)
    layout = boosting.Layout((tuple(np.linspace(-2, 2, 15)),) * 3)
    bins = layout.binned(rng.normal(size=(900, 3)))
    y = (rng.random(900) < 0.3 + 0.4 * (bins[:, 0] > 8) * (bins[:, 1] > 5)).astype(float)
    settings = boosting.Settings(1, 6, 0.1, 20, 255, leaves=9)
    start, trees = boosting.grow_whole(layout, bins, y, np.zeros(900, bool), settings)
    p = 1 / (1 + np.exp(-start))
    g, h = p - y, np.full(900, p * (1 - p))

    def best(rows):
        found = (0.0, None)
        for j in range(3):
            for cut in range(15):
                low, high = rows[bins[rows, j] <= cut], rows[bins[rows, j] > cut]
                if min(len(low), len(high)) >= 20:
                    gain = sum(g[s].sum() ** 2 / h[s].sum() for s in (low, high)) - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > found[0] + 1e-12:
                        found = (gain, (low, high))
        return found

    leaves = [(np.arange(900), 0)]
    while len(leaves) < 9:
        options = [(best(rows), i) for i, (rows, depth) in enumerate(leaves) if depth < 6]
        (gain, parts), i = max(options, key=lambda o: o[0][0])
        if parts is None:
            break
        _, depth = leaves.pop(i)
        leaves += [(part, depth + 1) for part in parts]
    expected = np.zeros(900)
    for rows, _ in leaves:
        expected[rows] = -0.1 * g[rows].sum() / h[rows].sum()
    assert np.abs(trees[0].values(bins) - expected).max() < 1e-9


def test_unknown_model(data):
    with pytest.raises(ValueError, match="Unknown model name"):
        training.fit_model("forest", data)


def test_one_class_cannot_be_fitted(data):
    with pytest.raises(RuntimeError, match="both classes"):
        training.fit_calibrated_logistic(data.filter("target_1 = 1"), COLUMNS)


def test_expanding_folds():
    days = [date(2020, m, 1) for m in range(1, 6)]
    counts = [(days[0], 0, 5), (days[1], 0, 5), (days[2], 1, 5), (days[3], 0, 5), (days[4], 2, 5)]
    assert expanding_folds(counts, 2) == [Fold("cv_fold_1", days[0], days[3]), Fold("cv_fold_2", days[0], days[4])]
    with pytest.raises(RuntimeError, match="Not enough snapshots"):
        expanding_folds(counts, 5)
    with pytest.raises(RuntimeError, match="No valid CV folds"):
        expanding_folds([(d, 0, 5) for d in days], 2)


def test_rolling_validation_scores_each_later_snapshot_once(data):
    folds, oof = training.rolling_time_cv(data, "logreg_calibrated", 6, columns=COLUMNS, max_iter=20)
    assert [f.validation.month for f in folds] == [7, 8]
    counts = {(r["split_name"], r["snapshot_date"].month): r["count"] for r in oof.groupBy("split_name", "snapshot_date").count().collect()}
    assert set(counts) == {("cv_fold_1", 7), ("cv_fold_2", 8)}
    assert sum(counts.values()) == data.filter("snapshot_date >= '2020-07-01'").count()


def test_best_candidate(spark):
    def best(*rows):
        return registry.best_candidate(spark.createDataFrame(rows, "model_name string, selection_score double"), ["m1", "m2", "m3"])

    assert best(("m1", 1.0), ("m2", 2.0), ("m3", None)) == "m2"
    assert best(("m2", 1.0), ("m1", 1.0)) == "m1"
    assert best(("m1", float("nan")), ("m2", 0.1)) == "m2"


def test_fits_of_all_folds_at_once_equal_fits_one_by_one(spark):
    from orderloom.plans import queries, training as plan

    ds, cfg = queries._training_set(spark, "/root/testdata/sf0.01")
    train = plan._split(ds, cfg)[0]
    folds = training.expanding_folds(training.snapshot_class_counts(train), cfg.min_train_snapshots)
    assert len(folds) == 65
    chosen = [folds[10], folds[-1]]
    for fold, model in zip(chosen, training.fit_calibrated_by_fold(train, chosen)):
        alone = training.fit_calibrated_logistic(train.filter(F.col("snapshot_date") < F.lit(fold.validation)))
        for a, b in zip(model.parts, alone.parts):
            assert a.stats.median == b.stats.median
            assert [*a.stats.mean, *a.stats.std] == pytest.approx([*b.stats.mean, *b.stats.std])
            assert [*a.weights, a.intercept, a.slope, a.offset] == pytest.approx([*b.weights, b.intercept, b.slope, b.offset], abs=1e-6)


def test_scores_of_all_folds_in_one_scan_equal_the_models_one_by_one(data):
    folds, oof = training.rolling_time_cv(data, "logreg_calibrated", 6, columns=COLUMNS)
    models = training.fit_calibrated_by_fold(data, folds, COLUMNS)
    for fold, model in zip(folds, models):
        own = model.score(data.filter(F.col("snapshot_date") == F.lit(fold.validation)))
        got = {r["customer_id"]: r["score"] for r in oof.filter(F.col("split_name") == fold.name).collect()}
        assert {r["customer_id"]: r["score"] for r in own.collect()} == pytest.approx(got, abs=1e-9)


def test_rows_to_boost_are_kept_in_blocks(data):
    """A pass over them moves blocks, not rows; missing values and row order come back."""
    layout = boosting.Layout((tuple(np.linspace(0, 20, 254)), (0.0,)))
    rows = data.coalesce(1).orderBy("customer_id").coalesce(1)
    first = F.month("snapshot_date") - 1
    staged = boosting.binned_rows(rows, layout, COLUMNS, first, F.col("target_1"), F.col("b") > 0)
    assert staged.count() <= 1500 // 100
    blocks = [boosting.Block.of(layout, *(bytes(r[n]) for n in boosting.ROW[1:])) for r in staged.collect()]
    values = rows.toPandas()
    assert np.array_equal(np.concatenate([b.bins for b in blocks]), layout.binned(values[COLUMNS].to_numpy(float)))
    assert np.array_equal(np.concatenate([b.y for b in blocks]), values["target_1"]) and (np.concatenate([b.bins for b in blocks]) == -1).any()


def test_newton_steps_read_blocks_and_calibration_reads_margins(data, monkeypatch):
    """A step moves blocks, not rows. Margins are worked out once: calibration reads one number per row, not all features."""
    newton, read = training._newton, []

    def watched(rows, *rest):
        blocks = rows.collect()
        read.append((len(blocks), sum(len(r["y"]) for r in blocks), sum(len(r["x"]) for r in blocks) // 8))
        return newton(rows, *rest)

    monkeypatch.setattr(training, "_newton", watched)
    training.fit_calibrated_logistic(data, COLUMNS)
    (few, n, features), (also_few, m, margins) = read
    assert max(few, also_few) <= 1500 // 100 and n == m == 1500
    assert (features, margins) == (1500 * len(COLUMNS), 1500)


def test_margins_in_every_step_equal_margins_worked_out_once(data):
    """More folds than features: margins would take more room than features, so they aren't kept."""
    folds = [Fold(f"cv_fold_{i + 1}", date(2020, 1, 1), date(2020, m, 1)) for i, m in enumerate((4, 6, 8))]
    assert len(folds) > len(COLUMNS)
    for fold, model in zip(folds, training.fit_calibrated_by_fold(data, folds, COLUMNS)):
        alone = training.fit_calibrated_logistic(data.filter(F.col("snapshot_date") < F.lit(fold.validation)), COLUMNS)
        for a, b in zip(model.parts, alone.parts):
            assert [*a.weights, a.intercept, a.slope, a.offset] == pytest.approx([*b.weights, b.intercept, b.slope, b.offset], abs=1e-6)


def test_each_fold_has_a_task_of_its_own(data, monkeypatch):
    """Dealt by hash, some tasks got three folds and others none."""

    def seen(layout, settings, fills, sizes):
        def look(batches):
            import pyarrow as pa

            own = sorted({k for b in batches for k in b.column("k").to_pylist()})
            if own:
                columns = [pa.array([v], t) for v, t in zip((own[0], len(own), *[[]] * 5), [pa.int32()] * 2 + [pa.list_(pa.int32())] * 4 + [pa.list_(pa.float64())])]
                yield pa.RecordBatch.from_arrays(columns, ["k", "tree", "feature", "bin", "left", "right", "value"])

        return look

    found = []
    tree = boosting.Tree
    monkeypatch.setattr(boosting, "_fold_grower", seen)
    monkeypatch.setattr(boosting, "Model", lambda layout, fill, trees: trees)
    monkeypatch.setattr(boosting, "Tree", lambda *a: found.append(a) or tree(*a))
    layout = boosting.Layout(((0.5,),) * 2)
    rows = boosting.binned_rows(data, layout, COLUMNS, F.month("snapshot_date") - 1, F.col("target_1"), F.lit(False))
    counts = {k: (1, 10 * (k + 1)) for k in range(12)}
    models = boosting.grow_folds(rows, layout, boosting.Settings(1, 1, 0.1, 1, 2), counts, {k: (0, 0) for k in counts})
    assert sorted(models) == list(range(12)) and len(found) == 12


def test_only_the_smaller_sibling_is_counted(monkeypatch):
    """Six levels of six nodes' rows would be six passes over all rows."""
    rng = np.random.default_rng(4)
    layout = boosting.Layout((tuple(np.linspace(-2, 2, 31)),) * 3)
    bins = layout.binned(rng.normal(size=(5000, 3)))
    y = (rng.random(5000) < 0.1 + 0.02 * bins[:, 0]).astype(float)
    counted = []
    sums = boosting.Coding.sums
    monkeypatch.setattr(boosting.Coding, "sums", lambda self, words, g: counted.append(len(g)) or sums(self, words, g))
    words = boosting.Coding(layout).packed(bins, y)
    _, trees = boosting.grow_packed(boosting.Coding(layout), words, [w[:0] for w in words], boosting.Settings(1, 6, 0.1, 20, 255))
    assert len(trees) == 1 and counted[0] == 5000 and sum(counted[1:]) <= 5 * 5000 / 2


def test_packed_folds_grow_the_trees_of_plain_ones():
    """The same splits, leaves, stop and order, with rows held out."""
    rng = np.random.default_rng(11)
    layout = boosting.Layout((tuple(np.linspace(-2, 2, 120)), tuple(np.linspace(-2, 2, 60)), (0.0,)))
    bins = layout.binned(rng.normal(size=(40_000, 3)))
    y = (rng.random(40_000) < 0.05 + 0.002 * bins[:, 0] + 0.001 * bins[:, 1] * bins[:, 2]).astype(float)
    held, settings, coding = rng.random(40_000) < 0.1, boosting.Settings(25, 6, 0.3, 50, 255), boosting.Coding(layout)
    start, plain = boosting.grow_whole(layout, bins, y, held, settings)
    words = coding.packed(bins, y)
    also, packed = boosting.grow_packed(coding, [w[~held] for w in words], [w[held] for w in words], settings)
    assert also == start and len(packed) == len(plain) > 5
    for a, b in zip(plain, packed):
        assert len(a.feature) == len(b.feature) and np.abs(a.values(bins) - b.values(bins)).max() < 1e-8


def test_packed_folds_equal_folds_grown_by_level(data, monkeypatch):
    days = [date(2020, m, 1) for m in (5, 7)]
    folds = [Fold(f"cv_fold_{i + 1}", date(2020, 1, 1), d) for i, d in enumerate(days)]
    monkeypatch.setattr(boosting, "PLAIN_ROWS", 0)
    packed = training.fit_boosted_by_fold(data, folds, COLUMNS, 4)
    for a, b in zip(packed, training.fit_boosted_by_fold(data, folds, COLUMNS, 4, task_rows=0)):
        assert len(a.model.trees) == len(b.model.trees) == 5
        for x, y in zip(a.model.trees[1:], b.model.trees[1:]):
            assert (x.feature, x.bin, x.left, x.right, x.value) == (y.feature, y.bin, y.left, y.right, y.value)


def test_packed_rows_give_the_sums_of_plain_ones():
    """Bins of many widths, in more than one word, and splits that few rows on a side forbid."""
    rng = np.random.default_rng(6)
    widths = [1, 2, 255, 3, 200, 17, 255, 256, 9, 255, 255, 130]
    layout = boosting.Layout(tuple(tuple(float(i) for i in range(w - 1)) for w in widths))
    bins = np.stack([rng.integers(0, w, 3000) for w in widths], axis=1).astype(np.int16)
    y, coding = (rng.random(3000) < 0.2).astype(float), boosting.Coding(layout)
    words, margin = coding.packed(bins, y), rng.normal(size=3000)
    assert coding.words > 1 and np.array_equal(words[0] < 0, y == 1)
    g = boosting.gradients(margin, y)
    plain = boosting.histograms(layout, bins, np.zeros(3000, int), 1, g, boosting.curvatures(g))[0]
    assert np.array_equal(coding.sums(words, g), plain[:, :2]) and np.array_equal(coding.counts(words), plain[:, 2])
    p = 1 / (1 + np.exp(-margin))
    assert np.abs(g * boosting.UNIT - (p - y)).max() < 1e-9 and np.abs(boosting.curvatures(g) * boosting.UNIT - p * (1 - p)).max() < 2e-9
    for leaf_rows in (1, 40, 700, 1400, 1600):
        expected = boosting.best_splits(layout, (plain * [boosting.UNIT, boosting.UNIT, 1])[None], leaf_rows)[0]
        found = coding.best(words, plain[:, :2], leaf_rows)
        assert (found and (found.gain, found.feature, found.bin)) == (expected and (expected.gain, expected.feature, expected.bin))


def test_newton_sums_of_blocks_equal_sums_row_by_row(monkeypatch):
    """Missing numbers, groups of several folds; rows of a kind in one matrix product and not once per group."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    n, folds = 900, 4
    x = rng.gamma(2.0, 50.0, (n, 2))
    x[::40, 1] = np.nan
    first, y, rank = rng.integers(0, folds, n), rng.integers(0, 2, n), rng.permutation(n)
    batch = pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(y, pa.int32()), pa.array(rank), *map(pa.array, x.T)], ["first", "y", "rank", "x0", "x1"])
    blocks = list(training._packed(iter([batch])))
    groups = [(k, p) for k in range(folds) for p in range(3)]
    scales = training._Scales({(k, p): (np.array([90.0 + k, 80.0 + p]), np.array([100.0 + k, 99.0]), np.array([70.0, 71.0 + p])) for k, p in groups})
    weights = {(k, p): np.array([0.3, -0.1 * p, 0.02 * k]) for k, p in groups}
    balance = {g: (0.6, 2.5) for g in groups}
    calls = []
    linear = training._Step._add_linear
    monkeypatch.setattr(training._Step, "_add_linear", lambda self, total, use, z, *rest: calls.append(len(use)) or linear(self, total, use, z, *rest))

    def found(step):
        return {(r["k"], r["p"]): np.array(r["sums"]) for b in step.sums(iter(blocks)) for r in pa.Table.from_batches([b]).to_pylist()}

    sums = found(training._Step(weights, balance, scales))
    assert max(calls) == 8
    for k, p in groups:
        use = (first <= k) & (rank % 3 != p)
        z, w = scales.scaled((k, p), x[use]), np.where(y[use] == 1, 2.5, 0.6)
        m = z @ weights[k, p]
        q = 1 / (1 + np.exp(-m))
        curve = z.T @ (z * (w * q * (1 - q))[:, None])
        expected = np.concatenate([[(w * (np.logaddexp(0, m) - y[use] * m)).sum()], z.T @ (w * (q - y[use])), curve.ravel()])
        assert sums[k, p] == pytest.approx(expected, rel=1e-9, abs=1e-9)
    targets = {g: (0.01, 0.9) for g in groups}
    sums = found(training._Step({g: np.array([1.2, 0.1]) for g in groups}, targets, margins=training._Margins(folds, scales, weights)))
    for k, p in groups:
        use = (first <= k) & (rank % 3 == p)
        m, t = scales.scaled((k, p), x[use]) @ weights[k, p], np.where(y[use] == 1, 0.9, 0.01)
        z = np.column_stack([m, np.ones(len(m))])
        s = z @ [1.2, 0.1]
        q = 1 / (1 + np.exp(-s))
        expected = np.concatenate([[(np.logaddexp(0, s) - t * s).sum()], z.T @ (q - t), (z.T @ (z * (q * (1 - q))[:, None])).ravel()])
        assert sums[k, p] == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_the_fit_on_all_rows_runs_beside_the_folds():
    from threading import Barrier

    from orderloom.plans.training import side_by_side

    met = Barrier(2, timeout=20)
    assert side_by_side(lambda: (met.wait(), 1)[1], lambda: (met.wait(), 2)[1]) == [1, 2]
