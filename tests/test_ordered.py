import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom.functions import quantiles
from orderloom.functions.ordered import running_sums
from orderloom.functions.quantiles import exact_quantiles, grouped_quantiles, quantile_bin


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_sums_per_group(spark, ranges):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 300, p=[0.9, 0.1]), "x": rng.permutation(300), "v": rng.integers(0, 9, 300)})
    out = running_sums(spark.createDataFrame(pdf), ["x"], ["v"], ["g"], ranges).toPandas().sort_values(["g", "x"])
    pdf = pdf.sort_values(["g", "x"])
    assert out["cum_v"].tolist() == pdf.groupby("g")["v"].cumsum().tolist()
    assert out["total_v"].tolist() == pdf.groupby("g")["v"].transform("sum").tolist()


def test_running_sums_read_their_input_once(spark):
    """Rows that pass on their way into the aggregation are counted."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    counts = spark.range(1000).mapInArrow(count, "id long").groupBy((F.col("id") % 97).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    out = running_sums(counts, ["x"], ["n"])
    assert out.agg(F.max("cum_n")).first()[0] == 1000 and out.count() == 97
    assert passed.value == 1000


values = st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_exact_quantiles(spark, xs):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "x double")
    got = exact_quantiles(df, ["x"], probs).first()["quantiles"]
    assert got == pytest.approx(np.quantile(xs, probs), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("driver_rows", [40, 1 << 16])
def test_grouped_quantiles(spark, driver_rows):
    """Groups that share atoms, skewed values, ties, an all-missing group; few driver rows force many passes."""
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"t": rng.integers(0, 6, 900), "x": np.exp(rng.normal(0, 6, 900)), "y": rng.integers(-3, 3, 900).astype(float)})
    pdf.loc[::7, "x"] = np.nan
    pdf.loc[pdf.t == 0, "y"] = np.nan
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = grouped_quantiles(spark.createDataFrame(pdf), ["x", "y"], probs, ["t"], lambda a: range(a[0], 6), driver_rows)
    for g in range(6):
        own = pdf[pdf.t <= g]
        for c in ("x", "y"):
            if own[c].notna().any():
                assert got[g, c] == pytest.approx(np.quantile(own[c].dropna(), probs), rel=1e-12)
            else:
                assert (g, c) not in got


def test_quantiles_exchange_no_values(spark):
    """A pass over many values shuffles cells, and only a bounded rest of values."""
    df = spark.range(300_000).select(F.xxhash64("id").cast("double").alias("x"))
    got = exact_quantiles(df, ["x"], [0.25, 0.5]).first()["quantiles"]
    assert got == pytest.approx(np.quantile([r.x for r in df.collect()], [0.25, 0.5]), rel=1e-12)


@pytest.mark.parametrize("seed,decimals", [(0, 6), (1, 1), (2, 0)])
def test_bins_follow_quantile_cut(spark, seed, decimals):
    xs = np.round(np.random.default_rng(seed).normal(size=400), decimals)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    edges = exact_quantiles(df, ["x"], [float(q) for q in np.linspace(0, 1, 11)]).select("quantiles").scalar()
    got = df.withColumn("e", edges).select("x", quantile_bin(F.col("x"), F.col("e")).alias("b")).toPandas()
    expected = pd.qcut(pd.Series(xs), 10, labels=False, duplicates="drop") + 1
    assert dict(zip(got.x, got.b)) == dict(zip(xs, expected))


def test_quantiles_count_values_in_arrow_batches(spark):
    """Not by a binary search in an expression; missing values and both zeros."""
    values = [None, float("nan"), -0.0, 0.0, -3.5, 1.5, 2.5, 1e308, -1e308, 0.0]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "t int, v double")
    found = grouped_quantiles(df, ["v"], [0.0, 0.5, 1.0], ["t"], lambda atom: [atom[0], "both"])
    assert found["both", "v"] == [-1e308, 0.0, 1e308] and found[0, "v"] == [-1e308, -1.75, 2.5] and found[1, "v"] == [0.0, 0.75, 1e308]
    counted = quantiles._Pass([(0, (0.0, 2.0)), (0, (2.25, 3.0))]).counts(df, ["t"], ["v"], 4)
    assert "MapInArrow" in counted._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r["atom0"], r["i"], r["cell"], r["n"], r["lo"], r["hi"]) for r in counted.collect())
    assert rows == [(0, 0, 0, 1, 0.0, 0.0), (0, 1, 1, 1, 2.5, 2.5), (1, 0, 0, 2, 0.0, 0.0), (1, 0, 3, 1, 1.5, 1.5)]
