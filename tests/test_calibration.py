"""Sampling, calibration and status against plain pandas."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators.calibration import buying_power_check, stop_coefficients
from barlab.operators.describe import approximate_quantiles, describe_columns, exact_quantiles, wide_quantiles
from barlab.operators.evaluate import classification_metrics
from barlab.operators.quality import check_bars, keep_good, liquid_bars
from barlab.operators.sampling import hash_sample
from barlab.operators.calibration import Calibration
from barlab.plans.calibrate import admitted_universe, calibrate
from tests.conftest import to_spark, walk


def drawn(symbol, bars, n, seed):
    key = lambda b: (hashlib.md5(f"{symbol}:{b}:{seed}".encode()).hexdigest(), b)
    return sorted(bars, key=key)[:n]


@pytest.mark.parametrize("n", [1, 40, 5000])
def test_sample_depends_on_keys_only(spark, n):
    frame = pd.concat([walk("HOT", 3000, 1), walk("B", 30, 2)])
    df = to_spark(spark, frame).select("symbol", "bar_no", "close")
    one = {tuple(r) for r in hash_sample(df, n, 42).collect()}
    two = {tuple(r) for r in hash_sample(df.repartition(13, "close"), n, 42).collect()}
    want = {(s, b) for s, d in frame.groupby("symbol") for b in drawn(s, d.bar_no.tolist(), n, 42)}
    assert one == two and {(s, b) for s, b, _ in one} == want


def calibrated(d, p):
    """Coefficient and buying power of one symbol, by loops."""
    low, high, close = d.low.to_numpy(), d.high.to_numpy(), d.close.to_numpy()
    previous = d.close.shift()
    tr = pd.concat([d.high - d.low, (d.high - previous).abs(), (d.low - previous).abs()], axis=1).max(axis=1)
    atr = tr.rolling(50).mean().round(8).to_numpy()
    er = ((d.close - d.close.shift(10)) / d.close.diff().abs().rolling(10).sum()).round(8).to_numpy()
    n, symbol = len(d), d.symbol.iloc[0]
    tradable = [i for i in range(50, n - 20) if p.prices[0] <= close[i] <= p.prices[1]]
    candidates = [i for i in tradable if er[i] > p.momentum_above]
    kept = [
        c for i in drawn(symbol, candidates, p.drops, 42)
        if atr[i] > 0 and (c := (close[i] - low[i + 1:i + 21].min()) / atr[i]) > 0
    ]
    median = float(np.median(kept)) if len(candidates) >= 30 and len(kept) >= 30 else None
    sample = drawn(symbol, tradable, p.entries, 7)
    return len(candidates), len(kept), median, sample, close, atr


def test_calibration_equals_loops(spark):
    p = Calibration(drops=100, entries=80, prices=(1.0, 14.0))
    frame = pd.concat([walk("A", 3000, 1), walk("B", 900, 2), walk("C", 200, 3), walk("D", 20, 4)], ignore_index=True)
    df = to_spark(spark, frame)
    got = {r["symbol"]: r for r in stop_coefficients(df, p, block=1024).collect()}
    assert set(got) == set("ABCD")
    csl = spark.createDataFrame([("A", 2.0), ("B", 2.5)], "symbol string, csl double")
    power = {r["symbol"]: r for r in buying_power_check(df, csl, p, block=1024).collect()}
    assert set(power) == set("AB")
    for s, d in frame.groupby("symbol"):
        n, k, median, sample, close, atr = calibrated(d.reset_index(drop=True), p)
        assert (got[s]["n_candidates"], got[s]["n_kept"]) == (n, k)
        assert got[s]["csl_median"] == (None if median is None else pytest.approx(median, abs=1e-9))
        assert (got[s]["csl"] is not None) == (median is not None and 1.5 <= median <= 3.0)
        if s in power:
            c = {"A": 2.0, "B": 2.5}[s]
            bp = [close[i] * (100 / (c * atr[i])) for i in sample if atr[i] > 0]
            assert power[s]["n_samples"] == len(bp)
            assert power[s]["bp_median"] == pytest.approx(np.median(bp))
            assert power[s]["bp_max"] == pytest.approx(max(bp))


def test_every_symbol_gets_a_status(spark):
    frame = pd.concat([walk("A", 3000, 1), walk("D", 20, 4)], ignore_index=True)
    universe = spark.createDataFrame([("A",), ("D",), ("NONE",)], "symbol string")
    wide = Calibration(accepted=(0.0, 1e9), median_power=(0.0, 1e9), most_power=1e9)
    cases = [
        (wide, None),
        (Calibration(accepted=(0.0, 1e-9)), "csl_rejected"),
        (Calibration(accepted=(0.0, 1e9), most_power=0.0), "bp_rejected"),
    ]
    for p, error in cases:
        table = calibrate(to_spark(spark, frame), universe, p)
        got = {r["symbol"]: (r["error"], r["admitted"]) for r in table.collect()}
        assert got == {"A": (error, error is None), "D": ("insufficient_data", False), "NONE": ("insufficient_data", False)}
        assert [r["ticker"] for r in admitted_universe(table).collect()] == (["A"] if error is None else [])


def test_quality(spark):
    frame = pd.concat([walk("A", 100, 1), walk("B", 99, 2)])
    df = to_spark(spark, frame).drop("n_bars")
    assert {r["symbol"]: r["ok"] for r in check_bars(df).collect()} == {"A": True, "B": False}
    assert keep_good(df, 100).select("symbol").distinct().collect() == [("A",)]
    assert keep_good(to_spark(spark, frame), 100).count() == 100
    assert not check_bars(df.drop("low")).first()["ok"] and keep_good(df.drop("low")).count() == 0
    means = frame[frame.symbol == "A"].volume.rolling(63).mean()
    assert liquid_bars(to_spark(spark, frame), 63, 500.0).filter("symbol = 'A'").count() == (means >= 500).sum()


def test_quantiles_of_large_groups(spark):
    rng = np.random.RandomState(5)
    frame = pd.DataFrame({
        "symbol": ["HOT"] * 6000 + ["B"] * 50 + ["ONE"],
        # Half of the large group shares one value.
        "value": np.r_[np.where(rng.rand(6000) < 0.5, 3.0, rng.randn(6000) * 10), rng.rand(50), 7.0],
    })
    frame["bar_no"] = frame.groupby("symbol").cumcount()
    rows = [(s, float(v), int(b)) for s, v, b in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "symbol string, value double, bar_no long")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    want = frame.groupby("symbol").value.quantile(probs).unstack()
    ways = [exact_quantiles(df, ["symbol"], probs, few=10), exact_quantiles(df, ["symbol"], probs), exact_quantiles(df, ["symbol"], probs, few=10_000)]
    for way in ways:
        got = way.toPandas().set_index("symbol")
        for i, q in enumerate(probs):
            assert np.allclose(got[f"q{i}"].loc[want.index], want[q])


def test_quantiles_of_a_symbol_with_a_million_bars(spark):
    """No group is gathered: what is sorted is a few hundredths of the values, also where most share one."""
    rows = spark.range(1_000_000).select(
        F.lit("HOT").alias("symbol"), (F.pmod(F.col("id") * 7_919, F.lit(1_000_003)) / 7).alias("a"),
        F.when(F.col("id") % 5 > 0, 2.5).otherwise(F.pmod(F.col("id") * 31, F.lit(997)).cast("double")).alias("b"), F.lit(1.0).alias("c"),
        F.when(F.col("id") % 2_000 == 0, F.col("id").cast("double")).alias("d"),
    ).unionByName(spark.range(40).select(F.lit("B").alias("symbol"), *[F.col("id").cast("double").alias(c) for c in "abcd"]))
    probs = [0.001, 0.25, 0.5, 0.999]
    frame = rows.toPandas()
    got = wide_quantiles(rows, ["symbol"], list("abcd"), probs).toPandas().set_index(["symbol", "feature"])
    for (s, f), r in got.iterrows():
        x = frame[frame.symbol == s][f].dropna()
        assert np.allclose([r[f"q{i}"] for i in range(4)], x.quantile(probs)) and r["count"] == len(x)
    assert len(got) == 8


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    """Brackets without any width still give exact quantiles."""
    rows = spark.range(5_000).select(F.lit("A").alias("symbol"), F.pmod(F.col("id") * 17, F.lit(5_003)).cast("double").alias("value"))
    x = pd.Series([r.value for r in rows.collect()])
    got = wide_quantiles(rows, ["symbol"], ["value"], [0.1, 0.5], few=10, reach=0.00001).first()
    assert (got.q0, got.q1) == (pytest.approx(x.quantile(0.1)), pytest.approx(x.quantile(0.5)))


@pytest.mark.parametrize("accuracy", [20, 1_000])
def test_approximate_quantiles_keep_their_rank_error(spark, accuracy):
    rows = spark.range(200_000).repartition(9).select((F.col("id") % 3).alias("g"), F.pmod(F.col("id") * 104_729, F.lit(65_537)).cast("double").alias("value"))
    frame = rows.toPandas()
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    for r in approximate_quantiles(rows, ["g"], probs, accuracy).collect():
        x = frame[frame.g == r.g].value
        for i, p in enumerate(probs):
            v = r[f"q{i}"]
            assert (x < v).mean() - 1 / accuracy <= p <= (x <= v).mean() + 1 / accuracy and (x == v).any()


def test_describe_both_ways(spark):
    frame = pd.concat([walk("A", 900, 1), walk("B", 80, 2)])
    frame.loc[frame.bar_no % 9 == 0, "volume"] = np.nan
    df = to_spark(spark, frame)
    wide = describe_columns(df, ["close", "volume"]).toPandas().set_index(["symbol", "feature"]).sort_index()
    split = describe_columns(df, ["close", "volume"], few=100).toPandas().set_index(["symbol", "feature"]).sort_index()
    for s, d in frame.groupby("symbol"):
        for c in ("close", "volume"):
            want = d[c].describe().to_numpy()
            for got in (wide, split):
                row = got.loc[(s, c), ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]]
                assert np.allclose(row.astype(float), want)


def test_auc_counts_ties_half(spark):
    rows = [("a", 1, 0.9), ("a", 1, 0.5), ("a", 0, 0.5), ("a", 0, 0.1), ("b", 1, 0.3)]
    got = {r["g"]: r for r in classification_metrics(
        spark.createDataFrame(rows, "g string, label int, score double"), ["g"]).collect()}
    assert got["a"]["auc"] == 0.875 and got["a"]["precision"] == pytest.approx(2 / 3) and got["a"]["recall"] == 1
    assert got["b"]["auc"] is None and got["b"]["recall"] == 0
