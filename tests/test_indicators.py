"""Indicators against pandas formulas, with and without blocks."""

import re

import numpy as np
import pandas as pd
import pytest

from barlab.operators import indicators as ind
from barlab.operators.features import feature_columns, feature_frame, momentum_entries, with_atr_alias
from barlab.operators.recipes import with_indicators
from barlab.operators.scan import ema
from barlab.params import FEATURE_COLUMNS
from tests.conftest import to_spark, walk

SMALL = 1024


def formulas(d: pd.DataFrame) -> pd.DataFrame:
    c, h, l, o, v = d.close, d.high, d.low, d.open, d.volume
    out = d[["symbol", "bar_no"]].copy()
    previous = c.shift()
    tr = pd.concat([h - l, (h - previous).abs(), (l - previous).abs()], axis=1).max(axis=1)
    move = c.diff()
    gain = move.where(move > 0, 0).rolling(14).mean().round(12)
    loss = (-move.where(move < 0, 0)).rolling(14).mean().round(12)
    out["RSI_14"] = 100 - 100 / (1 + gain / loss)
    out["ATR_50"] = tr.rolling(50).mean()
    for n in (20, 50):
        out[f"EMA_{n}"] = c.ewm(span=n, adjust=False).mean()
        out[f"dist_ema{n}_pct"] = (c - out[f"EMA_{n}"]) / out[f"EMA_{n}"] * 100
    out["VWAP_20"] = ((h + l + c) / 3 * v).rolling(20).sum() / v.rolling(20).sum()
    out["MACD_line"] = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    out["MACD_signal"] = out.MACD_line.ewm(span=9, adjust=False).mean()
    out["RVOL_20"] = v / v.rolling(20).mean()
    out["ER_Kaufman_10"] = (c - c.shift(10)) / c.diff().abs().rolling(10).sum()
    out["Gap_pct"] = (o - previous) / previous
    up, down = h - h.shift(), l.shift() - l
    plus = up.where((up > down) & (up > 0), 0).ewm(span=14, adjust=False).mean()
    minus = down.where((down > up) & (down > 0), 0).ewm(span=14, adjust=False).mean()
    total = (plus + minus).replace(0, np.nan)
    out["ADX_14"] = 100 * ((plus - minus).abs() / total).ewm(span=14, adjust=False).mean()
    out["Momentum_10"] = c / c.shift(10) - 1
    out["Volatility_20"] = c.pct_change(fill_method=None).rolling(20).std() * np.sqrt(252)
    out["SMA_10"] = c.rolling(10).mean()
    mid, std = c.rolling(20).mean(), c.rolling(20).std()
    out["dist_bb_upper_pct"] = (c - (mid + 2 * std)) / mid * 100
    out["dist_bb_lower_pct"] = (c - (mid - 2 * std)) / mid * 100
    return out


def raw(spark, frame, block):
    from barlab.operators.features import raw_features

    return raw_features(to_spark(spark, frame), block).toPandas().sort_values(["symbol", "bar_no"])


def compare(got, want, columns, tolerance=1e-8):
    both = got.merge(want, on=["symbol", "bar_no"], suffixes=("", "_want"))
    assert len(both) == len(want)
    for c in columns:
        a, b = both[c].astype(float), both[c + "_want"].astype(float)
        assert (a.isna() == b.isna()).all(), c
        assert np.nanmax(np.abs(a - b)) < tolerance, c


@pytest.fixture(scope="module")
def bars():
    return pd.concat([walk("A", 5000, 1), walk("B", 1500, 2), walk("C", 60, 3), walk("D", 1, 4)], ignore_index=True)


@pytest.mark.parametrize("block", [SMALL, 2 * SMALL, 32768])
def test_features_equal_formulas_for_any_block(spark, bars, block):
    want = pd.concat([formulas(d) for _, d in bars.groupby("symbol")])
    compare(raw(spark, bars, block), want, [c for c in want if c not in ("symbol", "bar_no")])


def test_missing_closes(spark):
    frame = walk("A", 2500, 5)
    rng = np.random.RandomState(0)
    frame.loc[rng.choice(2500, 200, replace=False), "close"] = np.nan
    frame.loc[:4, "close"] = np.nan
    want = formulas(frame)
    columns = ["EMA_20", "EMA_50", "MACD_line", "ATR_50", "SMA_10", "ER_Kaufman_10", "Volatility_20", "RSI_14"]
    compare(raw(spark, frame, SMALL), want, columns, 1e-8)


@pytest.mark.parametrize("span", [2, 3, 9, 50, 120])
def test_ema_spans_and_nulls(spark, span):
    frame = walk("A", 4200, 6)
    frame.loc[frame.index % 7 == 3, "volume"] = np.nan
    frame.loc[:10, "volume"] = np.nan
    df = to_spark(spark, frame)
    for block in (SMALL * 2, 32768):
        got = with_indicators(df, ema("volume", span, "y"), ema("close", span, "z", dense=True), block=block)
        got = got.toPandas().sort_values("bar_no").reset_index(drop=True)
        want = frame.volume.ewm(span=span, adjust=False).mean()
        assert (got.y.isna() == want.isna()).all()
        assert np.nanmax(np.abs(got.y - want)) < 1e-8
        assert np.abs(got.z - frame.close.ewm(span=span, adjust=False).mean()).max() < 1e-9


@pytest.mark.parametrize("block", [SMALL, 32768])
def test_ema_over_gaps_of_any_length(spark, block):
    """Runs over several blocks, one up to the end, and stretches where two of three values are missing."""
    frame = walk("A", 9_000, 16)
    for a, b in ((0, 30), (1_500, 2_600), (3_000, 7_300), (8_000, 9_000)):
        frame.loc[a : b - 1, "close"] = np.nan
    frame.loc[(frame.index > 300) & (frame.index % 3 != 1), "close"] = np.nan
    other = walk("B", 1_200, 17)
    other["close"] = np.nan
    df = to_spark(spark, pd.concat([frame, other]))
    ewm = lambda x, span: x.ewm(span=span, adjust=False).mean()
    line = ewm(frame.close, 12) - ewm(frame.close, 26)
    one = with_indicators(df, ema("close", 9, "y"), block=block).toPandas()
    all_three = with_indicators(df, ind.macd(), block=block).toPandas()
    for got, c, want in ((one, "y", ewm(frame.close, 9)), (all_three, "MACD_line", line), (all_three, "MACD_signal", ewm(line, 9))):
        have = got[got.symbol == "A"].sort_values("bar_no").reset_index(drop=True)[c].astype(float)
        assert (have.isna() == want.isna()).all()
        assert np.nanmax(np.abs(have - want)) < 1e-8
        assert got[got.symbol == "B"][c].isna().all() and len(got) == 10_200


@pytest.mark.parametrize("span, every", [(400, 150), (200, 90), (5, 700), (3_000, 1), (50, 5_000)])
def test_ema_of_sparse_values_over_many_blocks(spark, span, every):
    """What is left of a value after several blocks, and values that lie blocks apart."""
    frame = walk("A", 9_000, 18)
    frame.loc[frame.bar_no % every != every // 2, "close"] = np.nan
    got = with_indicators(to_spark(spark, frame), ema("close", span, "y"), block=SMALL).toPandas().sort_values("bar_no")
    want = frame.close.ewm(span=span, adjust=False).mean()
    have = got.y.astype(float).reset_index(drop=True)
    assert (have.isna() == want.isna()).all() and np.nanmax(np.abs(have - want)) < 1e-8


def test_gaps_take_one_shuffle_of_the_bars(spark):
    """The bars go to their blocks once, and the averaged column once more to sum the blocks up, for all three averages."""
    from barlab.session import stage

    df = stage(to_spark(spark, walk("A", 3_000, 19)), "gaps")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = with_indicators(df, ind.macd(), block=SMALL)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [line for line in plan.splitlines() if "ReusedExchange" not in line]
    assert sum(bool(re.search(r"- Exchange hashpartitioning\(symbol#\d+, blk#", line)) for line in lines) == 2
    scans = [line for line in lines if "FileScan" in line]
    assert len(scans) == 2 and re.search(r"FileScan parquet \[symbol#\d+,close#\d+,bar_no#\d+L\]", scans[1])
    assert "Python" not in plan


def test_flat_prices_and_no_volume(spark):
    frame = walk("A", 80, 7)
    frame[["open", "high", "low", "close"]] = 5.0
    frame["volume"] = 0.0
    got = raw(spark, frame, 32768)
    assert got[["RSI_14", "VWAP_20", "RVOL_20", "ER_Kaufman_10", "ADX_14"]].isna().all().all()
    assert (got.ATR_50.dropna() == 0).all() and (got.Volatility_20.dropna() == 0).all()


def test_frozen_price_keeps_adx(spark):
    frame = walk("A", 4000, 8)
    for c in ("open", "high", "low", "close"):
        frame.loc[500:3500, c] = frame.loc[500, c]
    columns = ["open", "high", "low", "close", "volume"]
    got = feature_frame(to_spark(spark, frame), SMALL * 2).toPandas().sort_values("ts")
    want = formulas(frame).ADX_14.iloc[-len(got):].to_numpy()
    assert len(got) == 4000 - 49 and set(columns) <= set(got)
    before, after = got.ADX_14.iloc[:1500], got.ADX_14.iloc[-200:]
    assert np.abs(before - want[:1500]).max() < 1e-6
    assert np.abs(after - want[-200:]).max() < 1e-6


def test_windows_are_full(spark):
    df = to_spark(spark, walk("A", 14, 9))
    got = with_indicators(df, ind.atr(14), ind.sma("close", 15, "S")).toPandas().sort_values("bar_no")
    assert got.ATR.notna().tolist() == [False] * 13 + [True]
    assert got.S.isna().all()


def linear():
    i = np.arange(120)
    return pd.DataFrame({
        "symbol": "L", "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(i, unit="h"), "open": 10 + 0.01 * i,
        "high": 10.5 + 0.01 * i, "low": 9.5 + 0.01 * i, "close": 10 + 0.01 * i, "volume": 1000.0,
        "bar_no": i, "n_bars": 120,
    })


def test_linear_bars(spark):
    frame = with_atr_alias(feature_frame(to_spark(spark, linear())))
    got = frame.toPandas().sort_values("bar_no")
    assert len(got) == 71 and got.bar_no.tolist() == list(range(71)) and (got.n_bars == 71).all()
    assert (got.RSI_14 == 100).all() and np.allclose(got.ATR, 1.0)
    assert set(feature_columns(frame)) == {*FEATURE_COLUMNS, "ATR"}


def test_momentum_is_strict(spark):
    got = momentum_entries(to_spark(spark, linear()), threshold=1.0)
    assert got.count() == 0
    assert momentum_entries(to_spark(spark, linear()), threshold=0.9).count() == 110


def test_one_shuffle_and_one_sort(spark, bars):
    from barlab.operators.features import raw_features
    from barlab.session import stage

    df = raw_features(stage(to_spark(spark, bars), "plan"), dense=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "Python" not in plan
    assert plan.count("- Window [") == 7
