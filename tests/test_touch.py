"""Labels, durations and unbounded reach against plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators.reach import durations_by_ratio, first_reach
from barlab.operators.touch import label_bars, trade_durations
from tests.conftest import to_spark, walk

CSL, RATIO, MAX = 2.0, 1.5, 40


def first(hit):
    at = np.flatnonzero(hit)
    return at[0] + 1 if len(at) else None


def loop_label(d, i, csl, bars):
    low, high = d.low.to_numpy()[i + 1:i + 1 + bars], d.high.to_numpy()[i + 1:i + 1 + bars]
    atr, close = d.ATR_50.iloc[i], d.close.iloc[i]
    stop, target = first(low <= close - atr * csl), first(high >= close + atr * (csl * RATIO))
    if stop is not None and (target is None or stop <= target):
        return 0
    return 2 if target is None else 1


def with_atr(frame):
    frame = frame.copy()
    frame["ATR_50"] = (0.05 + (frame.bar_no * 37 % 11) / 100).round(2)
    frame.loc[frame.bar_no % 97 == 5, "ATR_50"] = 0.0
    frame.loc[frame.bar_no % 101 == 5, "ATR_50"] = np.nan
    return frame


@pytest.fixture(scope="module")
def frame():
    return with_atr(pd.concat([walk("A", 2300, 1), walk("B", 300, 2), walk("C", 41, 3)], ignore_index=True))


@pytest.mark.parametrize("block", [1024, 32768])
def test_labels(spark, frame, block):
    want = {}
    for s, d in frame.groupby("symbol"):
        for i in range(len(d) - MAX - 1):
            if d.ATR_50.iloc[i] > 0 and 1 <= d.close.iloc[i] <= 20:
                want[s, i] = loop_label(d, i, CSL, MAX)
    got = label_bars(to_spark(spark, frame), CSL, binary=False, block=block).toPandas()
    assert {(r.symbol, r.bar_no): r.label for r in got.itertuples()} == want
    assert set(want.values()) == {0, 1, 2} and not any(s == "C" for s, _ in want)
    csl = spark.createDataFrame([("A", CSL), ("B", None)], "symbol string, csl double")
    binary = label_bars(to_spark(spark, frame), csl, block=block).toPandas()
    assert {(r.symbol, r.bar_no): r.label for r in binary.itertuples()} == {
        k: int(v == 1) for k, v in want.items() if k[0] == "A"
    }


def bars(spark, lows, highs):
    n = len(lows)
    return to_spark(spark, pd.DataFrame({
        "symbol": "T", "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="h"), "low": lows,
        "high": highs, "close": 10.0, "ATR_50": 1.0, "bar_no": np.arange(n), "n_bars": n,
    }))


@pytest.mark.parametrize("lows, highs, label", [
    ([10, 8, 10, 10, 10], [10, 13, 10, 10, 10], 0),       # both barriers in one bar
    ([10, 8.0, 10, 10, 10], [10, 10, 10, 10, 10], 0),     # exactly at the stop
    ([10, 10, 10, 10, 10], [10, 13.0, 10, 10, 10], 1),    # exactly at the target
    ([10, 10, 10, 8, 10], [10, 10, 10, 10, 10], 0),       # on the last bar allowed
    ([10, 10, 10, 10, 8], [10, 10, 10, 10, 13], 2),       # one bar later
    ([8, 10, 10, 8, 10], [13, 10, 13, 10, 10], 1),        # the own bar does not count
])
def test_barrier_edges(spark, lows, highs, label):
    got = label_bars(bars(spark, lows, highs), 2.0, max_bars=3, binary=False).collect()
    assert [(r["bar_no"], r["label"]) for r in got] == [(0, label)]


def test_missing_prices_touch_nothing(spark):
    got = label_bars(bars(spark, [10, np.nan, 8, 10, 10], [10, np.nan, 10, 10, 10]), 2.0, max_bars=3, binary=False)
    assert got.first()["label"] == 0


def test_durations(spark, frame):
    stop, target = F.col("close") - 0.30, F.col("close") + 0.45
    got = trade_durations(to_spark(spark, frame), stop, target, 25, block=1024).toPandas()
    have = {(r.symbol, r.bar_no): r.duration for r in got.itertuples()}
    for s, d in frame.groupby("symbol"):
        low, high, close = d.low.to_numpy(), d.high.to_numpy(), d.close.to_numpy()
        for i in range(len(d)):
            if i == len(d) - 1:
                want = 0
            else:
                hits = [first(low[i + 1:i + 26] <= close[i] - 0.30), first(high[i + 1:i + 26] >= close[i] + 0.45)]
                want = min([h for h in hits if h is not None], default=25)
            assert have[s, i] == want


@pytest.mark.parametrize("near, fan", [(8, 4), (64, 64)])
def test_durations_by_ratio(spark, frame, near, fan):
    entries = frame[(frame.bar_no % 3 == 0) & (frame.ATR_50 > 0)]
    atr = F.when((F.col("bar_no") % 3 == 0) & (F.col("ATR_50") > 0), F.col("ATR_50"))
    got = durations_by_ratio(to_spark(spark, frame), F.col("close"), atr, 3.0, [1.0, 4.0], near, 1024, fan).toPandas()
    have = {(r.symbol, r.bar_no, r.ratio): r.duration for r in got.itertuples()}
    assert len(have) == 2 * len(entries) == len(got)
    for s, d in frame.groupby("symbol"):
        low, high = d.low.to_numpy(), d.high.to_numpy()
        for e in entries[entries.symbol == s].itertuples():
            i, risk = e.bar_no, e.ATR_50 * 3.0
            for r in (1.0, 4.0):
                stop = first(low[i + 1:] <= e.close - risk)
                target = first(high[i + 1:] >= e.close + r * 3.0 * e.ATR_50)
                left = len(d) - 1 - i
                assert have[s, i, r] == min([x for x in (stop, target) if x is not None], default=left)


def test_first_reach_over_several_levels(spark):
    values = np.random.RandomState(3).randint(0, 1000, 700)
    series = spark.createDataFrame([("A", i, float(v)) for i, v in enumerate(values)], "k string, bar_no long, value double")
    asks = [("A", i, float(x)) for i in range(0, 700, 9) for x in (0, 500, 990, 999, 2000)]
    got = first_reach(series, spark.createDataFrame(asks, "k string, bar_no long, level double"), ["k"], fan=4)
    have = {(r["bar_no"], r["level"]): r["reach_bar"] for r in got.collect()}
    for _, i, x in asks:
        hit = first(values[i + 1:] >= x)
        assert have[i, x] == (None if hit is None else i + hit)
