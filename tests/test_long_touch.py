"""Long horizons against the short operators and plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators import long_touch, touch, trades
from barlab.operators.rules import Rule, matched_rules
from tests.conftest import to_spark, walk
from tests.test_touch import with_atr


@pytest.fixture(scope="module")
def frame():
    out = with_atr(pd.concat([walk("A", 2300, 1), walk("B", 300, 2), walk("C", 41, 3), walk("D", 1, 4)], ignore_index=True))
    out.loc[out.bar_no % 53 == 7, "low"] = np.nan
    out.loc[out.bar_no % 59 == 7, "high"] = np.nan
    return out


def levels(width):
    return F.col("close") - F.col("ATR_50") * width, F.col("close") + F.col("ATR_50") * width * 1.3


@pytest.mark.parametrize("max_bars, block, width", [(1, 1024, 2.0), (40, 1024, 3.0), (40, 32768, 1.0), (1000, 1024, 40.0), (5000, 32768, 60.0)])
def test_touches_equal_loops(spark, frame, max_bars, block, width):
    got = long_touch.first_touches(to_spark(spark, frame), *levels(width), max_bars, ["volume"], ["close"], block).toPandas()
    assert len(got) == len(frame)
    frames = {s: d.reset_index(drop=True) for s, d in frame.groupby("symbol")}
    for r in got.sample(400, random_state=1).itertuples():
        d = frames[r.symbol]
        i = int(r.bar_no)
        after = d.iloc[i + 1 : i + 1 + max_bars]
        atr, close = d.ATR_50[i], d.close[i]
        hit = [np.flatnonzero(after.low <= close - atr * width), np.flatnonzero(after.high >= close + atr * (width * 1.3))]
        want = [h[0] + 1 if len(h) else None for h in hit]
        assert [None if pd.isna(x) else x for x in (r.to_stop, r.to_target)] == want
        met = min([w for w in want if w], default=None)
        at = met or (max_bars if i + max_bars < len(d) else None)
        span = after.iloc[: at or 1]
        for x, y in ((r.lowest, span.low.min()), (r.highest, span.high.max())):
            assert pd.isna(x) and pd.isna(y) or x == y
        assert pd.isna(r.exit_close) if at is None else r.exit_close == d.close[i + at]
        assert r.volume == d.volume[i]


def rows_of(df):
    return sorted(df.collect(), key=str)


def test_equal_the_short_operators(spark, frame):
    bars = to_spark(spark, frame)
    stop, target = levels(3.0)
    assert rows_of(long_touch.durations_long(bars, stop, target, 50, 1024)) == rows_of(touch.trade_durations(bars, stop, target, 50))
    signal = F.col("volume") > 400
    csl = spark.createDataFrame([("A", 2.0), ("B", None), ("C", 1.5)], "symbol string, csl double")
    for binary in (True, False):
        want = touch.label_bars(bars, csl, max_bars=60, signal=signal, binary=binary).select("symbol", "bar_no", "label", "entry_bar")
        assert rows_of(long_touch.label_bars_long(bars, csl, 60, signal=signal, binary=binary, block=1024)) == rows_of(want)


def test_exits_equal_the_short_operator(spark, frame):
    bars = to_spark(spark, frame)
    signals = matched_rules([Rule(1, (("volume", ">", 600.0),)), Rule(2, (("close", "<=", 9.5),))])
    for csl, c_tp in ((2.0, None), (5.0, 9.0)):
        want = trades.entry_exits(bars, signals, csl, c_tp, 30)
        got = long_touch.entry_exits_long(bars, signals, csl, 30, c_tp, block=1024)
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want) and want.count()


def test_no_row_holds_a_list(spark, frame):
    """Beside the rule ids, no column is an array."""
    bars = to_spark(spark, frame)
    plan = long_touch.durations_long(bars, *levels(3.0), 2000)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_nothing(spark, frame):
    assert long_touch.durations_long(to_spark(spark, frame).limit(0), *levels(1.0), 10).count() == 0
