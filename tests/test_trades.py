"""Interval choice, trades and metrics against plain loops."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators import metrics as M
from barlab.operators.intervals import select_intervals
from barlab.operators.rules import Rule, matched_rules, merge_bounds, parse_conditions, rejected_rules, rules_from_table, signal_counts
from barlab.operators.trades import entry_exits, non_overlapping, run_signal
from barlab.plans.apply_rules import apply_rules, out_of_sample
from tests.conftest import to_spark, walk


def greedy(rows):
    taken, after = [], -1
    for e, x in sorted(rows):
        if e > after:
            if x is None:
                break
            taken.append(e)
            after = x
    return taken


@pytest.mark.parametrize("block, group", [(16, 2), (16, 4), (64, 1024), (1024, 1024)])
def test_greedy_choice(spark, block, group):
    rng = np.random.RandomState(block + group)
    rows = []
    # One key holds most candidates; densities differ, some keys have long gaps.
    for key, n, density in (("hot", 4000, 0.9), ("thin", 4000, 0.01), ("mid", 500, 0.3), ("one", 3, 1.0)):
        for e in range(1, n):
            if rng.rand() < density and not 100 < e < 190:
                x = e + int(rng.randint(1, 13))
                rows.append((key, e, x if x < n else None, e * 0.5))
    df = spark.createDataFrame(rows, "k string, e long, x long, note double")
    got = select_intervals(df, ["k"], "e", "x", 12, block, group).collect()
    have = {}
    for r in got:
        have.setdefault(r["k"], []).append(r["e"])
        assert r["note"] == r["e"] * 0.5 and r["x"] is not None
    for key in ("hot", "thin", "mid", "one"):
        assert sorted(have.get(key, [])) == greedy([(e, x) for k, e, x, _ in rows if k == key])


def test_an_open_interval_blocks_the_rest(spark):
    rows = [("a", 1, 3), ("a", 2, 4), ("a", 4, None), ("a", 30, 31), ("a", 300, 301)]
    df = spark.createDataFrame(rows, "k string, e long, x long")
    assert [r["e"] for r in select_intervals(df, ["k"], "e", "x", 12, 16, 2).collect()] == [1]


def exit_of(d, e, csl, c_tp, max_bars, risk=100.0):
    """The trade that would be entered at bar ``e``, from its definition; None if it cannot be entered.

    The held bars end with the first that reaches the stop or the target, or with bar ``e + max_bars``. A trade
    that the data end before has no exit bar.
    """
    atr, price = d.ATR_50[e - 1], d.open[e]
    size = int(risk / (csl * atr)) if atr > 0 else 0
    if not size:
        return None
    stop, target = price - atr * csl, price + atr * c_tp
    later = d.iloc[e + 1 : e + 1 + max_bars]
    stopped, reached = later.index[later.low <= stop], later.index[later.high >= target]
    ends = [x for x in (stopped.min(), reached.min(), e + max_bars if len(later) == max_bars else np.nan) if x == x]
    if not ends:
        return {"e": e, "x": None}
    x = int(min(ends))
    why = "SL" if x in stopped else "TP" if x in reached else "Time Exit"
    out = {"SL": stop, "TP": target, "Time Exit": d.close[x]}[why]
    held = later.loc[:x]
    return {
        "e": e, "x": x, "price_in": price, "price_out": out, "pnl": (out - price) * size, "reason": why, "size": size,
        "mae": price - min(price, held.low.min()), "mfe": max(price, held.high.max()) - price,
    }


@pytest.fixture(scope="module")
def frame():
    f = pd.concat([walk("A", 2600, 11), walk("B", 400, 12), walk("C", 30, 13)], ignore_index=True)
    f["ATR_50"] = (0.04 + (f.bar_no * 37 % 11) / 100).round(2)
    f.loc[f.bar_no % 53 == 5, "ATR_50"] = 0.0
    f.loc[f.bar_no % 59 == 5, "ATR_50"] = np.nan
    f.loc[f.bar_no % 61 == 5, "ATR_50"] = 80.0  # size 0
    f["RSI_14"] = (f.bar_no * 13 % 100).astype(float)
    f.loc[f.bar_no % 17 == 0, "RSI_14"] = np.nan
    return f


@pytest.mark.parametrize("block, packs", [(1024, 64), (32768, 1024)])
@pytest.mark.parametrize("limit, csl, c_tp", [(55.0, 2.0, 3.0), (95.0, 1.0, 1.5), (0.5, 6.0, 9.0)])
def test_trades_equal_their_definition(spark, frame, block, packs, limit, csl, c_tp):
    signal = F.when(F.col("RSI_14") > limit, F.array(F.lit(0))).otherwise(F.expr("cast(array() as array<int>)"))
    exits = entry_exits(to_spark(spark, frame), signal, csl, c_tp, 40, block=block)
    got = non_overlapping(exits, 40, packs, 4).toPandas().sort_values(["symbol", "entry_bar"])
    for s, d in frame.groupby("symbol"):
        d = d.reset_index(drop=True)
        entries = [i + 1 for i in d.index[d.RSI_14 > limit] if i + 1 < len(d)]
        possible = {t["e"]: t for t in (exit_of(d, e, csl, c_tp, 40) for e in entries) if t}
        want = [possible[e] for e in greedy([(t["e"], t["x"]) for t in possible.values()])]
        mine = got[got.symbol == s]
        for c, name in (("entry_bar", "e"), ("exit_bar", "x"), ("reason", "reason"), ("size", "size")):
            assert mine[c].tolist() == [w[name] for w in want]
        for c in ("price_in", "price_out", "pnl", "mae", "mfe"):
            assert np.allclose(mine[c], [w[c] for w in want], atol=1e-9), c
        assert (mine.bars_held == mine.exit_bar - mine.entry_bar).all()
        stamps = d.set_index("bar_no").ts
        assert (stamps.loc[mine.exit_bar].to_numpy() == mine.exit_ts.to_numpy()).all()


def test_intervals_of_any_length(spark, frame):
    """A longest holding time beyond the usual block."""
    got = run_signal(to_spark(spark, frame), F.col("RSI_14") > 90, 30.0, 45.0, max_bars=1500).toPandas()
    d = frame[frame.symbol == "A"].reset_index(drop=True)
    possible = [t for t in (exit_of(d, i + 1, 30.0, 45.0, 1500) for i in d.index[d.RSI_14 > 90] if i + 1 < len(d)) if t]
    assert got[got.symbol == "A"].entry_bar.tolist() == greedy([(t["e"], t["x"]) for t in possible])


def test_default_target_is_one_and_a_half_stops(spark, frame):
    got = run_signal(to_spark(spark, frame), F.col("RSI_14") > 55, 2.0).toPandas()
    risk, gain = got.price_in - got.stop, got.target - got.price_in
    assert np.allclose(gain, risk * 1.5)


def curve_metrics(pnl, capital=10_000.0):
    """The measures of a list of results, one by one from their definitions."""
    results = pnl.to_numpy()
    n, total = len(results), results.sum()
    gains, costs = results[results > 0], results[results <= 0]
    mean_of = lambda x: x.mean() if x.size else 0.0
    curve = np.cumsum(results)
    highest = np.array([max(curve[: i + 1]) for i in range(n)]) + capital  # the start itself is no peak
    spread = results.std(ddof=1) if n > 1 else 0.0
    steps = np.arange(1, n + 1)
    return {
        "n_trades": n, "total_pnl": total, "final_capital": capital + total, "return_pct": 100 * total / capital,
        "win_rate": gains.size / n, "avg_win": mean_of(gains), "avg_loss": mean_of(costs),
        "expectancy": total / n,
        "profit_factor": math.inf if costs.sum() == 0 else gains.sum() / -costs.sum(),
        "max_drawdown_pct": min(100 * (curve + capital - highest) / highest),
        "sharpe": math.sqrt(252) * results.mean() / spread if spread > 0 else 0.0,
        "corr_trade_vs_pnl": 0.0 if n < 2 else np.corrcoef(steps, curve)[0, 1] if curve.std() > 0 else np.nan,
    }


@pytest.mark.parametrize("block", [1024, 32768])
def test_metrics(spark, block):
    rng = np.random.RandomState(4)
    rows = [("A", 1, int(e), float(rng.randn() * 50)) for e in np.cumsum(rng.randint(1, 30, 600))]
    rows += [("A", 2, 7, -5.0), ("B", 1, 3, 4.0), ("B", 1, 9, 6.0), ("C", 1, 5, -2.0), ("C", 1, 8, 0.0)]
    df = spark.createDataFrame(rows, "symbol string, rule_id int, entry_bar long, pnl double")
    got = {(r["symbol"], r["rule_id"]): r.asDict() for r in M.performance(df, 10_000.0, block).collect()}
    frame = pd.DataFrame(rows, columns=["symbol", "rule_id", "entry_bar", "pnl"]).sort_values("entry_bar")
    assert len(got) == 4
    for key, d in frame.groupby(["symbol", "rule_id"]):
        for name, want in curve_metrics(d.pnl.reset_index(drop=True)).items():
            # An undefined value (correlation of a constant curve) is null here.
            want = None if np.isnan(want) else pytest.approx(want, rel=1e-9, abs=1e-9)
            assert got[key][name] == want, (key, name)
    assert got["A", 2]["sharpe"] == 0 and got["A", 2]["corr_trade_vs_pnl"] == 0
    assert got["B", 1]["profit_factor"] == math.inf


def test_constant_pnl_has_no_correlation(spark):
    df = spark.createDataFrame([("A", 1, 1, 0.0), ("A", 1, 2, 0.0)], "symbol string, rule_id int, entry_bar long, pnl double")
    assert M.performance(df).first()["corr_trade_vs_pnl"] is None


def test_selection_falls_back(spark):
    schema = "symbol string, rule_id int, total_pnl double, corr_trade_vs_pnl double, max_drawdown_pct double"
    rows = [("A", 1, 5.0, 0.2, -1.0), ("A", 2, 9.0, 0.2, -80.0), ("A", 3, -1.0, 0.9, 0.0), ("A", 4, 2.0, None, 0.0)]
    pick = lambda r: [x["rule_id"] for x in M.best_results(M.select_results(spark.createDataFrame(r, schema))).collect()]
    assert pick(rows) == [2, 1]
    assert pick([*rows, ("A", 5, 1.0, 0.4, -2.0)]) == [5]
    assert pick([*rows, ("A", 6, 1.0, 0.4, -36.0)]) == [2, 1, 6]


def test_pairs_without_trades_show_zeros(spark, frame):
    rules = [Rule(1, (("RSI_14", ">", 55.0),)), Rule(2, (("RSI_14", ">", 1000.0),)), Rule(3, ())]
    csl = spark.createDataFrame([("A", 2.0), ("B", None), ("C", 1e9)], "symbol string, csl double")
    got = {(r["symbol"], r["rule_id"]): r for r in apply_rules(to_spark(spark, frame), rules, csl).results.collect()}
    assert set(got) == {("A", 1), ("C", 1)}
    assert got["C", 1]["n_trades"] == 0 and got["C", 1]["profit_factor"] == 0 and got["A", 1]["n_trades"] > 0


def test_out_of_sample_keeps_what_holds(spark):
    schema = "symbol string, rule_id int, n_trades long, profit_factor double, total_pnl double"
    train = spark.createDataFrame([("A", 1, 5, 2.0, 1.0), ("A", 2, 5, 2.0, 1.0), ("B", 1, 5, 2.0, 1.0)], schema)
    test = spark.createDataFrame([("A", 1, 5, 1.4, 1.0), ("A", 2, 5, 1.39, 1.0)], schema)
    assert [(r["symbol"], r["rule_id"]) for r in out_of_sample(train, test).collect()] == [("A", 1)]


def test_rule_texts(spark):
    rules = spark.createDataFrame(
        [(1, ["VWAP_20 <= 2.5", "VWAP_20<2.5", "VWAP_20 > 1", "RSI_14 == 3"]), (2, ["nonsense"]), (3, ["ATR_50 >= 1e3"])],
        "rule_id int, conditions array<string>",
    )
    parsed = parse_conditions(rules)
    assert sorted(r["rule_id"] for r in rejected_rules(parsed).collect()) == [2, 3]
    assert rules_from_table(parsed) == [
        Rule(1, (("VWAP_20", "<=", 2.5), ("VWAP_20", "<", 2.5), ("VWAP_20", ">", 1.0), ("RSI_14", "==", 3.0)))
    ]
    bounds = {(r["rule_id"], r["feature"]): tuple(r)[2:] for r in merge_bounds(parsed).collect()}
    assert bounds == {(1, "VWAP_20"): (1.0, False, 2.5, False), (1, "RSI_14"): (3.0, True, 3.0, True)}


def test_null_features_match_no_rule(spark, frame):
    rules = [Rule(1, (("RSI_14", "<", 1e9),)), Rule(2, (("RSI_14", ">=", 50.0), ("close", "<", 10.0)))]
    got = {(r["symbol"], r["rule_id"]): r["n_signals"] for r in signal_counts(to_spark(spark, frame), rules).collect()}
    for s, d in frame.groupby("symbol"):
        assert got[s, 1] == d.RSI_14.notna().sum()
        assert got.get((s, 2), 0) == ((d.RSI_14 >= 50) & (d.close < 10)).sum()
    assert matched_rules([]) is not None
