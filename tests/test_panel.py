"""Numbering, blocks and forward fill, also with one dominant symbol."""

import numpy as np
import pandas as pd
import pytest

from barlab.operators.panel import blocked, bucketed, fill_forward, number_bars, number_rows, own_rows, rank_kept
from barlab.operators.splits import fold_performance, fold_summary, head_by_row_order, split_by_time, split_summary, walk_forward
from tests.conftest import to_spark, walk


def skewed():
    return pd.concat([walk("HOT", 6000, 1), *[walk(f"S{i}", 60, i) for i in range(8)]], ignore_index=True)


def test_numbers_of_a_skewed_panel(spark):
    frame = skewed()
    bars = to_spark(spark, frame.drop(columns=["bar_no", "n_bars"])).repartition(7)
    got = number_bars(bars).toPandas().merge(frame, on=["symbol", "ts"], suffixes=("", "_want"))
    assert len(got) == len(frame)
    assert (got.bar_no == got.bar_no_want).all() and (got.n_bars == got.n_bars_want).all()


def test_global_numbers(spark):
    frame = skewed()
    got = number_rows(to_spark(spark, frame), [], ["symbol", "ts"], "row", "all").toPandas()
    got = got.sort_values(["symbol", "ts"])
    assert got["row"].tolist() == list(range(len(frame))) and (got["all"] == len(frame)).all()


def test_rank_of_kept_rows(spark):
    frame = skewed()
    kept = frame[(frame.bar_no * 7919) % 5 < 2]
    got = rank_kept(to_spark(spark, kept), block=1024).toPandas().sort_values(["symbol", "bar_no"])
    want = kept.sort_values(["symbol", "bar_no"]).groupby("symbol").cumcount()
    assert got.row_no.tolist() == want.tolist()


def test_halo_rows_come_and_go(spark):
    df = to_spark(spark, walk("A", 5000, 1))
    cut = blocked(df, 50, 40, 1024)
    sizes = cut.groupBy("blk").count().toPandas().set_index("blk")["count"]
    assert sizes.to_dict() == {0: 1064, 1: 1114, 2: 1114, 3: 1114, 4: 954}
    assert own_rows(cut, 1024).count() == 5000


def test_fill_forward_over_blocks(spark):
    frame = skewed()[["symbol", "bar_no", "n_bars", "close", "volume"]]
    rng = np.random.RandomState(1)
    frame.loc[rng.rand(len(frame)) < 0.3, "close"] = np.nan
    frame.loc[(frame.symbol == "HOT") & (frame.bar_no > 100) & (frame.bar_no < 4500), "volume"] = np.nan
    frame.loc[frame.bar_no < 3, "volume"] = np.nan
    want = frame.sort_values(["symbol", "bar_no"]).reset_index(drop=True)
    want[["close", "volume"]] = want.groupby("symbol")[["close", "volume"]].ffill()
    got = fill_forward(to_spark(spark, frame), ["close", "volume"], 1024).toPandas()
    got = got.sort_values(["symbol", "bar_no"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)
    trimmed = want.dropna().reset_index(drop=True)
    trimmed["bar_no"] = trimmed.groupby("symbol").cumcount()
    got = fill_forward(to_spark(spark, frame), ["close", "volume"], 1024, trim=True).toPandas()
    got = got.sort_values(["symbol", "bar_no"]).reset_index(drop=True)
    assert (got.n_bars == got.groupby("symbol").bar_no.transform("size")).all()
    pd.testing.assert_frame_equal(got[["symbol", "bar_no", "close", "volume"]],
                                  trimmed[["symbol", "bar_no", "close", "volume"]], check_dtype=False)


def test_a_column_without_values_leaves_no_row(spark):
    frame = walk("A", 10, 1)[["symbol", "bar_no", "n_bars", "close", "volume"]]
    frame["volume"] = np.nan
    assert fill_forward(to_spark(spark, frame), ["close", "volume"], trim=True).count() == 0


def test_split_leaves_out_short_symbols(spark):
    frame = pd.concat([walk("A", 101, 1), walk("B", 19, 2), walk("C", 20, 3)])
    split = split_by_time(to_spark(spark, frame), block=1024)
    got = {r["symbol"]: (r["train_rows"], r["test_rows"], r["split_at"]) for r in split_summary(split).collect()}
    assert got == {"A": (70, 31, 70), "C": (14, 6, 14)}
    last_train = split.filter("part = 'train'").groupBy("symbol").max("bar_no").collect()
    assert {r[0]: r[1] for r in last_train} == {"A": 69, "C": 13}


def test_row_order_head(spark):
    frame = pd.concat([walk("B", 10, 1), walk("A", 10, 2)])
    got = head_by_row_order(to_spark(spark, frame), 0.7).groupBy("symbol").count().collect()
    assert {r[0]: r[1] for r in got} == {"A": 10, "B": 4}


def test_folds(spark):
    frame = pd.concat([walk("A", 40, 1), walk("B", 24, 2), walk("C", 25, 3)])
    bars = to_spark(spark, frame)
    rows = walk_forward(bars, 20, 5, 3).toPandas()
    want = rows.groupby(["symbol", "fold"]).agg(first_ts=("ts", "min"), last_ts=("ts", "max"), n=("ts", "size"))
    want["test_ts"] = rows[rows.part == "test"].groupby(["symbol", "fold"]).ts.min()
    assert (want.n == 25).all()
    got = fold_summary(bars, 20, 5, 3).toPandas().set_index(["symbol", "fold"]).sort_index()
    for c in ("first_ts", "test_ts", "last_ts"):
        assert (got[c] == want[c]).all()
    got = got.reset_index()
    assert (got.train_rows == 20).all() and (got.test_rows == 5).all()
    assert got.groupby("symbol").size().to_dict() == {"A": 6, "C": 1}


@pytest.mark.parametrize("train, test, step", [(20, 5, 3), (24, 8, 4), (12, 6, 6)])
def test_fold_performance(spark, train, test, step):
    frame = pd.concat([walk("A", 1100, 1), walk("B", 24, 2), walk("C", 33, 3)])
    bars = to_spark(spark, frame)
    marks = frame[frame.bar_no % 3 > 0][["symbol", "bar_no"]].assign(label=lambda d: (d.bar_no * 7 // 3) % 3)
    labels = spark.createDataFrame([tuple(map(lambda v: v if isinstance(v, str) else int(v), r)) for r in marks.itertuples(index=False)],
                                   "symbol string, bar_no bigint, label int")
    rows = walk_forward(bars, train, test, step).toPandas().merge(marks, "left", ["symbol", "bar_no"])
    moves = frame.assign(ret=frame.groupby("symbol").close.pct_change())[["symbol", "bar_no", "ret"]]
    rows = rows.merge(moves, "left", ["symbol", "bar_no"]).sort_values("bar_no")
    got = fold_performance(bars, labels, train, test, step, 1024).toPandas().set_index(["symbol", "fold", "part"]).sort_index()
    groups = rows.groupby(["symbol", "fold", "part"])
    assert list(got.index) == sorted(groups.groups)
    for key, d in groups:
        r = got.loc[key]
        assert (r.bars, r.labeled, r.positives) == (len(d), d.label.notna().sum(), (d.label == 1).sum())
        assert r.rate == pytest.approx((d.label.dropna() == 1).mean())
        assert r.mean_return == pytest.approx(d.ret.mean()) and r.std_return == pytest.approx(d.ret.std())
        assert r.total_return == pytest.approx(d.close.iloc[-1] / d.close.iloc[0] - 1)


def test_bucketed_tables_need_no_shuffle(spark):
    """Labels, exits and indicators of a bucketed panel: nothing of the bars is shuffled, and the results are the same."""
    from pyspark.sql import functions as F

    from barlab.operators import indicators as ind
    from barlab.operators.recipes import with_indicators
    from barlab.operators.touch import label_bars
    from barlab.operators.trades import entry_exits
    from tests.test_touch import with_atr

    frame = with_atr(pd.concat([walk("A", 5000, 1), walk("B", 900, 2)]))
    bars = to_spark(spark, frame)
    table = bucketed(bars, 200, 40, "test", 5, 1024)
    signals = F.when(F.col("volume") > 500, F.array(F.lit(1))).otherwise(F.expr("cast(array() as array<int>)"))
    csl = spark.createDataFrame([("A", 2.0), ("B", 2.5)], "symbol string, csl double")
    makers = [
        lambda df: label_bars(df, 2.0, block=1024), lambda df: label_bars(df, csl, block=1024), lambda df: entry_exits(df, signals, 2.0, block=1024),
        lambda df: with_indicators(df, ind.atr(14), ind.sma("close", 20, "S"), block=1024),
    ]
    for make in makers:
        found = make(table)
        assert sorted(map(str, found.collect())) == sorted(map(str, make(bars).select(*found.columns).collect()))
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert "Bucketed: true" in plan and not any("low#" in line or "close#" in line for line in moved) and len(moved) <= 3
    for bad in ({"block": 2048}, {"block": 1024, "max_bars": 41}):
        with pytest.raises(ValueError):
            label_bars(table, 2.0, **bad)
