"""Published versions, and streams fed batch by batch."""

import pytest
from pyspark.sql import functions as F

from barlab.operators.rules import Rule, rule_texts
from barlab.plans.apply_rules import rules_library
from barlab.sources import library
from barlab.streaming.bars import late_ticks, stream_bars
from barlab.streaming.replay import replay


def test_readers_see_whole_versions(spark, tmp_path):
    folder = str(tmp_path / "lib")
    with pytest.raises(FileNotFoundError):
        library.read_library(spark, folder)
    first = library.publish(spark.range(5), folder)
    held = library.read_library(spark, folder)
    second = library.publish(spark.range(7), folder)
    assert library.current_version(spark, folder) == second != first
    assert held.count() == 5 and library.read_library(spark, folder).count() == 7
    assert library.read_library(spark, folder, first).count() == 5
    assert {r.version for r in library.read_library(spark, folder).collect()} == {second}


def test_a_writer_that_dies_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "lib")
    library.publish(spark.range(5), folder)
    # In the middle of its rows.
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("dies"))).alias("id"))
    with pytest.raises(Exception, match="dies"):
        library.publish(broken, folder)
    assert library.read_library(spark, folder).count() == 5

    def dies(*_):
        raise RuntimeError("dies")

    # All rows written, but not yet named.
    monkeypatch.setattr(library, "_point", dies)
    with pytest.raises(RuntimeError):
        library.publish(spark.range(9), folder)
    assert library.read_library(spark, folder).count() == 5
    monkeypatch.undo()
    library.publish(spark.range(9), folder)
    assert library.read_library(spark, folder).count() == 9


def test_library_rows_have_the_text(spark):
    schema = "symbol string, rule_id int, n_trades long, profit_factor double, total_pnl double, win_rate double, return_pct double, max_drawdown_pct double"
    train = spark.createDataFrame([("A", 1, 9, 2.0, 5.0, 0.5, 1.0, -1.0), ("A", 2, 9, 2.0, 5.0, 0.5, 1.0, -1.0), ("B", 1, 3, 1.0, 1.0, 0.5, 1.0, -1.0)], schema)
    test = spark.createDataFrame([("A", 1, 4, 1.5, 2.0, 0.4, 0.5, -2.0), ("A", 2, 4, 1.3, 2.0, 0.4, 0.5, -2.0), ("B", 1, 3, 0.7, 1.0, 0.5, 1.0, -1.0)], schema)
    texts = rule_texts(spark, [Rule(1, (("RSI_14", "<=", 38.123), ("close", ">", 2.0)))])
    got = {(r.symbol, r.rule_id): r for r in rules_library(train, test, texts).collect()}
    assert set(got) == {("A", 1), ("B", 1)}
    row = got["A", 1]
    assert row.rule == "RSI_14 <= 38.123 AND close > 2.0" and (row.profit_factor_train, row.profit_factor_test) == (2.0, 1.5)
    assert (row.win_rate_train, row.win_rate_test, row.n_trades_test) == (0.5, 0.4, 4)


def test_replayed_bars_and_late_ticks(spark):
    """A tick whose bar is closed when it comes is counted and not in any bar."""
    rows = [("A", f"2024-01-01 {h:02d}:{m:02d}:00", float(h + m), 1.0, h // 2) for h in range(8) for m in (0, 20, 59)]
    rows += [("A", "2024-01-01 00:30:00", 99.0, 1.0, 2), ("B", "2024-01-01 00:30:00", 99.0, 1.0, 1), ("B", "2024-01-01 05:00:00", 1.0, 1.0, 3),
             ("A", "2024-01-01 01:10:00", 98.0, 1.0, 3), ("B", "2024-01-02 05:00:00", 1.0, 1.0, 5), ("A", "2024-01-01 00:00:00", 0.5, 1.0, 6)]
    arrivals = spark.createDataFrame(rows, "symbol string, ts string, price double, volume double, batch int").withColumn("ts", F.to_timestamp("ts"))
    found = replay(arrivals, "batch", {"bars": lambda t: stream_bars(t, "1 hour", "1 hour"), "late": lambda t: late_ticks(t, "1 hour", "1 hour", 2)})
    late = {r.symbol: (r.n, str(r.newest)) for r in found["late"].groupBy("symbol").agg(F.sum("n_late").alias("n"), F.max("newest").alias("newest")).collect()}
    # Before batch 1 the newest tick is 01:59, so the bar from 00:00 to 01:00 is open until the mark passes 01:00.
    assert late == {"A": (3, "2024-01-01 01:10:00")}
    bars = found["bars"].collect()
    assert sum(r.volume for r in bars) == len(rows) - 3 - 1  # the last bar is still open
    assert all(r.high != 98.0 for r in bars)


def test_nothing_to_replay(spark):
    arrivals = spark.createDataFrame([], "symbol string, ts timestamp, price double, volume double, batch int")
    found = replay(arrivals, "batch", {"bars": lambda t: stream_bars(t, "1 hour", "1 hour")})
    assert found["bars"].count() == 0
