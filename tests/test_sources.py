"""Files in and out, universes, resampling and the stream."""

import json
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators.model import rules_as_list
from barlab.operators.resample import resample_bars
from barlab.operators.rules import Rule, parse_conditions, rules_from_table
from barlab.params import DEFAULT_SYMBOLS, FEATURE_COLUMNS
from barlab.session import shared_folder, stage, staged_tables
from barlab.sources.bars import read_bars, read_frames, read_symbol_files
from barlab.sources.rule_files import export_rules, read_rules, rule_json
from barlab.sources.sinks import write_table
from barlab.sources.universe import read_universe, universe_symbols
from barlab.streaming.bars import stream_bars
from tests.conftest import to_spark, walk

HEADER = "Date,Time,Open,High,Low,Close,Volume"


def test_symbol_files(spark, tmp_path):
    (tmp_path / "AAA.csv").write_text(f"{HEADER}\n2024-01-02,10:00:00,2,3,1,2.5,10\n2024-01-02,09:00:00,1,2,1,,9\n")
    # Another column order and one column more.
    (tmp_path / "B B.csv").write_text('Volume,Note,Date,Time,Close,Low,High,Open\n5,"a,b",2024-01-01,00:30:00,4,3,6,5\n')
    (tmp_path / "BAD.csv").write_text("When,Open,High,Low,Close,Volume\n2024-01-01,1,1,1,1,1\n")
    (tmp_path / "WORSE.csv").write_text(f"{HEADER}\n2024-01-01,10:00:00,1,1,1,1,1\nsoon,noon,1,1,1,1,1\n")
    (tmp_path / "ignored.txt").write_text("nothing")
    bars, rejects = read_symbol_files(spark, str(tmp_path))
    got = [tuple(r) for r in bars.orderBy("symbol", "ts").collect()]
    stamp = pd.Timestamp
    assert got == [
        ("AAA", stamp("2024-01-02 09:00").to_pydatetime(), 1.0, 2.0, 1.0, None, 9.0),
        ("AAA", stamp("2024-01-02 10:00").to_pydatetime(), 2.0, 3.0, 1.0, 2.5, 10.0),
        ("B B", stamp("2024-01-01 00:30").to_pydatetime(), 5.0, 6.0, 3.0, 4.0, 5.0),
    ]
    assert {tuple(r)[:2] for r in rejects.collect()} == {("BAD", "no header"), ("WORSE", "bad time")}


def test_files_are_read_by_their_own_header(spark, tmp_path):
    """One stem in two folders with other column orders, a header beyond 64 columns, one bad file of a good symbol."""
    for year, text in ((2023, f"{HEADER}\n2023-01-02,10:00:00,1,2,3,4,5\n"), (2024, "Date,Time,Volume,Close,Low,High,Open\n2024-01-02,10:00:00,5,4,3,2,1\n"),
                       (2025, f"{HEADER}\n2025-01-02,10:00:00,9,9,9,9,9\nno,time,9,9,9,9,9\n")):
        (tmp_path / str(year)).mkdir()
        (tmp_path / str(year) / "A.csv").write_text(text)
    many = [f"x{i}" for i in range(70)]
    (tmp_path / "W.csv").write_text("\ufeff" + ",".join([*many, HEADER]) + "\n" + ",".join(['"a,""b"'] * 70) + ',2024-01-01,00:00:00,1,2,3,4,5\n,' + "," * 69 + "2024-01-02,00:00:00,,2,3,4,5\n")
    bars, rejects = read_symbol_files(spark, str(tmp_path))
    got = sorted(((r.symbol, r.ts.year, r.ts.day, r.open, r.close) for r in bars.collect()), key=repr)
    assert got == [("A", 2023, 2, 1.0, 4.0), ("A", 2024, 2, 1.0, 4.0), ("W", 2024, 1, 1.0, 4.0), ("W", 2024, 2, None, 4.0)]
    assert [(r.symbol, r.reason, "2025" in r.file) for r in rejects.collect()] == [("A", "bad time", True)]


@pytest.mark.parametrize("split", [64, 200, 1 << 27])
def test_line_breaks_inside_quotes(spark, tmp_path, split):
    """Records over several lines and file blocks, against pandas; stray quotes in plain cells; an unclosed quote."""
    rng = np.random.RandomState(split % 97)
    notes = ["plain", 'say "hi"', "two\nlines", "a\n\nb,c\n", '"\n"', "long " * 30 + "\n" + "text " * 40, "", "x,y"]
    for name in ("A", "B", "C"):
        rows = [["Date", "Note", "Time", "Open", "High", "Low", "Close", "Volume"]]
        for i in range(60):
            # The last file is plain.
            note = rng.choice(notes[:2] if name == "C" else notes)
            rows.append([f"2024-01-{i % 28 + 1:02d}", note, f"{i // 28:02d}:00:00", str(i), str(i + 1), "0.5", "", "7"])
        pd.DataFrame(rows[1:], columns=rows[0]).to_csv(tmp_path / f"{name}.csv", index=False)
    (tmp_path / "D.csv").write_text('Note,' + HEADER + '\n5" pipe,2024-01-01,00:00:00,1,2,3,4,5\n"x\ny",2024-01-02,00:00:00,1,2,3,4,5\n6" pipe,2024-01-03,00:00:00,1,2,3,4,5\n')
    (tmp_path / "E.csv").write_text('Note,' + HEADER + '\na,2024-01-01,00:00:00,1,2,3,4,5\n"open,2024-01-02,00:00:00,1,2,3,4,5\nb,2024-01-03,00:00:00,1,2,3,4,5\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        bars, rejects = read_symbol_files(spark, str(tmp_path))
        got = sorted((r.symbol, str(r.ts), r.open, r.high, r.low, r.close, r.volume) for r in bars.collect())
        bad = [(r.symbol, r.reason) for r in rejects.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = []
    for name in "ABCD":
        for r in pd.read_csv(tmp_path / f"{name}.csv").itertuples():
            close = None if pd.isna(r.Close) else r.Close
            want.append((name, f"{r.Date} {r.Time}", r.Open, r.High, r.Low, close, r.Volume))
    assert got == sorted(want) and bad == [("E", "unclosed quote")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_bars_there_and_back(spark, tmp_path, fmt):
    df = to_spark(spark, walk("A", 50, 1)).drop("bar_no", "n_bars")
    nan = df.withColumn("close", F.when(F.col("volume") > 500, float("nan")).otherwise(F.col("close")))
    write_table(nan, str(tmp_path / "t"), fmt, order=("symbol", "ts"))
    back = read_bars(spark, str(tmp_path / "t"), fmt)
    assert back.dtypes == df.dtypes and back.filter(F.isnan("close")).count() == 0
    assert back.filter("close is null").count() == df.filter("volume > 500").count()
    assert back.drop("close").exceptAll(df.drop("close")).count() == 0


def test_a_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("symbol,ts,high,open,low,close,volume\nA,2024-01-01 00:00:00,1,1,1,1,1\n")
    with pytest.raises(Exception, match="header"):
        read_bars(spark, str(tmp_path), "csv").collect()


def test_per_symbol_folders(spark, tmp_path):
    df = to_spark(spark, pd.concat([walk("A", 5, 1), walk("B", 5, 2)]))
    write_table(df, str(tmp_path / "t"), per_symbol=True)
    assert sorted(p.name for p in (tmp_path / "t").glob("symbol=*")) == ["symbol=A", "symbol=B"]


def test_labeled_files(spark, tmp_path):
    columns = ["ts", "open", "high", "low", "close", "volume", *FEATURE_COLUMNS, "label", "entry_bar"]
    numbers = ",".join(["1.5"] * (len(columns) - 3))
    for s in ("AAA", "BBB"):
        (tmp_path / f"labeled_{s}.csv").write_text(
            ",".join(columns) + f"\n2024-01-01 10:00:00+02:00,{numbers},1,7\nnever,{numbers},0,8\n")
    other = ["Extra", "Datetime", *[c.title() for c in columns[1:6]], *columns[6:-1], "entry_idx", "ATR"]
    (tmp_path / "labeled_CCC.csv").write_text(",".join(other) + f"\nx,2024-01-01 10:00:00,{numbers},1,7,0.5\n")
    (tmp_path / "labeled_DDD.csv").write_text("Datetime,Open\n2024-01-01 10:00:00,1\n")
    every, rejects = read_frames(spark, str(tmp_path), "labeled_", labeled=True)
    assert [(r.symbol, r.reason) for r in rejects.collect()] == [("DDD", "no header")]
    third = every.filter("symbol = 'CCC'").first()
    assert (third.label, third.entry_bar, third.ts.hour) == (1, 7, 10)
    got = every.filter("symbol <> 'CCC'")
    rows = {r["symbol"]: r for r in got.collect()}
    assert set(rows) == {"AAA", "BBB"} and got.count() == 2
    assert rows["AAA"]["ts"] == pd.Timestamp("2024-01-01 08:00").to_pydatetime() and rows["AAA"]["label"] == 1


def test_universe_order_of_sources(spark, tmp_path):
    path = tmp_path / "tickers.txt"
    path.write_text("# comment\n abc \n\nDEF\n#GHI\n")
    names = lambda df: [r["symbol"] for r in df.collect()]
    assert names(universe_symbols(spark, str(path), ["X"])) == ["ABC", "DEF"]
    assert names(universe_symbols(spark, str(tmp_path / "none.txt"), ["X"])) == ["X"]
    path.write_text("# only a comment\n")
    assert names(universe_symbols(spark, str(path))) == DEFAULT_SYMBOLS


def test_universe_file(spark, tmp_path):
    (tmp_path / "u.csv").write_text("ticker,csl,bp_median,bp_max,n_samples\nAAA,2.5,100.0,200.0,500\n")
    assert tuple(read_universe(spark, str(tmp_path / "u.csv")).first()) == ("AAA", 2.5, 100.0, 200.0, 500)


def test_rules_there_and_back(spark, tmp_path):
    listed = [{"rule_id": 3, "conditions": ["ATR_50 <= 0.047", "VWAP_20 > 2"], "n_samples": 5, "p_label_1": 0.5,
               "win_rate_train": None}]
    (tmp_path / "r.json").write_text(json.dumps(listed, indent=2))
    read = read_rules(spark, str(tmp_path / "r.json"))
    want = [Rule(3, (("ATR_50", "<=", 0.047), ("VWAP_20", ">", 2.0)))]
    assert rules_from_table(parse_conditions(read)) == want
    own = spark.createDataFrame(
        [(0, [("ATR_50", "<=", 0.0470004)], 5, 0.5)],
        "rule_id int, conditions array<struct<feature:string,op:string,threshold:double>>, n_samples long, p_label_1 double",
    )
    assert rules_as_list(own)[0].conditions[0][2] == 0.0470004
    assert json.loads(rule_json(own).first()["json"])["conditions"] == ["ATR_50 <= 0.047"]
    export_rules(own, str(tmp_path / "out"))
    assert read_rules(spark, str(tmp_path / "out"), one_list=False).first()["conditions"] == ["ATR_50 <= 0.047"]


@pytest.mark.parametrize("seconds, rule", [(4 * 3600, "4h"), (7 * 3600, "7h"), (86_400, "1D"), (3 * 86_400, "3D")])
def test_resample(spark, seconds, rule):
    frame = pd.concat([walk("A", 300, 1), walk("B", 100, 2).assign(ts=lambda d: d.ts + pd.Timedelta("29h17min"))])
    frame.loc[frame.bar_no % 6 == 0, "open"] = np.nan
    frame.loc[frame.bar_no % 5 == 4, "close"] = np.nan
    got = resample_bars(to_spark(spark, frame).drop("bar_no", "n_bars"), seconds).toPandas()
    how = {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum"}
    want = pd.concat([
        d.set_index("ts").resample(rule).agg(how).dropna().reset_index().assign(symbol=s) for s, d in frame.groupby("symbol")
    ])
    key = ["symbol", "ts"]
    pd.testing.assert_frame_equal(
        got.sort_values(key).reset_index(drop=True), want.sort_values(key)[got.columns].reset_index(drop=True),
        check_dtype=False)


def test_staged_tables_lie_in_the_shared_folder(spark):
    df = stage(spark.range(10), "probe")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark) == named
    assert named.removeprefix("file:") in df.inputFiles()[0]


def test_stream_equals_batch(spark, tmp_path):
    ticks = [(s, f"2024-01-01 {h:02d}:{m:02d}:00", float(h * 60 + m + len(s)), 1.0)
             for s in ("A", "BB") for h in range(5) for m in range(0, 60, 7)]
    # The watermark of a batch applies from the second batch after it.
    later = [("A", "2024-01-01 05:00:00", 7.0, 1.0)]
    late = [("A", "2024-01-01 00:05:00", 99.0, 1.0)]
    schema = "symbol string, ts timestamp, price double, volume double"
    for i, part in enumerate((ticks, later, late, [("A", "2024-01-02 00:00:00", 1.0, 1.0)])):
        spark.createDataFrame(part, "symbol string, ts string, price double, volume double").withColumn(
            "ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in"))
    query = (
        stream_bars(source, "1 hour", "30 minutes").writeStream.outputMode("append").format("memory")
        .queryName("bars").option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.processAllAvailable()
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    query.stop()
    frame = pd.DataFrame(ticks + later, columns=["symbol", "ts", "price", "volume"])
    frame["ts"] = pd.to_datetime(frame.ts).dt.floor("h")
    want = {k: (d.price.iloc[0], d.price.max(), d.price.min(), d.price.iloc[-1], len(d)) for k, d in frame.groupby(["symbol", "ts"])}
    got = {(r["symbol"], pd.Timestamp(r["ts"])): tuple(r)[2:] for r in spark.table("bars").collect()}
    assert got == want and dropped == 1


@pytest.mark.parametrize("per_range", [1, 50, 4_000_000])
def test_derived_ticks_for_any_key_range(spark, per_range):
    from barlab.sources.derived import TIE_BREAK, lineitem_ticks

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    got = lineitem_ticks(lines, 3, per_range).toPandas().sort_values(["symbol", "ts", *TIE_BREAK])
    frame = lines.toPandas()
    frame["symbol"] = "S" + (frame.l_suppkey % 3).astype(str)
    frame = frame.sort_values(["symbol", "l_shipdate", *TIE_BREAK])
    k = ((frame.l_discount * 100).round().astype(int) - 5).groupby(frame.symbol).cumsum()
    want = (200 + ((5 * k + 800) % 3200 - 1600).abs()) / 100
    assert np.array_equal(got.px.to_numpy(), want.to_numpy())


def test_staged_tables_end_with_their_scope(spark):
    with staged_tables(spark):
        inner = stage(spark.range(5), "scoped")
        assert inner.count() == 5
        path = inner.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert Path(path).exists()
    assert not Path(path).exists()
