"""Further registered queries: many rules, long horizons, folds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions import scalars
from barlab.operators import indicators as ind
from barlab.operators import calibration, describe, long_touch, model, rule_index, rules, splits, touch, trades
from barlab.operators.features import Periods, feature_columns, feature_frame, feature_names
from barlab.operators.panel import SUB, bucketed
from barlab.operators.recipes import with_indicators
from barlab.params import FEATURE_COLUMNS
from barlab.plans.apply_rules import rules_library, split_performance
from barlab.session import shared_folder, stage
from barlab.sources.bars import read_frames, read_symbol_files
from barlab.sources.derived import lineitem_bars
from barlab.sources.library import publish, read_library
from barlab.sources.rule_files import export_rules, read_rules
from barlab.sources.sinks import write_symbol_files, write_symbol_folders
from barlab.streaming.bars import late_ticks, stream_bars
from barlab.streaming.replay import replay
from checks.queries import CSL, MONEY, RULES, features, fitted_rules, fixed_trades, labeled, panel, r6

#: A horizon of about eight years of days.
LONG_BARS = 2_000
LONG_LABEL_BARS = 600


def many_rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per symbol and week, with bounds from the week's prices; some cannot be read, some contradict themselves."""
    week = F.expr("cast(datediff(ts, date'1990-01-01') div 7 as int)")
    weekly = features(spark, sf_dir).groupBy("symbol", week.alias("week")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    text, number, w = scalars.condition_text, F.substring("symbol", 2, 9).cast("int"), F.col("week")
    return weekly.select(
        (number * 10_000 + w).cast("int").alias("rule_id"),
        F.array(
            text(F.lit("VWAP_20"), F.lit(">"), F.floor("low").cast("double") + 0.137),
            text(F.lit("VWAP_20"), F.lit("<="), F.floor("low").cast("double") + (w % 5) * 0.1 + 0.241),
            text(F.lit("RSI_14"), F.when(w % 2 == 0, ">").otherwise(">="), (w % 45).cast("double") + 20.123),
            text(F.lit("RSI_14"), F.lit("<"), (w % 45).cast("double") + 24.517),
            F.when(w % 3 == 0, text(F.lit("close"), F.lit("<="), F.col("high"))).otherwise(text(F.lit("close"), F.lit("=="), F.col("low"))),
            F.when(w % 41 == 0, F.lit("close under the cloud")).when(w % 43 == 0, F.lit("ROC_11 > 0.5"))
            .when(w % 47 == 0, F.lit("RSI_14 < 5.5")).otherwise(F.lit("ATR_50 > -0.5")),
        ).alias("conditions"),
    )


def q_rule_hits_many(spark, sf_dir):
    parsed = rules.parse_conditions(many_rule_texts(spark, sf_dir))
    return rule_index.rule_hits_many(features(spark, sf_dir), parsed).select("symbol", "bar_no", "rule_id")


def q_signal_counts_many(spark, sf_dir):
    parsed = rules.parse_conditions(many_rule_texts(spark, sf_dir))
    return rule_index.signal_counts_many(features(spark, sf_dir), parsed)


def q_durations_long(spark, sf_dir):
    """Wide barriers, many of which stay untouched for years."""
    atr = F.round("ATR_50", 8)
    return long_touch.durations_long(features(spark, sf_dir), F.col("close") - atr * 9.37, F.col("close") + atr * 11.83, LONG_BARS)


def q_labels_long(spark, sf_dir):
    rows = long_touch.label_bars_long(features(spark, sf_dir), 7.31, LONG_LABEL_BARS, binary=False)
    return rows.select("symbol", "bar_no", "label", "entry_bar")


def q_exits_long(spark, sf_dir):
    exits = long_touch.entry_exits_long(features(spark, sf_dir), rules.matched_rules(RULES), 6.13, LONG_LABEL_BARS)
    return exits.select(
        "symbol", "entry_bar", "exit_bar", "entry_ts", "exit_ts", *r6(*MONEY), "reason", "bars_held", "size",
        F.size("rules").alias("n_rules"),
    )


def q_macd_gaps(spark, sf_dir):
    """Runs of 350 bars without a close, and of the other bars every third misses it."""
    known = (F.col("bar_no") % 700 < 350) & (F.col("bar_no") % 3 != 1)
    holes = panel(spark, sf_dir).withColumn("close", F.when(known, F.col("close")))
    return with_indicators(holes, ind.macd(), block=SUB).select("symbol", "bar_no", *r6("MACD_line", "MACD_signal", "MACD_hist"))


def q_medians_approx(spark, sf_dir):
    """Whether the median from a sketch has its rank within the stated error, by an exact count."""
    values = panel(spark, sf_dir).select("symbol", F.col("close").alias("value"))
    median = describe.approximate_quantiles(values, ["symbol"], [0.5], 200).withColumnRenamed("q0", "median")
    ranks = values.join(median, "symbol").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("value") < F.col("median")).cast("int")).alias("under"),
        F.avg((F.col("value") <= F.col("median")).cast("int")).alias("up_to"),
    )
    within = (F.col("under") - 1 / 200 <= 0.5) & (F.col("up_to") + 1 / 200 >= 0.5)
    return ranks.select("symbol", "n", within.alias("within"))


def q_walk_forward(spark, sf_dir):
    """Every bar in each of its folds, counted and summed."""
    rows = splits.walk_forward(panel(spark, sf_dir).select("symbol", "ts", "bar_no", "n_bars", "close", "volume"))
    return rows.groupBy("symbol", "fold", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.round(F.sum("close"), 4).alias("closes"), F.round(F.sum("volume"), 4).alias("volumes"),
    )


def q_fold_performance(spark, sf_dir):
    found = splits.fold_performance(features(spark, sf_dir), labeled(spark, sf_dir).select("symbol", "bar_no", "label"))
    return found.select(
        "symbol", "fold", "part", "bars", "labeled", "positives", *r6("rate", "mean_return", "std_return", "total_return")
    )


def file_bars(spark, sf_dir) -> DataFrame:
    """The bars as they stand in files, with a note that needs quotes."""
    day, time = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    bars = lineitem_bars(spark, sf_dir)
    note = F.when(F.dayofmonth("ts") % 3 == 0, F.lit('two\nlines, "quoted"\n')).when(F.dayofmonth("ts") % 3 == 1, F.lit('"\n"')).otherwise(F.lit("plain"))
    return bars.select(
        "symbol", day.alias("Date"), time.alias("Time"), *[F.col(c.lower()).alias(c) for c in ("Open", "High", "Low", "Close", "Volume")], note.alias("Note")
    )


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/barlab/{name}-{uuid.uuid4().hex}"


def q_symbol_files_notes(spark, sf_dir):
    """Files whose quoted cells hold line breaks."""
    folder = _folder(spark, "notes")
    write_symbol_files(file_bars(spark, sf_dir), folder, ["Date", "Note", "Time", "Open", "High", "Low", "Close", "Volume"])
    return read_symbol_files(spark, folder)[0]


def q_symbol_folders(spark, sf_dir):
    """Several files per symbol, in a folder each."""
    folder = _folder(spark, "folders")
    write_symbol_folders(file_bars(spark, sf_dir), folder, ["Volume", "Date", "Time", "Open", "High", "Low", "Close"], ["Date", "Time"])
    return read_symbol_files(spark, folder, folders=True)[0]


def q_feature_files(spark, sf_dir):
    """The feature frame written as a file per symbol and read back."""
    folder, columns = _folder(spark, "features"), ["ts", "open", "high", "low", "close", "volume", *FEATURE_COLUMNS]
    write_symbol_files(features(spark, sf_dir), folder, columns, "features_")
    return read_frames(spark, folder, "features_")[0].select("symbol", "ts", "close", "volume", *r6(*FEATURE_COLUMNS))


def q_labeled_files(spark, sf_dir):
    """Labeled bars written as a file per symbol, with times in a zone, and read back."""
    folder = _folder(spark, "labeled")
    stamp = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(2), F.col("ts")), "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")).alias("Datetime")
    prices = [F.col(c).alias(c.title()) for c in ("open", "high", "low", "close", "volume")]
    rows = labeled(spark, sf_dir).select("symbol", stamp, *prices, *FEATURE_COLUMNS, "label", F.col("entry_bar").alias("entry_idx"))
    write_symbol_files(rows, folder, rows.columns[1:], "labeled_")
    return read_frames(spark, folder, "labeled_", labeled=True)[0].select("symbol", "ts", "close", *r6("RSI_14", "ATR_50"), "label", "entry_bar")


def q_exported_rules(spark, sf_dir):
    """Rules with typed conditions written as JSON with text conditions, and read back."""
    monthly = panel(spark, sf_dir).groupBy("symbol", F.date_trunc("month", "ts").alias("m")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count(F.lit(1)).alias("n"))
    number = F.substring("symbol", 2, 9).cast("int") * 10_000 + F.year("m") * 12 % 10_000 + F.month("m")
    condition = lambda f, op, t: F.struct(F.lit(f).alias("feature"), F.lit(op).alias("op"), t.alias("threshold"))
    typed = monthly.select(
        number.cast("int").alias("rule_id"),
        F.array(condition("VWAP_20", ">", F.col("low")), condition("VWAP_20", "<=", F.col("high") + 0.12345)).alias("conditions"),
        F.col("n").alias("n_samples"), F.lit(0.25).alias("p_label_1"),
    )
    path = _folder(spark, "rules")
    export_rules(typed, path)
    return read_rules(spark, path, one_list=False).select("rule_id", F.posexplode("conditions").alias("pos", "text"), "n_samples", "p_label_1")


def q_model_inputs(spark, sf_dir):
    """The columns found to be model inputs, and the rows that have them all, on labeled rows with holes."""
    rows = labeled(spark, sf_dir)
    holes = rows.withColumn("RSI_14", F.when(F.col("bar_no") % 7 > 0, F.col("RSI_14"))).withColumn("ROC_10", F.when(F.col("bar_no") % 5 > 0, F.col("ROC_10")))
    inputs = feature_columns(holes)
    complete = holes.na.drop(subset=[*inputs, "label"])
    sums = complete.select(F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"), F.col(c).alias("v")) for i, c in enumerate(inputs)])).alias("x"))
    return sums.groupBy("x.pos", "x.feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("x.v"), 4).alias("mean"))


#: Other lengths than the usual ones.
OTHER = Periods(rsi=9, atr=21, emas=(8, 34), vwap=18, macd=(8, 21, 5), rvol=30, er=14, adx=10, momentum=5, volatility=12, sma=40, bollinger=25, width=1.5)


def q_features_periods(spark, sf_dir):
    rows = feature_frame(panel(spark, sf_dir), dense=True, p=OTHER)
    # A price that ends exactly on half a unit of the ninth digit is moved off it.
    rounded = [(F.round(F.col(c) + 1e-11, 9) if c.startswith("VWAP") else F.round(c, 6)).alias(c) for c in feature_names(OTHER)]
    return rows.select("symbol", "ts", "bar_no", "n_bars", *rounded)


def arrivals(spark, sf_dir) -> DataFrame:
    """The events as ticks that come in batches of six days, some a batch or two late."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    at = F.expr("cast(datediff(ts, date'2024-01-01') div 6 as int)")
    delay = F.when(F.col("event_id") % 97 == 0, 2).when(F.col("event_id") % 13 == 0, 1).otherwise(0)
    return events.select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.lit(1.0).alias("volume"),
        (at + delay).alias("batch"),
    )


_replayed: dict[tuple[str, str], dict[str, DataFrame]] = {}


def replayed(spark, sf_dir) -> dict[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _replayed:
        outputs = {"bars": lambda t: stream_bars(t, "1 hour", "1 day"), "late": lambda t: late_ticks(t, "1 hour", "1 day")}
        _replayed[key] = replay(arrivals(spark, sf_dir), "batch", outputs)
    return _replayed[key]


def q_stream_bars(spark, sf_dir):
    bars = replayed(spark, sf_dir)["bars"]
    return bars.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), "open", "high", "low", "close", "volume")


def q_late_ticks(spark, sf_dir):
    return replayed(spark, sf_dir)["late"].groupBy("symbol").agg(
        F.sum("n_late").alias("n_late"), F.max("newest").cast("timestamp_ntz").alias("newest")
    )


def q_rules_library(spark, sf_dir):
    """Two versions published, the second one read."""
    sizes = calibration.symbols_of(features(spark, sf_dir))
    cut = sizes.select("symbol", F.floor(F.col("n_bars") * 0.7).alias("split_bar"))
    train, test = split_performance(fixed_trades(spark, sf_dir), cut)
    texts, folder = rules.rule_texts(spark, RULES), _folder(spark, "library")
    publish(rules_library(train, test, texts, 5.0), folder)
    publish(rules_library(train, test, texts), folder)
    numbers = [f"{c}_{s}" for c in ("profit_factor", "total_pnl", "win_rate", "max_drawdown_pct") for s in ("train", "test")]
    return read_library(spark, folder).select("symbol", "rule_id", "rule", "n_trades_train", "n_trades_test", *r6(*numbers))


TREE_INPUTS = ["rsi_step", "price_step", "er_step", "rvol_step"]
TREE = model.Learner(levels=4, leaf=30, rate=0.2)


def tree_rows(spark, sf_dir) -> DataFrame:
    """Train rows with inputs of few values, where every midpoint between values is tried."""
    split = splits.split_by_time(labeled(spark, sf_dir)).filter(F.col("part") == "train")
    step = lambda c, k: F.floor(F.round(c, 6) * k).cast("double")
    return split.select(
        scalars.binary_target(F.col("label")).cast("double").alias("tp"), step("RSI_14", 0.5).alias("rsi_step"),
        F.floor(F.round(F.col("close") * 100) / 10).cast("double").alias("price_step"), step("ER_Kaufman_10", 10).alias("er_step"),
        F.least(step("RVOL_20", 4), F.lit(40.0)).alias("rvol_step"),
    )


def q_tree_rules(spark, sf_dir):
    """All rules of a tree of four levels, as text."""
    tree = model.train_tree(stage(tree_rows(spark, sf_dir), "inputs"), TREE_INPUTS, "tp", TREE)
    found = model.rules_as_text(model.leaf_rules(spark, model.node_table(spark, tree), TREE_INPUTS, TREE.leaf, TREE.rate))
    return found.select("rule_id", F.array_join("conditions", " AND ").alias("rule"), "n_samples", F.round("p_label_1", 9).alias("p"))


def q_forest_importance(spark, sf_dir):
    """Whether the forest's importances are what the gains of its nodes add up to."""
    fitted = fitted_rules(spark, sf_dir)
    again = model.importance_of_nodes(model.forest_nodes(spark, fitted.forest)).withColumnRenamed("importance", "summed")
    both = fitted.importances.join(again, "pos", "left")
    return both.select("feature", (F.abs(F.col("importance") - F.coalesce("summed", F.lit(0.0))) < 1e-9).alias("agrees"))


def q_bucketed_chain(spark, sf_dir):
    """Features, labels and trades from bucketed tables, counted per rule and label of the entry's signal bar."""
    bars = bucketed(panel(spark, sf_dir), 5_000, 0, "bars")
    rows = bucketed(feature_frame(bars, dense=True), 1, 40, "features")
    marks = touch.label_bars(rows, CSL, binary=False).select("symbol", (F.col("bar_no") + 1).alias("entry_bar"), "label")
    taken = trades.run_trades(rows, RULES, CSL)
    return taken.join(marks, ["symbol", "entry_bar"]).groupBy("rule_id", "label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("pnl"), 4).alias("pnl"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_hits_many": q_rule_hits_many,
    "signal_counts_many": q_signal_counts_many,
    "durations_long": q_durations_long,
    "labels_long": q_labels_long,
    "exits_long": q_exits_long,
    "symbol_files_notes": q_symbol_files_notes,
    "symbol_folders": q_symbol_folders,
    "feature_files": q_feature_files,
    "labeled_files": q_labeled_files,
    "exported_rules": q_exported_rules,
    "model_inputs": q_model_inputs,
    "features_periods": q_features_periods,
    "stream_bars": q_stream_bars,
    "late_ticks": q_late_ticks,
    "rules_library": q_rules_library,
    "tree_rules": q_tree_rules,
    "forest_importance": q_forest_importance,
    "bucketed_chain": q_bucketed_chain,
    "macd_gaps": q_macd_gaps,
    "medians_approx": q_medians_approx,
    "walk_forward": q_walk_forward,
    "fold_performance": q_fold_performance,
}
