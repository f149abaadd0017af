"""The registered queries: each operator on data derived from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions import scalars
from barlab.operators import calibration, describe, evaluate, metrics, model, quality, rules, splits, touch, trades
from barlab.operators import indicators as ind
from barlab.operators.features import feature_frame, momentum_entries, with_atr_alias
from barlab.operators.panel import SUB, fill_forward, number_bars
from barlab.operators.reach import durations_by_ratio
from barlab.operators.recipes import Recipe, with_indicators
from barlab.operators.resample import resample_bars, resample_calendar, ticks_as_bars
from barlab.operators.rules import Rule
from barlab.operators.sampling import hash_sample
from barlab.params import FEATURE_COLUMNS
from barlab.plans.apply_rules import apply_rules, out_of_sample, split_performance
from barlab.plans.calibrate import admitted_universe, calibrate
from barlab.plans.discover import discover_rules, labeled_table
from barlab.session import shared_folder, stage
from barlab.sources.bars import read_bars, read_symbol_files
from barlab.sources.derived import lineitem_bars
from barlab.sources.rule_files import read_rules
from barlab.sources.sinks import write_symbol_files, write_table
from barlab.sources.universe import parse_symbols, read_universe

# Parameters of the queries. Thresholds lie off the price grid, where two engines
# that add in a different order could disagree.
RULES = [
    Rule(0, (("RSI_14", "<=", 38.123), ("VWAP_20", "<=", 9.0371))),
    Rule(1, (("RSI_14", ">", 61.877), ("ADX_14", ">", 20.0137))),
    Rule(2, (("ER_Kaufman_10", ">", 0.30071), ("dist_ema20_pct", ">", 0.50029))),
    Rule(3, (("VWAP_20", ">", 4.1283), ("VWAP_20", "<=", 15.0891), ("EMA_20", "<=", 13.6523))),
    Rule(4, (("MACD_hist", ">", 0.01003), ("RVOL_20", ">=", 1.10007))),
    Rule(5, (("ATR_50", ">", 100.0),)),
    Rule(6, (("dist_bb_lower_pct", "<", -0.10003),)),
]
CSL = 2.0
RATIOS = (1.0, 1.5, 2.0)
LEARNER = model.Learner(rate=0.2)

_prepared: dict[tuple[str, str, str], DataFrame] = {}
_models: dict[tuple[str, str], model.FittedRules] = {}


def _once(name: str, spark: SparkSession, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stage an ingested table once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _prepared:
        _prepared[key] = stage(build(), name)
    return _prepared[key]


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once("panel", spark, sf_dir, lambda: number_bars(lineitem_bars(spark, sf_dir)))


def enough(spark: SparkSession, sf_dir: str) -> int:
    """As many bars as 99 of 100 of the largest symbol: some symbols have them and some may not, at every size."""
    return (panel(spark, sf_dir).agg(F.max("n_bars")).first()[0] or 0) * 99 // 100


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once("features", spark, sf_dir, lambda: feature_frame(panel(spark, sf_dir), dense=True))


def own_csl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients calibrated on the feature frame."""
    return _once("csl", spark, sf_dir, lambda: calibration.stop_coefficients(features(spark, sf_dir)))


def fixed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once("trades", spark, sf_dir, lambda: trades.run_trades(features(spark, sf_dir), RULES, CSL))


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once("labels", spark, sf_dir, lambda: touch.label_bars(features(spark, sf_dir), CSL, binary=False))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.lit(1.0).alias("volume")
    )


# A volume-weighted price is a ratio of whole numbers and can end exactly on half a
# unit of the sixth digit.
DIGITS = {"VWAP": 9, "VWAP_20": 9}


def r6(*columns: str) -> list[Column]:
    return [F.round(c, DIGITS.get(c, 6)).alias(c) for c in columns]


def _indicator(*build: Callable[[], Recipe]) -> Callable[[SparkSession, str], DataFrame]:
    """Indicators on the panel, each output rounded to 6 digits."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        recipes = [b() for b in build]
        outputs = [c for r in recipes for c in r.outputs]
        return with_indicators(panel(spark, sf_dir), *recipes).select("symbol", "bar_no", *r6(*outputs))

    return query


def q_resample_week(spark, sf_dir):
    return resample_bars(lineitem_bars(spark, sf_dir), 7 * 86_400)


def q_resample_hour(spark, sf_dir):
    return resample_bars(ticks_as_bars(event_ticks(spark, sf_dir)), 3_600)


def q_resample_seven_hours(spark, sf_dir):
    return resample_bars(ticks_as_bars(event_ticks(spark, sf_dir)), 7 * 3_600)


def q_resample_calendar_week(spark, sf_dir):
    return resample_calendar(lineitem_bars(spark, sf_dir), "week")


def q_resample_month(spark, sf_dir):
    return resample_calendar(lineitem_bars(spark, sf_dir), "month")


def q_ema_gaps(spark, sf_dir):
    """Half of every 700 bars miss their close, and of the others every third."""
    known = (F.col("bar_no") % 700 < 350) & (F.col("bar_no") % 3 != 1)
    holes = panel(spark, sf_dir).withColumn("close", F.when(known, F.col("close")))
    return with_indicators(holes, ind.ema("close", 9, "EMA_9"), block=SUB).select("symbol", "bar_no", *r6("EMA_9"))


def symbol_files(spark, sf_dir):
    """A folder of files per symbol, in two column orders, and one file without a usable header."""
    folder = f"{shared_folder(spark)}/barlab/symbol-files-{uuid.uuid4().hex}"
    day, time = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    bars = lineitem_bars(spark, sf_dir).select(
        "symbol", day.alias("Date"), time.alias("Time"), *[F.col(c.lower()).alias(c) for c in ("Open", "High", "Low", "Close", "Volume")],
        F.lit('a "b", c').alias("Note"),
    )
    even = F.substring("symbol", 2, 9).cast("int") % 2 == 0
    write_symbol_files(bars.filter(even), f"{folder}/even", ["Date", "Time", "Open", "High", "Low", "Close", "Volume"])
    write_symbol_files(bars.filter(~even), f"{folder}/odd", ["Volume", "Note", "Close", "Low", "High", "Open", "Time", "Date"])
    write_symbol_files(bars.filter("symbol = 'S0'"), f"{folder}/bad", ["Date", "Open", "High", "Low", "Close"])
    return read_symbol_files(spark, folder)


def q_forward_fill(spark, sf_dir):
    holes = panel(spark, sf_dir).select(
        "symbol", "bar_no", "n_bars",
        F.when(F.col("volume") % 3 == 0, F.col("close")).alias("close"),
        F.when(F.col("bar_no") % 50 == 7, F.col("volume")).alias("volume"),
    )
    return fill_forward(holes, ["close", "volume"]).select("symbol", "bar_no", "close", "volume")


def q_features(spark, sf_dir):
    return features(spark, sf_dir).select(
        "symbol", "ts", "bar_no", "n_bars", "open", "high", "low", "close", "volume", *r6(*FEATURE_COLUMNS)
    )


def q_atr_alias(spark, sf_dir):
    return with_atr_alias(features(spark, sf_dir)).select("symbol", "bar_no", *r6("ATR", "ATR_50"))


def q_momentum_entries(spark, sf_dir):
    return momentum_entries(panel(spark, sf_dir)).select("symbol", "bar_no")


def q_sample(spark, sf_dir):
    return hash_sample(panel(spark, sf_dir).select("symbol", "bar_no", "close"), 500, 42)


def q_drop_candidates(spark, sf_dir):
    return calibration.drop_candidates(panel(spark, sf_dir)).select("symbol", "bar_no", *r6("coef"))


def q_stop_coefficients(spark, sf_dir):
    return calibration.stop_coefficients(panel(spark, sf_dir)).select(
        "symbol", "n_candidates", "n_kept", *r6("csl_median", "csl")
    )


def q_buying_power(spark, sf_dir):
    csl = calibration.symbols_of(panel(spark, sf_dir)).select("symbol", F.lit(CSL).alias("csl"))
    return calibration.buying_power_check(panel(spark, sf_dir), csl).select(
        "symbol", *r6("bp_median", "bp_max"), "n_samples", "admitted"
    )


def _calibration(spark, sf_dir):
    return calibrate(panel(spark, sf_dir), fewest_bars=enough(spark, sf_dir))


def q_calibration(spark, sf_dir):
    return _calibration(spark, sf_dir).select(
        "symbol", *r6("csl", "bp_median", "bp_max"), "n_samples", "admitted", "error"
    )


def q_admitted_universe(spark, sf_dir):
    return admitted_universe(_calibration(spark, sf_dir)).select(
        "ticker", *r6("csl", "bp_median", "bp_max"), "n_samples"
    )


def q_sizing(spark, sf_dir):
    rich = with_indicators(panel(spark, sf_dir), ind.atr(50, "atr", 8))
    close, atr, csl = F.col("close"), F.col("atr"), F.lit(CSL)
    return rich.select(
        "symbol", "bar_no",
        F.round(scalars.stop_price(close, atr, csl), 6).alias("stop"),
        F.round(scalars.target_price(close, atr, csl), 6).alias("target"),
        scalars.position_size(atr, csl, 100.0).alias("size"),
        F.round(scalars.buying_power(close, atr, csl, 100.0), 6).alias("power"),
    )


def q_labels(spark, sf_dir):
    return labeled(spark, sf_dir).select("symbol", "bar_no", "label", "entry_bar")


def q_labels_own_csl(spark, sf_dir):
    signal = F.col("ER_Kaufman_10") > 0.30071
    rows = touch.label_bars(features(spark, sf_dir), own_csl(spark, sf_dir), signal=signal)
    return rows.select("symbol", "bar_no", "label")


def q_label_counts(spark, sf_dir):
    return describe.label_counts(labeled(spark, sf_dir))


def _barriers() -> tuple[Column, Column]:
    atr = F.round("ATR_50", 8)
    return F.col("close") - atr * CSL, F.col("close") + atr * (CSL * 1.5)


def q_durations(spark, sf_dir):
    stop, target = _barriers()
    return touch.trade_durations(features(spark, sf_dir), stop, target, 100)


def q_durations_by_ratio(spark, sf_dir):
    return durations_by_ratio(features(spark, sf_dir), F.col("close"), F.round("ATR_50", 8), CSL, RATIOS)


def _rule_texts(spark, sf_dir):
    """Rules written as text from each symbol's yearly mean price."""
    yearly = panel(spark, sf_dir).groupBy("symbol", F.year("ts").alias("year")).agg(
        F.avg("close").alias("mean"), F.max("high").alias("top"), F.count(F.lit(1)).alias("n")
    )
    number = F.substring("symbol", 2, 9).cast("int") * 100 + F.col("year") - 1990
    text = scalars.condition_text
    return yearly.select(
        number.cast("int").alias("rule_id"),
        F.array(
            text(F.lit("VWAP_20"), F.lit("<="), F.floor("mean").cast("double") + 0.25),
            text(F.lit("VWAP_20"), F.lit("<="), F.col("top")),
            text(F.lit("VWAP_20"), F.lit(">"), F.lit(2.5)),
            F.when(F.col("year") % 3 == 0, F.lit("close above the cloud")).otherwise(F.lit("RSI_14 > 55")),
            F.lit("ATR_50>=-0.5"),
        ).alias("conditions"),
    )


def q_rule_conditions(spark, sf_dir):
    return rules.parse_conditions(_rule_texts(spark, sf_dir))


def q_rejected_rules(spark, sf_dir):
    return rules.rejected_rules(rules.parse_conditions(_rule_texts(spark, sf_dir)))


def q_rule_bounds(spark, sf_dir):
    return rules.merge_bounds(rules.parse_conditions(_rule_texts(spark, sf_dir)))


def q_rule_hits(spark, sf_dir):
    return rules.rule_hits(features(spark, sf_dir), RULES).select("symbol", "bar_no", "rule_id")


def q_signal_counts(spark, sf_dir):
    return rules.signal_counts(features(spark, sf_dir), RULES)


MONEY = ["price_in", "price_out", "pnl", "mae", "mfe", "stop", "target"]


def q_entry_exits(spark, sf_dir):
    exits = trades.entry_exits(features(spark, sf_dir), rules.matched_rules(RULES), CSL)
    return exits.select(
        "symbol", "entry_bar", "exit_bar", "entry_ts", "exit_ts", *r6(*MONEY), "reason", "bars_held", "size",
        F.size("rules").alias("n_rules"),
    )


def q_trades(spark, sf_dir):
    return fixed_trades(spark, sf_dir).select(
        "symbol", "rule_id", "entry_bar", "exit_bar", "entry_ts", "exit_ts", *r6(*MONEY), "reason", "bars_held", "size"
    )


def q_signal_trades(spark, sf_dir):
    """One signal, explicit target multiple."""
    taken = trades.run_signal(features(spark, sf_dir), F.col("RSI_14") > 55.123, CSL, c_tp=3.2)
    return taken.select("symbol", "entry_bar", "exit_bar", *r6("pnl"), "reason")


def q_trade_curve(spark, sf_dir):
    curve = metrics.trade_curve(fixed_trades(spark, sf_dir))
    return curve.select("symbol", "rule_id", "trade_no", *r6("pnl", "cum_pnl", "drawdown_pct"))


METRICS = [
    "win_rate", "profit_factor", "expectancy", "avg_win", "avg_loss", "max_drawdown_pct", "sharpe", "total_pnl",
    "return_pct", "final_capital", "corr_trade_vs_pnl",
]


def q_performance(spark, sf_dir):
    return metrics.performance(fixed_trades(spark, sf_dir)).select("symbol", "rule_id", "n_trades", *r6(*METRICS))


RESULT_NUMBERS = ["total_pnl", "return_pct", "win_rate", "profit_factor", "max_drawdown_pct", "sharpe", "corr_trade_vs_pnl"]


def _results(spark, sf_dir):
    return _once(
        "results", spark, sf_dir,
        lambda: apply_rules(features(spark, sf_dir), RULES, own_csl(spark, sf_dir)).results,
    )


def q_results(spark, sf_dir):
    return _results(spark, sf_dir).select("symbol", "rule_id", "n_signals", "n_trades", *r6("csl", *RESULT_NUMBERS))


def q_strategy_summary(spark, sf_dir):
    return metrics.strategy_summary(_results(spark, sf_dir)).select(
        "rule_id", "symbols", "trades",
        *r6("pnl_total", "mean_return_pct", "mean_win_rate", "mean_profit_factor"),
    )


def q_selected_results(spark, sf_dir):
    return metrics.select_results(_results(spark, sf_dir)).select("symbol", "rule_id", *r6("total_pnl"))


def q_best_results(spark, sf_dir):
    best = metrics.best_results(metrics.select_results(_results(spark, sf_dir)), 10)
    return best.select(
        "symbol", "rule_id", *r6("total_pnl", "return_pct", "corr_trade_vs_pnl", "max_drawdown_pct")
    )


def q_describe(spark, sf_dir):
    table = describe.describe_columns(features(spark, sf_dir), ["close", *FEATURE_COLUMNS])
    return table.select("symbol", "feature", "count", *r6("mean", "std", "min", "p25", "p50", "p75", "max"))


def q_medians(spark, sf_dir):
    values = panel(spark, sf_dir).select("symbol", "bar_no", F.col("close").alias("value"))
    return describe.exact_quantiles(values, ["symbol"], [0.5]).select("symbol", F.round("q0", 6).alias("median"))


EDA_NUMBERS = ["price_mean", "price_std", "atr_mean", "atr_std", "er_mean", "er_std", "er_above_thresh_pct"]


def q_eda_summary(spark, sf_dir):
    return describe.eda_summary(features(spark, sf_dir), own_csl(spark, sf_dir)).select(
        "symbol", "n_bars", "first_day", "last_day", *r6("csl", *EDA_NUMBERS)
    )


def q_eda_rollup(spark, sf_dir):
    return describe.eda_rollup(describe.eda_summary(features(spark, sf_dir))).select(
        "n_symbols", "n_bars", *r6("price_mean", "atr_mean", "er_mean", "er_above_thresh_pct")
    )


def q_split_summary(spark, sf_dir):
    return splits.split_summary(splits.split_by_time(labeled(spark, sf_dir)))


def q_row_order_head(spark, sf_dir):
    return splits.head_by_row_order(labeled(spark, sf_dir).select("symbol", "ts", "label"), 0.7)


def q_folds(spark, sf_dir):
    return splits.fold_summary(panel(spark, sf_dir))


def q_evaluation(spark, sf_dir):
    scored = labeled(spark, sf_dir).select(
        "symbol", scalars.binary_target(F.col("label")).alias("label"), (F.col("close") / 20.0).alias("score")
    )
    return evaluate.classification_metrics(scored, ["symbol"]).select(
        "symbol", "tp", "fp", "fn", "tn", *r6("accuracy", "precision", "recall", "f1", "auc")
    )


def q_liquid_bars(spark, sf_dir):
    return quality.liquid_bars(panel(spark, sf_dir), 63, 66.003).select("symbol", "bar_no", *r6("avg_volume"))


def q_good_bars(spark, sf_dir):
    return quality.keep_good(lineitem_bars(spark, sf_dir), enough(spark, sf_dir)).select("symbol", "ts", "close")


def q_symbol_list(spark, sf_dir):
    """A ticker list with padding, mixed case, comment lines and blanks, one line per event."""
    kind = F.col("event_id") % 4
    line = (
        F.when(kind == 0, F.concat(F.lit("# "), "event_type"))
        .when(kind == 1, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), "event_type", (F.col("user_id") % 7).cast("string"), F.lit(" ")))
    )
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select(line.alias("value"))
    return parse_symbols(lines).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def q_out_of_sample(spark, sf_dir):
    sizes = calibration.symbols_of(features(spark, sf_dir))
    cut = sizes.select("symbol", F.floor(F.col("n_bars") * 0.7).alias("split_bar"))
    train, test = split_performance(fixed_trades(spark, sf_dir), cut)
    return out_of_sample(train, test).select(
        "symbol", "rule_id", "n_trades_train", "n_trades_test",
        *r6("profit_factor_train", "profit_factor_test", "total_pnl_train", "total_pnl_test"),
    )


def fitted_rules(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        split = labeled_table(features(spark, sf_dir), CSL)
        _models[key] = discover_rules(split, LEARNER)
    return _models[key]


def q_tree_split(spark, sf_dir):
    """The first split of a tree over inputs with few values, where every midpoint between values is tried."""
    split = splits.split_by_time(labeled(spark, sf_dir)).filter(F.col("part") == "train")
    inputs = ["rsi_step", "price_step"]
    rows = split.select(
        scalars.binary_target(F.col("label")).cast("double").alias("tp"),
        F.floor(F.round("RSI_14", 6) / 2).cast("double").alias("rsi_step"),
        F.floor(F.round(F.col("close") * 100) / 10).cast("double").alias("price_step"),
    )
    tree = model.train_tree(stage(rows, "inputs"), inputs, "tp", model.Learner(levels=1))
    leaves = model.leaf_rules(spark, model.node_table(spark, tree), inputs, 30, 0.0)
    return leaves.select("rule_id", F.explode("conditions").alias("c"), "n_samples", F.round("p_label_1", 9).alias("p")).select(
        "rule_id", "c.feature", "c.op", "c.threshold", "n_samples", "p"
    )


def q_learned_rules(spark, sf_dir):
    return model.rules_as_text(fitted_rules(spark, sf_dir).rules)


def q_feature_importance(spark, sf_dir):
    return fitted_rules(spark, sf_dir).importances


def q_top_features(spark, sf_dir):
    """The ranking of inputs, weighted here by the spread of each."""
    long = describe.long_values(labeled(spark, sf_dir), FEATURE_COLUMNS)
    spread = long.groupBy("feature").agg(F.round(F.stddev_samp("value"), 6).alias("importance"))
    order = F.array_position(F.array(*[F.lit(c) for c in FEATURE_COLUMNS]), F.col("feature"))
    ranked = spread.withColumn("pos", (order - 1).cast("int"))
    return model.top_features(ranked, 5).select("feature", "importance", "pos")


def q_bars_csv(spark, sf_dir):
    """The bars written as CSV and read back."""
    path = f"{shared_folder(spark)}/barlab/bars-{uuid.uuid4().hex}"
    write_table(panel(spark, sf_dir).drop("bar_no", "n_bars"), path, "csv", order=("symbol", "ts"))
    return read_bars(spark, path, "csv")


def q_universe_csv(spark, sf_dir):
    """The calibrated symbols written as CSV, read back, and joined to their bars."""
    path = f"{shared_folder(spark)}/barlab/universe-{uuid.uuid4().hex}"
    csl = calibration.symbols_of(panel(spark, sf_dir)).select("symbol", F.lit(CSL).alias("csl"))
    power = calibration.buying_power_check(panel(spark, sf_dir), csl).join(csl, "symbol")
    write_table(admitted_universe(power), path, "csv")
    known = read_universe(spark, path).select("symbol", "csl", *r6("bp_median"), "n_samples")
    return panel(spark, sf_dir).groupBy("symbol").agg(F.max("ts").alias("last_ts")).join(known, "symbol")


def q_rules_json(spark, sf_dir):
    """Rules written as JSON and read back."""
    path = f"{shared_folder(spark)}/barlab/rules-{uuid.uuid4().hex}"
    write_table(_rule_texts(spark, sf_dir), path, "json")
    read = read_rules(spark, path, one_list=False)
    return read.select("rule_id", F.explode("conditions").alias("text"))


def q_class_weights(spark, sf_dir):
    target = labeled(spark, sf_dir).select(scalars.binary_target(F.col("label")).alias("target"))
    return model.balanced(target, "target").groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 9).alias("weight")
    )


def q_rule_rates(spark, sf_dir):
    """Rows and share of positives of each rule among the train rows."""
    split = splits.split_by_time(labeled(spark, sf_dir)).filter(F.col("part") == "train")
    return rules.rule_rates(split, RULES).select("rule_id", "n_samples", *r6("p_label_1"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars": lineitem_bars,
    "panel": lambda s, d: panel(s, d).select("symbol", "ts", "bar_no", "n_bars", "close"),
    "resample_week": q_resample_week,
    "resample_hour": q_resample_hour,
    "resample_seven_hours": q_resample_seven_hours,
    "resample_calendar_week": q_resample_calendar_week,
    "resample_month": q_resample_month,
    "ema_gaps": q_ema_gaps,
    "symbol_files": lambda s, d: symbol_files(s, d)[0],
    "symbol_file_rejects": lambda s, d: symbol_files(s, d)[1].drop("file"),
    "quality": lambda s, d: quality.check_bars(lineitem_bars(s, d), enough(s, d)),
    "good_bars": q_good_bars,
    "symbol_list": q_symbol_list,
    "forward_fill": q_forward_fill,
    "atr": _indicator(lambda: ind.atr(14)),
    "sma": _indicator(lambda: ind.sma("close", 10, "SMA")),
    "ema": _indicator(
        lambda: ind.ema("close", 20, "EMA_20", dense=True), lambda: ind.ema("close", 50, "EMA_50", dense=True)
    ),
    "rsi": _indicator(ind.rsi),
    "macd": _indicator(lambda: ind.macd(dense=True)),
    "vwap": _indicator(ind.vwap),
    "adx": _indicator(ind.adx),
    "momentum": _indicator(ind.momentum),
    "volatility": _indicator(ind.volatility),
    "gap": _indicator(ind.gap),
    "rvol": _indicator(ind.rvol),
    "efficiency_ratio": _indicator(ind.efficiency_ratio),
    "bollinger": _indicator(ind.bollinger),
    "distance_to_mean": _indicator(lambda: ind.distance_pct(ind.vwap(), "VWAP", "dist_vwap_pct")),
    "candles": _indicator(ind.candles),
    "momentum_entries": q_momentum_entries,
    "liquid_bars": q_liquid_bars,
    "features": q_features,
    "atr_alias": q_atr_alias,
    "sample": q_sample,
    "drop_candidates": q_drop_candidates,
    "stop_coefficients": q_stop_coefficients,
    "buying_power": q_buying_power,
    "calibration": q_calibration,
    "admitted_universe": q_admitted_universe,
    "sizing": q_sizing,
    "labels": q_labels,
    "labels_own_csl": q_labels_own_csl,
    "label_counts": q_label_counts,
    "durations": q_durations,
    "durations_by_ratio": q_durations_by_ratio,
    "rule_conditions": q_rule_conditions,
    "rejected_rules": q_rejected_rules,
    "rule_bounds": q_rule_bounds,
    "rule_hits": q_rule_hits,
    "signal_counts": q_signal_counts,
    "entry_exits": q_entry_exits,
    "trades": q_trades,
    "signal_trades": q_signal_trades,
    "trade_curve": q_trade_curve,
    "performance": q_performance,
    "results": q_results,
    "strategy_summary": q_strategy_summary,
    "selected_results": q_selected_results,
    "best_results": q_best_results,
    "describe": q_describe,
    "medians": q_medians,
    "eda_summary": q_eda_summary,
    "eda_rollup": q_eda_rollup,
    "split_summary": q_split_summary,
    "row_order_head": q_row_order_head,
    "folds": q_folds,
    "evaluation": q_evaluation,
    "out_of_sample": q_out_of_sample,
    "top_features": q_top_features,
    "bars_csv": q_bars_csv,
    "universe_csv": q_universe_csv,
    "rules_json": q_rules_json,
    "class_weights": q_class_weights,
    "rule_rates": q_rule_rates,
    "tree_split": q_tree_split,
    "learned_rules": q_learned_rules,
    "feature_importance": q_feature_importance,
}
