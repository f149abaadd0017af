"""Performance of trades per (symbol, rule), and result selection.

Running sums and peaks are taken in two levels, inside blocks of trades and over
the blocks, so that one very active pair is no single task. Stage the trades
first: they are read twice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.operators.panel import BLOCK

KEYS = ["symbol", "rule_id"]
PERIODS = 252


def trade_curve(trades: DataFrame, capital: float = 10_000.0, block: int = BLOCK) -> DataFrame:
    """The trades plus ``trade_no`` (from 1), ``cum_pnl`` and ``drawdown_pct``.

    The drawdown is taken against the highest equity after any trade so far.
    """
    run = Window.partitionBy(*KEYS, "_blk").orderBy("entry_bar")
    so_far = run.rowsBetween(Window.unboundedPreceding, 0)
    local = (
        trades.withColumn("_blk", F.expr(f"entry_bar div {block}L"))
        .withColumns({"_cum": F.sum("pnl").over(so_far), "_no": F.row_number().over(run)})
        .withColumn("_top", F.max("_cum").over(so_far))
    )
    # Per block: its total, its trades and its highest point, all from its own start.
    blocks = local.groupBy(*KEYS, "_blk").agg(
        F.sum("pnl").alias("_pnl"), F.count(F.lit(1)).alias("_n"), F.max("_cum").alias("_high")
    )
    before = Window.partitionBy(*KEYS).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    start = (
        blocks.withColumns({
            "_pnl0": F.coalesce(F.sum("_pnl").over(before), F.lit(0.0)),
            "_no0": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        })
        .withColumn("_high0", F.max(F.col("_pnl0") + F.col("_high")).over(before))
        .select(*KEYS, "_blk", "_pnl0", "_no0", "_high0")
    )
    peak = F.greatest(F.col("_pnl0") + F.col("_top"), F.col("_high0")) + capital
    return (
        local.join(start, [*KEYS, "_blk"])
        .withColumns({"trade_no": F.col("_no0") + F.col("_no"), "cum_pnl": F.col("_pnl0") + F.col("_cum")})
        .withColumn("drawdown_pct", F.try_divide(F.col("cum_pnl") + capital - peak, peak) * 100)
        .select(*trades.columns, "trade_no", "cum_pnl", "drawdown_pct")
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; null over a constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def performance(trades: DataFrame, capital: float = 10_000.0, block: int = BLOCK) -> DataFrame:
    """One row of metrics per (symbol, rule) that traded."""
    rows = trade_curve(trades, capital, block)
    win, pnl = F.col("pnl") > 0, F.col("pnl")
    no = F.col("trade_no").cast("double")
    raw = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.avg(win.cast("int")).alias("win_rate"),
        F.coalesce(F.avg(F.when(win, pnl)), F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.avg(F.when(~win, pnl)), F.lit(0.0)).alias("avg_loss"),
        F.coalesce(F.sum(F.when(win, pnl)), F.lit(0.0)).alias("_won"),
        F.coalesce(F.sum(F.when(~win, pnl)), F.lit(0.0)).alias("_lost"),
        F.min("drawdown_pct").alias("max_drawdown_pct"),
        F.avg(pnl / capital).alias("_mean"),
        F.stddev_samp(pnl / capital).alias("_std"),
        F.sum(pnl).alias("total_pnl"),
        correlation(no, F.col("cum_pnl")).alias("_corr"),
    )
    return raw.select(
        *KEYS,
        "n_trades",
        "win_rate",
        F.when(F.col("_lost") == 0, float("inf")).otherwise(F.try_divide("_won", F.abs("_lost"))).alias("profit_factor"),
        (F.col("win_rate") * F.col("avg_win") + (1 - F.col("win_rate")) * F.col("avg_loss")).alias("expectancy"),
        "avg_win",
        "avg_loss",
        "max_drawdown_pct",
        F.when(F.col("_std") > 0, F.try_divide("_mean", "_std") * math.sqrt(PERIODS)).otherwise(0.0).alias("sharpe"),
        "total_pnl",
        (F.col("total_pnl") / capital * 100).alias("return_pct"),
        (F.col("total_pnl") + capital).alias("final_capital"),
        F.when(F.col("n_trades") > 1, F.col("_corr")).otherwise(0.0).alias("corr_trade_vs_pnl"),
    )


def results(signals: DataFrame, metrics: DataFrame, csl: DataFrame) -> DataFrame:
    """A row per (symbol, rule) with a signal; pairs without trades show zeros."""
    zeros = [
        "n_trades", "total_pnl", "return_pct", "win_rate", "profit_factor", "max_drawdown_pct", "sharpe",
    ]
    return (
        signals.join(csl.filter(F.col("csl").isNotNull()).select("symbol", "csl"), "symbol")
        .join(metrics, KEYS, "left")
        .withColumn(
            "corr_trade_vs_pnl", F.when(F.col("n_trades").isNull(), 0.0).otherwise(F.col("corr_trade_vs_pnl"))
        )
        .na.fill(0, zeros)
        .select(*KEYS, "csl", "n_signals", *zeros, "corr_trade_vs_pnl")
    )


def strategy_summary(results_: DataFrame) -> DataFrame:
    """Per rule: symbols, trades, PnL and mean ratios, best PnL first."""
    return (
        results_.groupBy("rule_id")
        .agg(
            F.count_distinct("symbol").alias("symbols"),
            F.sum("n_trades").alias("trades"),
            F.sum("total_pnl").alias("pnl_total"),
            F.avg("return_pct").alias("mean_return_pct"),
            F.avg("win_rate").alias("mean_win_rate"),
            F.avg("profit_factor").alias("mean_profit_factor"),
        )
        .orderBy(F.desc("pnl_total"), "rule_id")
    )


def select_results(results_: DataFrame) -> DataFrame:
    """Profitable, steady results; if there are none, a weaker demand on steadiness.

    The choice is one flag joined to every row, not a branch on the driver.
    """
    gain, corr = F.col("total_pnl") > 0, F.col("corr_trade_vs_pnl")
    strict = F.coalesce(gain & (corr > 0.3) & (F.col("max_drawdown_pct") > -35), F.lit(False))
    loose = F.coalesce(gain & (corr > 0.1), F.lit(False))
    flagged = results_.withColumns({"_strict": strict, "_loose": loose, "_one": F.lit(1)})
    any_strict = flagged.groupBy("_one").agg(F.max("_strict").alias("_any"))
    return (
        # One row by construction.
        flagged.join(F.broadcast(any_strict), "_one")
        .filter(F.when(F.col("_any"), F.col("_strict")).otherwise(F.col("_loose")))
        .drop("_strict", "_loose", "_one", "_any")
    )


def best_results(selected: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best by PnL, then correlation."""
    return selected.orderBy(F.desc("total_pnl"), F.desc("corr_trade_vs_pnl"), "symbol", "rule_id").limit(k)
