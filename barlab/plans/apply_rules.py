"""Rules on all symbols: trades, metrics, results; and the out-of-sample library."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.operators.calibration import Calibration, stop_coefficients
from barlab.operators.metrics import KEYS, performance, results
from barlab.operators.panel import BLOCK
from barlab.operators.rules import Rule, signal_counts
from barlab.operators.trades import run_trades
from barlab.params import TRADE_RISK
from barlab.session import stage


CAPITAL = 10_000.0


@dataclass
class Applied:
    csl: DataFrame
    trades: DataFrame
    metrics: DataFrame
    results: DataFrame


def apply_rules(
    features: DataFrame,
    rules: Sequence[Rule],
    csl: DataFrame | None = None,
    p: Calibration = Calibration(),
    max_bars: int = 40,
    risk: float = TRADE_RISK,
    capital: float = CAPITAL,
    block: int = BLOCK,
) -> Applied:
    """Every rule on every calibrated symbol.

    Without ``csl(symbol, csl)`` the coefficients are calibrated on the feature
    frame itself, whose bars are renumbered and whose ATR warms up again.
    """
    if csl is None:
        csl = stage(stop_coefficients(features, p, block), "csl")
    trades = stage(run_trades(features, rules, csl, max_bars=max_bars, risk=risk, block=block), "trades")
    metrics = performance(trades, capital, block)
    return Applied(csl, trades, metrics, results(signal_counts(features, rules), metrics, csl))


def out_of_sample(train: DataFrame, test: DataFrame, keep: float = 0.70) -> DataFrame:
    """(symbol, rule) pairs whose test profit factor holds up against training."""
    sides = [
        side.select(
            *KEYS,
            F.col("profit_factor").alias(f"profit_factor_{name}"),
            F.col("n_trades").alias(f"n_trades_{name}"),
            F.col("total_pnl").alias(f"total_pnl_{name}"),
        )
        for name, side in (("train", train), ("test", test))
    ]
    return sides[0].join(sides[1], KEYS).filter(
        F.col("profit_factor_test") >= F.col("profit_factor_train") * keep
    )


def rules_library(train: DataFrame, test: DataFrame, texts: DataFrame, keep: float = 0.70) -> DataFrame:
    """The pairs that hold up out of sample, with the rule's text and its measures on both sides, ready to be published.

    ``texts(rule_id, rule)`` comes from :func:`rule_texts`; a rule without a text keeps its numbers.
    """
    sides = [
        side.select(*KEYS, *[F.col(c).alias(f"{c}_{name}") for c in ("win_rate", "return_pct", "max_drawdown_pct")])
        for name, side in (("train", train), ("test", test))
    ]
    held = out_of_sample(train, test, keep).join(sides[0], KEYS).join(sides[1], KEYS)
    return held.join(texts, "rule_id", "left").select(*KEYS, "rule", *[c for c in held.columns if c not in KEYS])


def split_performance(
    trades: DataFrame, first_test_bar: DataFrame, capital: float = CAPITAL, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Metrics of the trades entered before and after ``first_test_bar(symbol, split_bar)``."""
    cut = trades.withColumn("blk", F.expr(f"entry_bar div {block}L"))
    known = cut.select("symbol", "blk").distinct().join(first_test_bar.select("symbol", "split_bar"), "symbol")
    cut = cut.join(stage(known, "splits"), ["symbol", "blk"]).drop("blk")
    early = cut.filter(F.col("exit_bar") < F.col("split_bar")).drop("split_bar")
    late = cut.filter(F.col("entry_bar") >= F.col("split_bar")).drop("split_bar")
    return performance(early, capital), performance(late, capital)
