"""Trades: the exit of every possible entry, then the entries that do not overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.scalars import position_size, stop_price, target_price, valid_atr
from barlab.operators import intervals
from barlab.operators.panel import BLOCK, ahead, bar_window, block_columns, blocked, lag, own_rows
from barlab.operators.rules import Rule, matched_rules
from barlab.operators.touch import attach_csl, first_high_at, first_low_at, future_lists
from barlab.params import TIE_DIGITS, TRADE_RISK
from barlab.session import stage

TRADE_COLUMNS = [
    "symbol", "rule_id", "entry_bar", "exit_bar", "entry_ts", "exit_ts", "price_in", "price_out", "pnl",
    "reason", "mae", "mfe", "bars_held", "size", "stop", "target",
]


def entry_exits(
    features: DataFrame,
    signals: Column,
    csl: DataFrame | float,
    c_tp: float | None = None,
    max_bars: int = 40,
    atr: str = "ATR_50",
    risk: float = TRADE_RISK,
    block: int = BLOCK,
) -> DataFrame:
    """One row per bar entered after a signal, with its exit; rules share the row.

    ``signals`` is an array of rule ids per bar. A signal at bar e-1 enters at the
    open of bar e with the ATR of e-1; the entry bar itself is not checked. The stop
    beats the target beats the time exit. An entry without a valid ATR or size is
    left out; ``exit_bar`` is null if the data end before the exit.
    """
    slim = features.select(
        "symbol", "ts", "bar_no", "n_bars", "open", "high", "low", "close",
        F.round(atr, TIE_DIGITS).alias("_atr"), signals.alias("_signals"), *block_columns(features),
    )
    cut = attach_csl(blocked(slim, 1, max_bars, block), csl, features, block)
    cut = cut.withColumns({"_rules": lag("_signals"), "_entry_atr": lag("_atr")})
    atr_in, c_sl = F.col("_entry_atr"), F.col("csl")
    # Size and barriers are made between the two windows, once per row.
    cut = cut.withColumns({
        "size": position_size(atr_in, c_sl, risk),
        "stop": stop_price(F.col("open"), atr_in, c_sl),
        "target": target_price(F.col("open"), atr_in, c_sl, None if c_tp is None else F.lit(float(c_tp))),
    })
    ahead_columns = {
        **future_lists(max_bars),
        "_times": F.collect_list("ts").over(ahead(1, max_bars)),
        "_last_close": F.lead("close", max_bars).over(bar_window()),
    }
    rows = own_rows(cut.withColumns(ahead_columns), block).filter(
        (F.size("_rules") > 0) & valid_atr(atr_in) & (F.col("size") > 0)
    )
    rows = rows.withColumns({"_to_stop": first_low_at(F.col("stop")), "_to_target": first_high_at(F.col("target"))})
    to_stop, to_target = F.col("_to_stop"), F.col("_to_target")
    by_stop = F.coalesce(to_stop <= F.coalesce(to_target, to_stop), F.lit(False))
    in_time = F.col("bar_no") + max_bars < F.col("n_bars")
    held = F.coalesce(F.least(to_stop, to_target), F.when(in_time, F.lit(max_bars))).cast("int")
    rows = rows.withColumns({
        "bars_held": held,
        "reason": F.when(by_stop, "SL").when(to_target.isNotNull(), "TP").when(in_time, "Time Exit"),
        "price_out": F.when(by_stop, F.col("stop"))
        .when(to_target.isNotNull(), F.col("target"))
        .otherwise(F.col("_last_close")),
    })
    entry = F.col("open")
    span = F.coalesce("bars_held", F.lit(1))
    worst = F.least(entry, F.array_min(F.slice("_lows", 1, span)))
    best = F.greatest(entry, F.array_max(F.slice("_highs", 1, span)))
    return rows.select(
        "symbol",
        F.col("bar_no").alias("entry_bar"),
        (F.col("bar_no") + F.col("bars_held")).alias("exit_bar"),
        F.col("ts").alias("entry_ts"),
        F.get("_times", F.col("bars_held") - 1).alias("exit_ts"),
        entry.alias("price_in"),
        "price_out",
        ((F.col("price_out") - entry) * F.col("size")).alias("pnl"),
        "reason",
        (entry - worst).alias("mae"),
        (best - entry).alias("mfe"),
        "bars_held",
        "size",
        "stop",
        "target",
        F.col("_rules").alias("rules"),
    )


def non_overlapping(exits: DataFrame, max_bars: int, block: int = intervals.BLOCK, group: int = intervals.GROUP) -> DataFrame:
    """Trades per (symbol, rule): entries taken while no trade is open.

    The choice sees four columns per candidate; what else an exit holds is joined to the trades taken. Stage ``exits``: it is read
    twice.
    """
    candidates = exits.select("symbol", F.explode("rules").alias("rule_id"), "entry_bar", "exit_bar")
    taken = intervals.select_intervals(
        candidates, ["symbol", "rule_id"], "entry_bar", "exit_bar", max_bars, block, group
    )
    return taken.select("symbol", "rule_id", "entry_bar").join(exits.drop("rules"), ["symbol", "entry_bar"]).select(*TRADE_COLUMNS)


def run_trades(
    features: DataFrame,
    rules: Sequence[Rule],
    csl: DataFrame | float,
    c_tp: float | None = None,
    max_bars: int = 40,
    risk: float = TRADE_RISK,
    block: int = BLOCK,
) -> DataFrame:
    """All trades of all rules on all symbols."""
    exits = entry_exits(features, matched_rules(rules), csl, c_tp, max_bars, risk=risk, block=block)
    return non_overlapping(stage(exits, "exits"), max_bars)


def run_signal(
    features: DataFrame, signal: Column, csl: DataFrame | float, c_tp: float | None = None,
    max_bars: int = 40, risk: float = TRADE_RISK, block: int = BLOCK,
) -> DataFrame:
    """Trades of a single entry signal (rule 0)."""
    one = F.when(F.coalesce(signal, F.lit(False)), F.array(F.lit(0))).otherwise(F.expr("cast(array() as array<int>)"))
    exits = entry_exits(features, one, csl, c_tp, max_bars, risk=risk, block=block)
    return non_overlapping(stage(exits, "exits"), max_bars)
