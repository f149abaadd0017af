"""First touch of two barriers within a long horizon: labels, durations and exits.

The bars of a block, and the ``max_bars`` after it, lie side by side in one task. Lows and highs are summarised over spans
of 1, 2, 4, ... bars; an entry then steps over the longest span that does not touch, half of it, and so on, so it costs
twice the logarithm of the horizon and no row holds a list of later bars. All entries of a block step together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.scalars import position_size, stop_price, target_price, valid_atr
from barlab.operators.panel import BLOCK, blocked, lag, own_rows
from barlab.operators.touch import attach_csl, barrier_label
from barlab.params import ENTRY_PRICES, TIE_DIGITS, TRADE_RISK


def first_touches(
    panel: DataFrame, stop: Column, target: Column, max_bars: int, keep: Sequence[str] = (), at_exit: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """``symbol, bar_no, n_bars, to_stop, to_target, lowest, highest`` of every bar, ``keep``, and ``exit_<c>`` for ``at_exit``.

    ``to_stop`` (``to_target``) counts the bars to the first one within ``max_bars`` whose low (high) is at or beyond the level; null
    if there is none, or no level. The exit is the earlier of the two, else the bar ``max_bars`` on, else missing.
    ``lowest`` and ``highest`` are the extremes up to the exit, or of the next bar if there is none. A bar without a low or
    high touches nothing. ``bar_no`` has no holes.
    """
    own_columns = ["symbol", "bar_no", "n_bars", *keep]
    inputs = dict.fromkeys([*own_columns, "low", "high", *at_exit])
    frame = panel.withColumns({"_stop": stop.cast("double"), "_target": target.cast("double")}).select(*inputs, "_stop", "_target")
    kinds = dict(frame.dtypes)
    made = ["to_stop int", "to_target int", "lowest double", "highest double"]
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in own_columns] + made + [f"`exit_{c}` {kinds[c]}" for c in at_exit])
    names = [*own_columns, *[m.split()[0] for m in made], *[f"exit_{c}" for c in at_exit]]

    def spans(values: np.ndarray) -> list[np.ndarray]:
        """Minima over the 1, 2, 4, ... bars from each bar on, as far as the bars go."""
        levels, width = [values], 1
        while 2 * width <= min(max_bars, len(values)):
            levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
            width *= 2
        return levels

    def first(levels: list[np.ndarray], start: np.ndarray, end: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The first place in ``[start, end)`` with a value at or under ``level``, else ``end``."""
        at = start.copy()
        for k in reversed(range(len(levels))):
            free = at + (1 << k) <= end
            free[free] = levels[k][at[free]] > level[free]
            at[free] += 1 << k
        return at

    def least(levels: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum over ``[start, end)``, infinite if empty: two spans that may overlap cover it."""
        out = np.full(len(start), np.inf)
        some = np.flatnonzero(end > start)
        k = np.frexp((end - start)[some])[1] - 1
        for j in np.unique(k):
            at = some[k == j]
            out[at] = np.minimum(levels[j][start[at]], levels[j][end[at] - (1 << j)])
        return out

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("bar_no")
        bars = rows.column("bar_no").to_numpy()
        own = np.flatnonzero(bars // block == key[1].as_py())
        low, high, stops, targets = (rows.column(c).to_numpy().astype(float) for c in ("low", "high", "_stop", "_target"))
        lows = spans(np.where(np.isnan(low), np.inf, low))
        highs = spans(np.where(np.isnan(high), np.inf, -high))
        start, end = own + 1, np.minimum(own + 1 + max_bars, len(bars))
        found, none = [], []
        for levels, level in ((lows, stops), (highs, -targets)):
            level = np.where(np.isnan(level), -np.inf, level)[own]
            found.append(first(levels, start, end, level))
            none.append((found[-1] >= end) | np.isneginf(level))
        leave = np.minimum(*[np.where(no, own + max_bars, at) for at, no in zip(found, none)])
        open_ = leave >= len(bars)
        until = np.minimum(np.where(open_, own + 2, leave + 1), len(bars))
        extremes = least(lows, start, until), -least(highs, start, until)
        leave = pa.array(leave, mask=open_)
        columns = [
            *(rows.column(c).take(pa.array(own)) for c in own_columns),
            *(pa.array((at - own).astype(np.int32), mask=no) for at, no in zip(found, none)),
            *(pa.array(x, mask=~np.isfinite(x)) for x in extremes),
            *(rows.column(c).take(leave) for c in at_exit),
        ]
        return pa.Table.from_arrays(columns, names=names)

    cut = blocked(frame, 0, max_bars, block).drop("sub")
    return cut.groupBy("symbol", "blk").applyInArrow(run, schema)


def durations_long(panel: DataFrame, stop: Column, target: Column, max_bars: int, block: int = BLOCK) -> DataFrame:
    """``symbol, bar_no, duration`` as :func:`trade_durations`, for horizons of any length."""
    met = F.coalesce(F.least("to_stop", "to_target"), F.lit(max_bars))
    last = F.col("bar_no") == F.col("n_bars") - 1
    found = first_touches(panel, stop, target, max_bars, block=block)
    return found.select("symbol", "bar_no", F.when(last, 0).otherwise(met).cast("int").alias("duration"))


def label_bars_long(
    features: DataFrame, csl: DataFrame | float, max_bars: int, ratio: float = 1.5, atr: str = "ATR_50",
    signal: Column | None = None, binary: bool = True, prices: tuple[float, float] = ENTRY_PRICES, block: int = BLOCK,
) -> DataFrame:
    """``symbol, bar_no, label, entry_bar`` as :func:`label_bars`, for horizons of any length."""
    asked = F.lit(True) if signal is None else F.coalesce(signal, F.lit(False))
    cut = attach_csl(blocked(features.withColumn("_asked", asked), block=block), csl, features, block)
    close, risk = F.col("close"), F.round(atr, TIE_DIGITS)
    fits = (
        F.col("_asked") & (F.col("bar_no") <= F.col("n_bars") - max_bars - 2) & valid_atr(F.col(atr)) & close.between(*prices)
    )
    # Every bar is looked at by others; one that does not qualify has no barriers of its own.
    rows = own_rows(cut.withColumn("_fits", F.coalesce(fits, F.lit(False))), block)
    stop = F.when(F.col("_fits"), stop_price(close, risk, F.col("csl")))
    target = F.when(F.col("_fits"), target_price(close, risk, F.col("csl"), F.col("csl") * ratio))
    found = first_touches(rows, stop, target, max_bars, ["_fits"], block=block).filter("_fits")
    label = barrier_label(F.col("to_stop"), F.col("to_target"))
    return found.select(
        "symbol", "bar_no", ((label == 1).cast("int") if binary else label).alias("label"), F.col("bar_no").alias("entry_bar")
    )


def entry_exits_long(
    features: DataFrame, signals: Column, csl: DataFrame | float, max_bars: int, c_tp: float | None = None, atr: str = "ATR_50",
    risk: float = TRADE_RISK, block: int = BLOCK,
) -> DataFrame:
    """The rows of :func:`entry_exits`, for horizons of any length."""
    slim = features.select(
        "symbol", "ts", "bar_no", "n_bars", "open", "high", "low", "close", F.round(atr, TIE_DIGITS).alias("_atr"), signals.alias("_signals"),
    )
    cut = attach_csl(blocked(slim, 1, 0, block), csl, features, block)
    rows = own_rows(cut.withColumns({"rules": lag("_signals"), "_entry_atr": lag("_atr")}), block)
    atr_in, c_sl, entry = F.col("_entry_atr"), F.col("csl"), F.col("open")
    rows = rows.withColumns({
        "size": position_size(atr_in, c_sl, risk),
        "stop": stop_price(entry, atr_in, c_sl),
        "target": target_price(entry, atr_in, c_sl, None if c_tp is None else F.lit(float(c_tp))),
    })
    keep = ["ts", "open", "rules", "_entry_atr", "size", "stop", "target"]
    entered = (F.size("rules") > 0) & valid_atr(atr_in) & (F.col("size") > 0)
    # Barriers only where a trade begins; other bars are there to be looked at.
    level = {c: F.when(entered, F.col(c)) for c in ("stop", "target")}
    found = first_touches(rows, level["stop"], level["target"], max_bars, keep, ["ts", "close"], block).filter(entered)
    by_stop = F.coalesce(F.col("to_stop") <= F.coalesce("to_target", "to_stop"), F.lit(False))
    in_time = F.col("bar_no") + max_bars < F.col("n_bars")
    held = F.coalesce(F.least("to_stop", "to_target"), F.when(in_time, F.lit(max_bars))).cast("int")
    by_target = F.col("to_target").isNotNull()
    price_out = F.when(by_stop, F.col("stop")).when(by_target, F.col("target")).otherwise(F.col("exit_close"))
    return found.withColumns({"bars_held": held, "price_out": price_out}).select(
        "symbol", F.col("bar_no").alias("entry_bar"), (F.col("bar_no") + F.col("bars_held")).alias("exit_bar"),
        F.col("ts").alias("entry_ts"), F.col("exit_ts"), entry.alias("price_in"), "price_out",
        ((F.col("price_out") - entry) * F.col("size")).alias("pnl"),
        F.when(by_stop, "SL").when(by_target, "TP").when(in_time, "Time Exit").alias("reason"),
        (entry - F.least(entry, F.col("lowest"))).alias("mae"), (F.greatest(entry, F.col("highest")) - entry).alias("mfe"),
        "bars_held", "size", "stop", "target", "rules",
    )
