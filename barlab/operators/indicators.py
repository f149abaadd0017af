"""The indicators. Each function returns a :class:`Recipe` over panel columns.

``dense=True`` promises that the panel's prices and volumes have no nulls, which
saves the count of present values beside each rolling aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from barlab.functions.rolling import rolling_mean, rolling_std, rolling_sum
from barlab.functions.scalars import candle_columns, ratio
from barlab.operators.panel import ahead, lag
from barlab.operators.recipes import FINAL, LAGS, LATER, ROLLS, ROWS, SECOND, VALUES, Recipe
from barlab.operators.scan import ema as ema
from barlab.operators.scan import ema_of_most

# A frozen price keeps the ratio of the directional sums constant while both
# decay, so they are followed much further back than other averages.
DIRECTIONAL_RESIDUAL = 1e-60
TRADING_DAYS = 252


def _from(dense: bool, bar: int) -> int | None:
    """First bar with a value, for a column that is complete from there on."""
    return bar if dense else None


def change(column: str, k: int, out: str) -> Recipe:
    """Relative change over ``k`` bars; missing values are not padded."""
    return Recipe({LAGS: {out: ratio(F.col(column), lag(column, k)) - 1}}, [out], k)


def _true_range() -> Recipe:
    previous = F.col("_prev_close")
    tr = F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - previous), F.abs(F.col("low") - previous)
    )
    return Recipe({LAGS: {"_prev_close": lag("close")}, ROWS: {"_tr": tr}}, [], 1)


def atr(period: int = 14, out: str = "ATR", digits: int | None = None, dense: bool = False) -> Recipe:
    """Simple mean of the true range; ``digits`` rounds it (see params.TIE_DIGITS)."""
    mean = rolling_mean("_tr", period, _from(dense, 0))
    value = mean if digits is None else F.round(mean, digits)
    return Recipe({ROLLS: {out: value}}, [out], period - 1, after=[_true_range()])


def sma(column: str, period: int, out: str, dense: bool = False) -> Recipe:
    return Recipe({LAGS: {out: rolling_mean(column, period, _from(dense, 0))}}, [out], period - 1)


def rsi(period: int = 14, column: str = "close", out: str = "RSI") -> Recipe:
    """Simple-mean RSI; 100 without losses, null without any move."""
    move, up, down = f"_{column}_move", f"_{column}_up", f"_{column}_down"
    gain, loss = f"_{out}_gain", f"_{out}_loss"
    flat = F.col(loss) == 0
    value = (
        F.when(flat & (F.col(gain) > 0), 100.0)
        .when(flat, None)
        .otherwise(100 - 100 / (1 + ratio(F.col(gain), F.col(loss))))
    )
    return Recipe(
        {
            LAGS: {move: F.col(column) - lag(column)},
            # A missing move counts as neither gain nor loss.
            ROWS: {
                up: F.when(F.col(move) > 0, F.col(move)).otherwise(0.0),
                down: F.when(F.col(move) < 0, -F.col(move)).otherwise(0.0),
            },
            ROLLS: {gain: rolling_mean(up, period, 0), loss: rolling_mean(down, period, 0)},
            VALUES: {out: value},
        },
        [out],
        period,
    )


def macd(
    fast: int = 12, slow: int = 26, signal: int = 9, column: str = "close", prefix: str = "MACD", dense: bool = False
) -> Recipe:
    """Line (fast - slow EMA), its signal EMA, and their difference."""
    line, sig, hist = f"{prefix}_line", f"{prefix}_signal", f"{prefix}_hist"
    quick = ema(column, fast, f"_{prefix}_fast", dense=dense)
    slower = ema(column, slow, f"_{prefix}_slow", dense=dense)
    line_recipe = Recipe(
        {LATER: {line: F.col(f"_{prefix}_fast") - F.col(f"_{prefix}_slow")}}, [line], 0, after=[quick, slower]
    )
    sig_recipe = ema(line, signal, sig, after=[line_recipe], dense=dense, first_stage=SECOND)
    return Recipe({FINAL: {hist: F.col(line) - F.col(sig)}}, [line, sig, hist], 0, after=[sig_recipe])


def vwap(window: int = 20, out: str = "VWAP", dense: bool = False) -> Recipe:
    """Rolling volume-weighted typical price, no daily reset."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    full = _from(dense, 0)
    value = ratio(rolling_sum("_tp_vol", window, full), rolling_sum("volume", window, full))
    return Recipe({ROWS: {"_tp_vol": typical * F.col("volume")}, ROLLS: {out: value}}, [out], window - 1)


def adx(period: int = 14, out: str = "ADX") -> Recipe:
    """Directional index on EMA-smoothed moves, without ATR scaling."""
    up, down = F.col("high") - F.col("_prev_high"), F.col("_prev_low") - F.col("low")
    moves = Recipe(
        {
            LAGS: {"_prev_high": lag("high"), "_prev_low": lag("low")},
            ROWS: {
                "_dm_up": F.when((up > down) & (up > 0), up).otherwise(0.0),
                "_dm_down": F.when((down > up) & (down > 0), down).otherwise(0.0),
            },
        },
        [],
        1,
    )
    plus, minus, dx, smooth = f"_{out}_plus", f"_{out}_minus", f"_{out}_dx", f"_{out}_smooth"
    followed = {"after": [moves], "dense": True, "residual": DIRECTIONAL_RESIDUAL}
    sides = [ema("_dm_up", period, plus, **followed), ema("_dm_down", period, minus, **followed)]
    index = Recipe(
        {LATER: {dx: ratio(F.abs(F.col(plus) - F.col(minus)), F.col(plus) + F.col(minus))}}, [], 0, after=sides
    )
    average = ema_of_most(dx, period, smooth, after=[index], first_stage=SECOND)
    return Recipe({FINAL: {out: F.col(smooth) * 100}}, [out], 0, after=[average])


def momentum(period: int = 10, column: str = "close", out: str = "Momentum") -> Recipe:
    return change(column, period, out)


def volatility(period: int = 20, column: str = "close", out: str = "Volatility") -> Recipe:
    """Rolling std of one-bar returns, scaled by sqrt(252) on any bar size."""
    returns = f"_{column}_return"
    value = rolling_std(returns, period) * math.sqrt(TRADING_DAYS)
    return Recipe(
        {LAGS: {returns: ratio(F.col(column), lag(column)) - 1}, ROLLS: {out: value}}, [out], period
    )


def gap(out: str = "Gap_pct") -> Recipe:
    previous = F.col("_prev_close")
    return Recipe(
        {LAGS: {"_prev_close": lag("close")}, ROWS: {out: ratio(F.col("open") - previous, previous)}}, [out], 1
    )


def rvol(period: int = 20, out: str = "RVOL", dense: bool = False) -> Recipe:
    mean = rolling_mean("volume", period, _from(dense, 0))
    return Recipe({LAGS: {out: ratio(F.col("volume"), mean)}}, [out], period - 1)


def efficiency_ratio(k: int = 10, column: str = "close", out: str = "ER", dense: bool = False) -> Recipe:
    """Net change over path length, signed."""
    step, net = f"_{column}_step", f"_{column}_net{k}"
    return Recipe(
        {
            LAGS: {step: F.abs(F.col(column) - lag(column)), net: F.col(column) - lag(column, k)},
            ROLLS: {out: ratio(F.col(net), rolling_sum(step, k, _from(dense, 1)))},
        },
        [out],
        k,
    )


def bollinger(
    period: int = 20, width: float = 2.0, column: str = "close", prefix: str = "dist_bb", dense: bool = False
) -> Recipe:
    """Distance to the upper and lower band, in percent of the middle."""
    mid, std = f"_{prefix}_mid", f"_{prefix}_std"
    price, full = F.col(column), _from(dense, 0)

    def distance(sign: int):
        return ratio(price - (F.col(mid) + sign * width * F.col(std)), F.col(mid)) * 100

    return Recipe(
        {
            LAGS: {mid: rolling_mean(column, period, full), std: rolling_std(column, period, full)},
            ROWS: {f"{prefix}_upper_pct": distance(1), f"{prefix}_lower_pct": distance(-1)},
        },
        [f"{prefix}_upper_pct", f"{prefix}_lower_pct"],
        period - 1,
    )


def distance_pct(of: Recipe, level: str, out: str, column: str = "close") -> Recipe:
    """Distance of a price to an indicator, in percent of the indicator."""
    value = ratio(F.col(column) - F.col(level), F.col(level)) * 100
    return Recipe({FINAL: {out: value}}, [out], 0, after=[of])


def candles() -> Recipe:
    columns = candle_columns()
    return Recipe({FINAL: columns}, list(columns), 0)


def forward_low(bars: int, out: str) -> Recipe:
    """Lowest low of the next ``bars`` bars."""
    return Recipe({LAGS: {out: F.min("low").over(ahead(1, bars))}}, [out], 0, lookahead=bars)
