"""The feature frame: all indicators in one plan, gaps filled, warm-up dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.operators import indicators as ind
from barlab.operators.panel import BLOCK, fill_forward
from barlab.operators.recipes import FINAL, Recipe, with_indicators
from barlab.schema import BAR_COLUMNS

# Model inputs: everything numeric but these.
NOT_FEATURES = {
    "label", "tp_target", "entry_idx", "entry_bar", "symbol", "ts", "bar_no", "n_bars",
    "open", "high", "low", "close", "volume",
}


@dataclass(frozen=True)
class Periods:
    """The lengths of the indicators in the feature frame; columns are named by them."""

    rsi: int = 14
    atr: int = 50
    emas: tuple[int, ...] = (20, 50)
    vwap: int = 20
    macd: tuple[int, int, int] = (12, 26, 9)
    rvol: int = 20
    er: int = 10
    adx: int = 14
    momentum: int = 10
    volatility: int = 20
    sma: int = 10
    bollinger: int = 20
    width: float = 2.0


def feature_names(p: Periods = Periods()) -> list[str]:
    """The columns of the feature frame, in order; those of the default lengths are ``FEATURE_COLUMNS``."""
    return [
        f"RSI_{p.rsi}", f"ATR_{p.atr}", *[f"EMA_{n}" for n in p.emas], *[f"dist_ema{n}_pct" for n in p.emas], f"VWAP_{p.vwap}", "dist_vwap_pct",
        "MACD_line", "MACD_signal", "MACD_hist", f"RVOL_{p.rvol}", f"ER_Kaufman_{p.er}", "Gap_pct", f"ADX_{p.adx}", f"ROC_{p.momentum}",
        f"Momentum_{p.momentum}", f"Volatility_{p.volatility}", f"SMA_{p.sma}", "dist_bb_upper_pct", "dist_bb_lower_pct",
        "Candle_Body", "Candle_Range", "Upper_Wick", "Lower_Wick",
    ]


def feature_recipes(dense: bool = False, p: Periods = Periods()) -> list[Recipe]:
    """The features; ``dense`` promises that no price or volume is missing."""
    d = {"dense": dense}
    emas = {n: ind.ema("close", n, f"EMA_{n}", **d) for n in p.emas}
    vwap, moved = ind.vwap(p.vwap, f"VWAP_{p.vwap}", **d), ind.momentum(p.momentum, out=f"Momentum_{p.momentum}")
    roc = f"ROC_{p.momentum}"
    return [
        ind.rsi(p.rsi, out=f"RSI_{p.rsi}"),
        ind.atr(p.atr, out=f"ATR_{p.atr}", **d),
        *emas.values(),
        *[ind.distance_pct(r, f"EMA_{n}", f"dist_ema{n}_pct") for n, r in emas.items()],
        vwap,
        ind.distance_pct(vwap, f"VWAP_{p.vwap}", "dist_vwap_pct"),
        ind.macd(*p.macd, **d),
        ind.rvol(p.rvol, f"RVOL_{p.rvol}", **d),
        ind.efficiency_ratio(p.er, out=f"ER_Kaufman_{p.er}", **d),
        ind.gap(),
        ind.adx(p.adx, f"ADX_{p.adx}"),
        Recipe({FINAL: {roc: F.col(f"Momentum_{p.momentum}") * 100}}, [roc], 0, after=[moved]),
        moved,
        ind.volatility(p.volatility, out=f"Volatility_{p.volatility}"),
        ind.sma("close", p.sma, f"SMA_{p.sma}", **d),
        ind.bollinger(p.bollinger, p.width, **d),
        ind.candles(),
    ]


def raw_features(panel: DataFrame, block: int = BLOCK, dense: bool = False, p: Periods = Periods()) -> DataFrame:
    """All indicators, warm-up rows still null.

    ``dense`` is the caller's promise that no price or volume is missing, which saves some windows.
    """
    wide = with_indicators(panel, *feature_recipes(dense, p), block=block)
    return wide.select("symbol", "ts", "bar_no", "n_bars", *BAR_COLUMNS[2:], *feature_names(p))


def feature_frame(panel: DataFrame, block: int = BLOCK, dense: bool = False, p: Periods = Periods()) -> DataFrame:
    """The features per bar, forward-filled, complete rows only, renumbered."""
    columns = BAR_COLUMNS[2:] + feature_names(p)
    return fill_forward(raw_features(panel, block, dense, p), columns, block, trim=True, name="features")


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that may serve as model inputs, from the schema alone."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    return [f.name for f in df.schema if f.dataType.simpleString() in numeric and f.name not in NOT_FEATURES]


def with_atr_alias(features: DataFrame, p: Periods = Periods()) -> DataFrame:
    return features.withColumn("ATR", F.col(f"ATR_{p.atr}"))


def momentum_entries(
    panel: DataFrame, k: int = 10, threshold: float = 0.3, column: str = "close", digits: int = 8, block: int = BLOCK
) -> DataFrame:
    """Bars whose efficiency ratio is strictly above ``threshold``."""
    rich = with_indicators(panel, ind.efficiency_ratio(k, column, "ER"), block=block)
    return rich.filter(F.round("ER", digits) > threshold)
