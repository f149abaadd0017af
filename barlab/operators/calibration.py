"""Stop coefficient per symbol, buying-power check, and their status table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.scalars import valid_atr
from barlab.operators import indicators as ind
from barlab.operators.panel import BLOCK
from barlab.operators.recipes import with_indicators
from barlab.operators.sampling import hash_sample
from barlab.params import ENTRY_PRICES, TIE_DIGITS, TRADE_RISK
from barlab.session import stage


@dataclass(frozen=True)
class Calibration:
    """How stop coefficients are found and accepted, and what buying power is accepted."""

    horizon: int = 20
    prices: tuple[float, float] = ENTRY_PRICES
    atr_bars: int = 50
    momentum_bars: int = 10
    momentum_above: float = 0.3
    drops: int = 500
    drop_seed: int = 42
    fewest_drops: int = 30
    accepted: tuple[float, float] = (1.5, 3.0)
    entries: int = 500
    entry_seed: int = 7
    risk: float = TRADE_RISK
    median_power: tuple[float, float] = (100.0, 1800.0)
    most_power: float = 3000.0


def symbols_of(panel: DataFrame) -> DataFrame:
    """One row per symbol with its number of bars."""
    return panel.groupBy("symbol").agg(F.max("n_bars").alias("n_bars"))


def tradable(panel: DataFrame, p: Calibration) -> Column:
    """Past the ATR warm-up, enough bars ahead, price in the band (inclusive)."""
    return (
        (F.col("bar_no") >= p.atr_bars)
        & (F.col("bar_no") <= F.col("n_bars") - p.horizon - 1)
        & F.col("close").between(*p.prices)
    )


def tradable_rows(panel: DataFrame, p: Calibration = Calibration(), block: int = BLOCK) -> DataFrame:
    """``symbol, bar_no, close, atr, coef, momentum`` of the tradable bars, from one pass of windows.

    ``coef`` is the drop over the next bars in ATR units, null without a valid ATR; ``momentum`` marks momentum entries.
    """
    rich = with_indicators(
        panel.select("symbol", "bar_no", "n_bars", "high", "low", "close"),
        ind.atr(p.atr_bars, "atr", TIE_DIGITS),
        ind.efficiency_ratio(p.momentum_bars, out="_er"),
        ind.forward_low(p.horizon, "_low_ahead"),
        block=block,
    )
    drop = F.try_divide(F.col("close") - F.col("_low_ahead"), F.col("atr"))
    return rich.filter(tradable(panel, p)).select(
        "symbol", "bar_no", "close", "atr", F.when(valid_atr(F.col("atr")), drop).alias("coef"),
        F.coalesce(F.round("_er", TIE_DIGITS) > p.momentum_above, F.lit(False)).alias("momentum"),
    )


def drop_candidates(panel: DataFrame, p: Calibration = Calibration(), block: int = BLOCK) -> DataFrame:
    """Momentum entries with ``coef`` = drop over the next bars in ATR units."""
    return tradable_rows(panel, p, block).filter("momentum").select("symbol", "bar_no", "coef")


def stop_coefficients(
    panel: DataFrame, p: Calibration = Calibration(), block: int = BLOCK, rows: DataFrame | None = None
) -> DataFrame:
    """``symbol, n_candidates, n_kept, csl_median, csl``; ``csl`` null if not admitted.

    The median is taken over at most ``drops`` rows per symbol. ``rows`` are the panel's staged :func:`tradable_rows`, if
    there are any.
    """
    if rows is None:
        # Few and narrow rows, read three times: the windows run once.
        candidates = stage(drop_candidates(panel, p, block), "candidates")
    else:
        candidates = rows.filter("momentum").select("symbol", "bar_no", "coef")
    counts = candidates.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_candidates"))
    sample = hash_sample(candidates, p.drops, p.drop_seed).filter(F.col("coef") > 0)
    medians = sample.groupBy("symbol").agg(
        F.count("coef").alias("n_kept"), F.median("coef").alias("csl_median")
    )
    least, (low, high) = p.fewest_drops, p.accepted
    enough = (F.col("n_candidates") >= least) & (F.col("n_kept") >= least)
    return (
        symbols_of(panel).select("symbol")
        .join(counts, "symbol", "left")
        .join(medians, "symbol", "left")
        .na.fill(0, ["n_candidates", "n_kept"])
        .withColumn("csl_median", F.when(enough, F.col("csl_median")))
        .withColumn("csl", F.when(F.col("csl_median").between(low, high), F.col("csl_median")))
    )


def buying_power_check(
    panel: DataFrame, csl: DataFrame, p: Calibration = Calibration(), block: int = BLOCK, rows: DataFrame | None = None
) -> DataFrame:
    """``symbol, bp_median, bp_max, n_samples, admitted`` for symbols with a ``csl``.

    An independent sample without the momentum filter; sizes are fractional here. ``rows`` as in :func:`stop_coefficients`.
    """
    if rows is None:
        rich = with_indicators(
            panel.select("symbol", "bar_no", "n_bars", "high", "low", "close"), ind.atr(p.atr_bars, "atr", TIE_DIGITS), block=block
        )
        rows = rich.filter(tradable(panel, p))
    entries = rows.select("symbol", "bar_no", "close", F.col("atr").alias("_atr"))
    sample = hash_sample(entries, p.entries, p.entry_seed).filter(valid_atr(F.col("_atr")))
    known = csl.filter(F.col("csl").isNotNull()).select("symbol", "csl")
    size = F.try_divide(F.lit(p.risk), F.col("csl") * F.col("_atr"))
    spread = sample.join(known, "symbol").groupBy("symbol").agg(
        F.median(F.col("close") * size).alias("bp_median"),
        F.max(F.col("close") * size).alias("bp_max"),
        F.count(size).alias("n_samples"),
    )
    low, high = p.median_power
    ok = F.col("bp_median").between(low, high) & (F.col("bp_max") <= p.most_power)
    return (
        known.select("symbol")
        .join(spread, "symbol", "left")
        .na.fill(0, ["n_samples"])
        .withColumn("admitted", F.coalesce(ok, F.lit(False)))
    )
