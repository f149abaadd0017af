"""Batch calibration: every symbol of a universe gets exactly one result row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.operators.calibration import Calibration, buying_power_check, stop_coefficients, symbols_of, tradable_rows
from barlab.operators.panel import BLOCK, spread
from barlab.operators.quality import keep_good
from barlab.session import stage


def calibrate(
    panel: DataFrame, universe: DataFrame | None = None, p: Calibration = Calibration(), fewest_bars: int = 500,
    block: int = BLOCK,
) -> DataFrame:
    """``symbol, csl, bp_median, bp_max, n_samples, admitted, error``.

    ``universe`` lists the symbols to report (default: those of the panel). A
    symbol without bars, or with fewer than ``fewest_bars``, is ``insufficient_data``.
    """
    wanted = symbols_of(panel) if universe is None else universe
    wanted = stage(wanted.select("symbol").distinct(), "universe")
    good = keep_good(panel, fewest_bars)
    if universe is not None:
        sizes = wanted.join(symbols_of(panel), "symbol")
        blocks = stage(spread(sizes, block), "wanted")
        good = good.withColumn("blk", F.expr(f"bar_no div {block}L")).join(blocks, ["symbol", "blk"], "left_semi").drop("blk")
    rows = stage(tradable_rows(good, p, block), "tradable")
    csl = stop_coefficients(good, p, block, rows).select("symbol", "csl")
    power = buying_power_check(good, csl, p, block, rows)
    error = (
        F.when(~F.coalesce(F.col("_enough"), F.lit(False)), "insufficient_data")
        .when(F.col("csl").isNull(), "csl_rejected")
        .when(~F.col("admitted"), "bp_rejected")
    )
    return (
        wanted.join(csl.withColumn("_enough", F.lit(True)), "symbol", "left")
        .join(power, "symbol", "left")
        .withColumn("admitted", F.coalesce("admitted", F.lit(False)))
        .withColumn("error", error)
        .select("symbol", "csl", "bp_median", "bp_max", "n_samples", "admitted", "error")
    )


def admitted_universe(calibration: DataFrame) -> DataFrame:
    """Admitted symbols ordered by their coefficient."""
    return (
        calibration.filter("admitted")
        .select(F.col("symbol").alias("ticker"), "csl", "bp_median", "bp_max", "n_samples")
        .orderBy("csl", "ticker")
    )
