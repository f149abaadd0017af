"""Checks that decide which symbols are worth reading further."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.rolling import rolling_mean
from barlab.operators.panel import BLOCK, blocked, own_rows
from barlab.schema import BAR_COLUMNS
from barlab.session import stage


def has_bar_columns(df: DataFrame) -> bool:
    return set(BAR_COLUMNS[2:6]) <= set(df.columns)


def check_bars(bars: DataFrame, min_rows: int = 100) -> DataFrame:
    """``symbol, n_bars, ok`` with ``ok`` = price columns exist and enough bars."""
    columns_ok = F.lit(has_bar_columns(bars))
    return (
        bars.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n_bars"))
        .withColumn("ok", columns_ok & (F.col("n_bars") >= min_rows))
    )


def keep_good(bars: DataFrame, min_rows: int = 100) -> DataFrame:
    """Bars of the symbols that pass :func:`check_bars`.

    A numbered panel knows its row counts already and needs no join.
    """
    if not has_bar_columns(bars):
        return bars.limit(0)
    if "n_bars" in bars.columns:
        return bars.filter(F.col("n_bars") >= min_rows)
    # Months split a long symbol; a join on the symbol alone would not.
    month = F.date_trunc("month", "ts")
    per_month = bars.groupBy("symbol", month.alias("_month")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("symbol"))
    good = stage(per_month.withColumn("_all", total).filter(F.col("_all") >= min_rows).select("symbol", "_month"), "good")
    dated = bars.withColumn("_month", month)
    same = dated["_month"].eqNullSafe(good["_month"]) & (dated["symbol"] == good["symbol"])
    return dated.join(good, same, "left_semi").drop("_month")


def liquid_bars(panel: DataFrame, window: int = 63, min_volume: float = 500_000.0, block: int = BLOCK) -> DataFrame:
    """Bars whose mean volume over ``window`` bars reaches ``min_volume``."""
    cut = blocked(panel, window - 1, 0, block).withColumn("avg_volume", rolling_mean("volume", window))
    return own_rows(cut, block).filter(F.col("avg_volume") >= min_volume)
