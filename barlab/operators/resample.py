"""Bars of a longer interval from ticks or shorter bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.session import stage

DAY = 86_400


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zoneless timestamp, rounded down."""
    zero = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.floor(F.timestamp_diff("MICROSECOND", zero, ts) / 1_000_000)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def resample_bars(bars: DataFrame, seconds: int) -> DataFrame:
    """First open, highest high, lowest low, last close, summed volume per bin.

    Bins start at midnight of the symbol's first day. Lengths that divide a day give
    the same bins from 1970 on, so only other lengths need that first day. Bins with
    a missing price are dropped.
    """
    origin = F.lit(0)
    if DAY % seconds:
        # One row per symbol and month: months split a long symbol in the join.
        bars = bars.withColumn("_month", F.date_trunc("month", "ts"))
        months = bars.groupBy("symbol", "_month").agg(F.min("ts").alias("_first"))
        first = stage(months.withColumn("_first", F.min("_first").over(Window.partitionBy("symbol"))), "origin")
        bars = bars.join(first, ["symbol", "_month"])
        origin = epoch_seconds(F.date_trunc("day", "_first").cast("timestamp_ntz"))
    at = epoch_seconds(F.col("ts"))
    start = origin + F.floor((at - origin) / seconds) * seconds
    return _binned(bars.withColumn("_bin", from_epoch_seconds(start.cast("long"))))


def resample_calendar(bars: DataFrame, unit: str) -> DataFrame:
    """Bars per calendar ``unit`` (week, month, quarter or year), dated by its last day.

    Weeks end on Sunday. Bins with a missing price are dropped.
    """
    if unit not in ("week", "month", "quarter", "year"):
        raise ValueError("unit is week, month, quarter or year")
    start = F.date_trunc(unit, "ts").cast("timestamp_ntz")
    after = {"week": "INTERVAL 6 DAYS", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTHS", "year": "INTERVAL 1 YEAR"}
    last = start + F.expr(after[unit])
    return _binned(bars.withColumn("_bin", last if unit == "week" else last - F.expr("INTERVAL 1 DAY")))


def _binned(bars: DataFrame) -> DataFrame:
    def present(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col("ts"))

    return (
        bars.groupBy("symbol", "_bin")
        .agg(
            F.min_by("open", present("open")).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", present("close")).alias("close"),
            F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"),
        )
        .select("symbol", F.col("_bin").alias("ts"), "open", "high", "low", "close", "volume")
        .na.drop()
    )


def ticks_as_bars(ticks: DataFrame) -> DataFrame:
    """Ticks ``(symbol, ts, price, volume)`` as one-price bars, ready to resample."""
    return ticks.select(
        "symbol", "ts", *[F.col("price").alias(c) for c in ["open", "high", "low", "close"]], "volume"
    )
