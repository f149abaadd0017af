"""Bars from a stream of ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bars(ticks: DataFrame, every: str, late: str) -> DataFrame:
    """Tumbling bars of a tick stream ``(symbol, ts, price, volume)``.

    ``ts`` is a TIMESTAMP. A bar is emitted once the watermark, ``late`` behind the
    newest tick, has passed its end; ticks behind the watermark are dropped and show
    up in the query's ``numRowsDroppedByWatermark``. Of ticks with one time stamp the lowest price opens and
    the highest closes. Bars start at multiples of ``every`` since 1970; ``resample_bars`` does the same
    for lengths that divide a day.
    """
    return (
        ticks.withWatermark("ts", late)
        .groupBy("symbol", F.window("ts", every).alias("w"))
        .agg(
            F.min_by("price", F.struct("ts", "price")).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", F.struct("ts", "price")).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")
    )


def late_ticks(ticks: DataFrame, every: str, late: str, parts: int = 16) -> DataFrame:
    """``symbol, n_late, total, newest``: ticks that come after their bar was closed, which :func:`stream_bars` drops.

    A stateful operator per symbol and part (a hash of the time stamp, so that a busy symbol is several keys) compares each tick's
    bar with the watermark of its batch and emits a row whenever a batch brings late ticks: their number, the part's total so far,
    and the newest of them. Sum ``n_late`` for the number per symbol.
    """
    schema = "symbol string, n_late long, total long, newest timestamp"

    def count(key, frames, state):
        import pandas as pd

        closed = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        found, newest = 0, None
        for frame in frames:
            behind = frame[frame["end"] <= closed]
            if len(behind):
                found += len(behind)
                top = behind["ts"].max()
                newest = top if newest is None else max(newest, top)
        total = (state.get[0] if state.exists else 0) + found
        state.update((total,))
        if found:
            yield pd.DataFrame({"symbol": [key[0]], "n_late": [found], "total": [total], "newest": [newest]})

    keyed = ticks.withWatermark("ts", late).select(
        "symbol", "ts", F.window("ts", every)["end"].alias("end"), F.pmod(F.xxhash64("ts"), F.lit(parts)).alias("part")
    )
    return keyed.groupBy("symbol", "part").applyInPandasWithState(count, schema, "total long", "append", "NoTimeout")
