"""Which barrier is touched first, within a bounded number of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.scalars import stop_price, target_price, valid_atr
from barlab.operators.panel import BLOCK, ahead, block_columns, blocked, own_rows, spread
from barlab.params import ENTRY_PRICES, TIE_DIGITS

INF = float("inf")


def future_lists(bars: int) -> dict[str, Column]:
    """Lows and highs of the next ``bars`` bars; a missing one touches nothing."""
    frame = ahead(1, bars)
    return {
        "_lows": F.collect_list(F.coalesce("low", F.lit(INF))).over(frame),
        "_highs": F.collect_list(F.coalesce("high", F.lit(-INF))).over(frame),
    }


def first_low_at(level: Column) -> Column:
    """1-based bar of the first low at or under ``level``; null if none."""
    return F.nullif(F.array_position(F.transform("_lows", lambda x: x <= level), True), F.lit(0))


def first_high_at(level: Column) -> Column:
    return F.nullif(F.array_position(F.transform("_highs", lambda x: x >= level), True), F.lit(0))


def barrier_label(to_stop: Column, to_target: Column) -> Column:
    """0 stop first (also when both fall on one bar), 1 target first, 2 neither."""
    return F.when(to_stop <= F.coalesce(to_target, to_stop), 0).when(to_target.isNotNull(), 1).otherwise(2)


def attach_csl(cut: DataFrame, csl: DataFrame | float, source: DataFrame, block: int) -> DataFrame:
    """Add ``csl`` to a blocked frame: one number, or one row per symbol.

    Rows per symbol are copied to the blocks of the symbol (whose sizes come from
    ``source``), so the join keeps the partitioning of the windows that follow.
    """
    if not isinstance(csl, DataFrame):
        return cut.withColumn("csl", F.lit(float(csl)))
    sizes = source.groupBy("symbol").agg(F.max("n_bars").alias("n_bars"))
    known = csl.filter(F.col("csl").isNotNull()).select("symbol", "csl")
    return cut.join(spread(known.join(sizes, "symbol"), block), ["symbol", "blk"])


def label_bars(
    features: DataFrame,
    csl: DataFrame | float,
    ratio: float = 1.5,
    atr: str = "ATR_50",
    max_bars: int = 40,
    signal: Column | None = None,
    binary: bool = True,
    prices: tuple[float, float] = ENTRY_PRICES,
    block: int = BLOCK,
) -> DataFrame:
    """The frame's eligible bars plus ``label`` and ``entry_bar``.

    Barriers stand around the close of the same bar. A bar needs ``max_bars + 1``
    bars after it, a positive ATR and a price inside the band. The filters come
    after the forward window, which must see every bar.
    """
    cut = blocked(features.withColumn("_signal", F.lit(True) if signal is None else signal), 0, max_bars, block)
    cut = attach_csl(cut, csl, features, block)
    # The barriers are made before the window, once per row.
    close, atr_value = F.col("close"), F.round(atr, TIE_DIGITS)
    cut = cut.withColumns({
        "_stop": stop_price(close, atr_value, F.col("csl")),
        "_target": target_price(close, atr_value, F.col("csl"), F.col("csl") * ratio),
    })
    rows = own_rows(cut.withColumns(future_lists(max_bars)), block).filter(
        F.coalesce("_signal", F.lit(False))
        & (F.col("bar_no") <= F.col("n_bars") - max_bars - 2)
        & valid_atr(F.col(atr))
        & F.col("close").between(*prices)
    )
    label = barrier_label(F.col("_to_stop"), F.col("_to_target"))
    return (
        rows.withColumns({
            "_to_stop": first_low_at(F.col("_stop")), "_to_target": first_high_at(F.col("_target"))
        })
        .withColumns({"label": (label == 1).cast("int") if binary else label, "entry_bar": F.col("bar_no")})
        .select(*[c for c in features.columns if c not in block_columns(features)], "label", "entry_bar")
    )


def trade_durations(
    panel: DataFrame, stop: Column, target: Column, max_bars: int = 100, block: int = BLOCK
) -> DataFrame:
    """``symbol, bar_no, duration``: bars until a barrier is touched.

    ``max_bars`` when none is touched, also if the data ends sooner; 0 for the
    last bar of a symbol.
    """
    cut = blocked(panel.withColumns({"_stop": stop, "_target": target}), 0, max_bars, block)
    rows = own_rows(cut.withColumns(future_lists(max_bars)), block)
    touched = F.least(first_low_at(F.col("_stop")), first_high_at(F.col("_target")))
    duration = F.when(F.col("bar_no") == F.col("n_bars") - 1, 0).otherwise(F.coalesce(touched, F.lit(max_bars)))
    return rows.select("symbol", "bar_no", duration.cast("int").alias("duration"))
