"""Splits over time: train/test per symbol, and walk-forward folds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.operators.panel import BLOCK, bar_window, blocked, lag, number_rows, own_rows, rank_kept


def split_by_time(labeled: DataFrame, train_share: float = 0.7, fewest_rows: int = 20, block: int = BLOCK) -> DataFrame:
    """Add ``part`` = train for the first share of each symbol's rows, else test.

    Symbols with too few rows, or with an empty part, are left out.
    """
    ranked = rank_kept(labeled, block=block)
    cut = F.floor(F.col("n_rows") * train_share)
    return (
        ranked.withColumn("split_at", cut)
        .filter((F.col("n_rows") >= fewest_rows) & (cut > 0) & (cut < F.col("n_rows")))
        .withColumn("part", F.when(F.col("row_no") < F.col("split_at"), "train").otherwise("test"))
    )


def split_summary(split: DataFrame) -> DataFrame:
    """``symbol, train_rows, test_rows, split_at``."""
    return split.groupBy("symbol").agg(
        F.count_if(F.col("part") == "train").alias("train_rows"),
        F.count_if(F.col("part") == "test").alias("test_rows"),
        F.max("split_at").alias("split_at"),
    )


def head_by_row_order(df: DataFrame, share: float) -> DataFrame:
    """The first ``share`` of all rows in ``(symbol, ts)`` order."""
    return (
        number_rows(df, [], ["symbol", "ts"], out="_row", total="_all", name="ordered")
        .filter(F.col("_row") < F.floor(F.col("_all") * share))
        .drop("_row", "_all")
    )


def walk_forward(panel: DataFrame, train: int = 252, test: int = 63, step: int = 21) -> DataFrame:
    """One row per (bar, fold) with ``part``; only folds that fit into the data.

    A bar belongs to at most ``(train + test) / step`` folds.
    """
    length = train + test
    first = F.expr(f"greatest((bar_no - {length} + {step}) div {step}L, 0L)")
    last = F.expr(f"least(bar_no div {step}L, (n_bars - {length}) div {step}L)")
    folds = F.when((F.col("n_bars") >= length) & (first <= last), F.sequence(first, last))
    inside = F.col("bar_no") - F.col("fold") * step
    return panel.withColumn("fold", F.explode(folds)).withColumn(
        "part", F.when(inside < train, "train").otherwise("test")
    )


def fold_summary(panel: DataFrame, train: int = 252, test: int = 63, step: int = 21) -> DataFrame:
    """``symbol, fold, first_ts, test_ts, last_ts, train_rows, test_rows`` of the folds that fit into the data.

    Bars are numbered without holes, so a fold's edges are known by number: only the bars on an edge take part,
    not every bar once per fold.
    """
    length = train + test
    ends = {"first_ts": 0, "test_ts": train, "last_ts": length - 1}
    edges = F.array(*[F.struct(F.lit(name).alias("edge"), (F.col("bar_no") - at).alias("start")) for name, at in ends.items()])
    on_edge = panel.select("symbol", "ts", "n_bars", F.explode(edges).alias("e")).filter(
        (F.col("e.start") >= 0) & (F.col("e.start") % step == 0) & (F.col("e.start") + length <= F.col("n_bars"))
    )
    return on_edge.withColumn("fold", F.expr(f"e.start div {step}L")).groupBy("symbol", "fold").agg(
        *[F.min(F.when(F.col("e.edge") == name, F.col("ts"))).alias(name) for name in ends],
        F.lit(train).cast("bigint").alias("train_rows"), F.lit(test).cast("bigint").alias("test_rows"),
    )


def fold_performance(
    panel: DataFrame, labels: DataFrame, train: int = 252, test: int = 63, step: int = 21, block: int = BLOCK
) -> DataFrame:
    """Measures per symbol, fold and part of walk-forward folds, without a row of a bar per fold.

    ``panel(symbol, bar_no, n_bars, close)`` has every bar, ``labels(symbol, bar_no, label)`` those with a label. Bars are
    summed up in units that divide all three lengths; a part is a difference of two running sums over units. Returns are those
    of a bar over the one before, which may belong to the part before; ``total_return`` is from the part's first close to its last.
    Only folds that fit into the data are there. A part without labels has a null rate.
    """
    unit = math.gcd(train, math.gcd(test, step))
    n_train, n_test, every = train // unit, test // unit, step // unit
    cut = blocked(panel.select("symbol", "bar_no", "n_bars", F.col("close").cast("double").alias("close")), 1, 0, block)
    moved = own_rows(cut.withColumn("ret", F.try_divide(F.col("close"), lag("close")) - 1), block)
    of_unit = F.expr(f"bar_no div {unit}L")
    sums = moved.groupBy("symbol", of_unit.alias("unit")).agg(
        F.count(F.lit(1)).alias("bars"), F.count("ret").alias("returns"), F.sum("ret").alias("ret"),
        F.sum(F.col("ret") * F.col("ret")).alias("squares"), F.min_by("close", "bar_no").alias("first"),
        F.max_by("close", "bar_no").alias("last"), F.max("n_bars").alias("all_bars"),
    )
    marks = labels.groupBy("symbol", of_unit.alias("unit")).agg(
        F.count("label").alias("labeled"), F.count_if(F.col("label") == 1).alias("positives")
    )
    added = ["bars", "returns", "ret", "squares", "labeled", "positives"]
    units = sums.join(marks, ["symbol", "unit"], "left").fillna(0, added).select(
        "symbol", F.col("unit").alias("bar_no"), F.expr(f"(all_bars + {unit - 1}L) div {unit}L").alias("n_bars"), "all_bars", "first", "last", *added,
    )
    rows = blocked(units, 1, n_train + n_test - 1, block)
    rows = rows.withColumns({f"_{c}": F.sum(c).over(bar_window().rowsBetween(Window.unboundedPreceding, 0)) for c in added})

    def part(name: str, start: int, length: int) -> Column:
        end = lambda c, k: F.lead(c, k).over(bar_window()) if k >= 0 else F.coalesce(F.lag(c, -k).over(bar_window()), F.lit(0))
        total = {c: (end(f"_{c}", start + length - 1) - end(f"_{c}", start - 1)).alias(c) for c in added}
        return F.struct(F.lit(name).alias("part"), *total.values(), end("first", start).alias("first"), end("last", start + length - 1).alias("last"))

    rows = own_rows(rows.withColumn("parts", F.array(part("train", 0, n_train), part("test", n_train, n_test))), block)
    fits = (F.col("bar_no") % every == 0) & (F.col("bar_no") * unit + train + test <= F.col("all_bars"))
    long = rows.filter(fits).select("symbol", F.expr(f"bar_no div {every}L").alias("fold"), F.explode("parts").alias("p")).select(
        "symbol", "fold", "p.*"
    )
    spread = F.greatest(F.col("squares") - F.col("ret") * F.col("ret") / F.col("returns"), F.lit(0.0))
    return long.select(
        "symbol", "fold", "part", "bars", "labeled", "positives", F.try_divide("positives", "labeled").alias("rate"),
        F.try_divide("ret", "returns").alias("mean_return"),
        F.when(F.col("returns") > 1, F.sqrt(spread / (F.col("returns") - 1))).alias("std_return"),
        (F.try_divide("last", "first") - 1).alias("total_return"),
    )
