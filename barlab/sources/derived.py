"""Bars derived from an order-line table: a bounded random walk in whole cents.

Every line moves the price of its symbol by 0 to 5 steps, up or down, reflected
into [2, 18]. The walk is a running sum over the symbol's whole history, so it is
summed in three levels: totals per (symbol, day), of which a symbol has as many as the calendar has days; per key
range of a day, of which there are more the larger the table is; and a running sum inside each of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TIE_BREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# Even with a third of all lines on one day of one symbol, a key range of that day
# holds about this many lines.
LINES_PER_RANGE = 4_000_000


def lineitem_ticks(lineitem: DataFrame, symbols: int = 10, per_range: int = LINES_PER_RANGE) -> DataFrame:
    """One priced tick per order line: ``symbol, ts, <tie break>, volume, px``."""
    size = lineitem.agg(F.max("l_orderkey").alias("top"), F.count(F.lit(1)).alias("lines")).first()
    width = int(size["top"] or 0) // (size["lines"] // (3 * per_range) + 1) + 1
    ticks = lineitem.select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % symbols).cast("string")).alias("symbol"),
        F.col("l_shipdate").alias("ts"),
        *TIE_BREAK,
        F.col("l_quantity").alias("volume"),
        (F.round(F.col("l_discount") * 100).cast("long") - 5).alias("step"),
        F.expr(f"l_orderkey div {width}L").alias("range"),
    )
    totals = ticks.groupBy("symbol", "ts", "range").agg(F.sum("step").alias("total"))
    before = lambda w: F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = totals.groupBy("symbol", "ts").agg(F.sum("total").alias("total"))
    of_day = days.select("symbol", "ts", before(Window.partitionBy("symbol").orderBy("ts")).alias("day_start"))
    in_day = totals.withColumn("start", before(Window.partitionBy("symbol", "ts").orderBy("range")))
    starts = in_day.join(of_day, ["symbol", "ts"]).select("symbol", "ts", "range", (F.col("start") + F.col("day_start")).alias("start"))
    inside = Window.partitionBy("symbol", "ts", "range").orderBy(*TIE_BREAK).rowsBetween(Window.unboundedPreceding, 0)
    k = F.col("start") + F.col("local")
    folded = F.abs(F.pmod(k * 5 + 800, F.lit(3200)) - 1600)
    return (
        ticks.withColumn("local", F.sum("step").over(inside))
        .join(starts, ["symbol", "ts", "range"])
        .withColumn("px", (folded + 200) / F.lit(100.0))
        .drop("range", "step", "local", "start")
    )


def lineitem_bars(spark: SparkSession, sf_dir: str, symbols: int = 10) -> DataFrame:
    """Daily bars per symbol from the ticks of :func:`lineitem_ticks`."""
    ticks = lineitem_ticks(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), symbols)
    place = F.struct(*TIE_BREAK)
    return ticks.groupBy("symbol", "ts").agg(
        F.min_by("px", place).alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", place).alias("close"),
        F.sum("volume").alias("volume"),
    )
