"""Repeatable sampling without replacement, per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.session import stage


def hash_sample(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """The ``n`` rows per symbol with the smallest ``md5(symbol:bar_no:seed)``.

    The sample depends on the keys alone, not on partitioning. To rank only a
    few rows of a large symbol, a count per (symbol, bit length of the hash)
    gives the shortest bit lengths that hold ``n`` rows; the rest cannot be drawn.
    """
    text = F.concat_ws(":", "symbol", F.col("bar_no").cast("string"), F.lit(str(seed)))
    # 60 leading bits of the digest, as an integer.
    head = F.conv(F.substring("_md5", 1, 15), 16, 10).cast("long")
    hashed = rows.withColumn("_md5", F.md5(text)).withColumn("_bits", F.length(F.bin(head)))
    counts = hashed.groupBy("symbol", "_bits").count()
    shorter = Window.partitionBy("symbol").orderBy("_bits").rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        counts.withColumn("_before", F.coalesce(F.sum("count").over(shorter), F.lit(0)))
        .filter(F.col("_before") < n)
        .select("symbol", "_bits")
    )
    needed = stage(needed, "needed")
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy("_md5", "bar_no"))
    return (
        hashed.join(needed, ["symbol", "_bits"], "left_semi")
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= n)
        .drop("_md5", "_bits", "_rank")
    )
