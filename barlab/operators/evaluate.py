"""Classification metrics of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.scalars import above_threshold
from barlab.operators.panel import number_rows

#: Distinct scores that one task adds up.
RANGE = 1 << 16
#: Wide enough for the product of two counts, and for sums of these.
WIDE = "decimal(19,0)"


def classification_metrics(scored: DataFrame, keys: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, f1 and AUC per ``keys``.

    ``scored`` has ``label`` (0/1) and ``score`` in [0, 1]. Rows are first counted per
    distinct score; the rank sum behind the AUC runs over these counts in two levels, within and over
    ranges of ``RANGE`` distinct scores, however close together they lie. Pairs are counted in
    DECIMAL(38,0): positives times negatives pass a BIGINT at a few billion rows.
    """
    keys = list(keys)
    predicted, actual = above_threshold(F.col("score"), threshold) == 1, F.col("label") == 1
    confusion = scored.groupBy(*keys).agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
    )
    counts = scored.groupBy(*keys, "score").agg(
        F.count_if(actual).alias("_pos"), F.count_if(~actual).alias("_neg")
    )
    counts = number_rows(counts, keys, ["score"], "_row", "_all", "scores").withColumn("_range", F.expr(f"_row div {RANGE}L"))
    per_range = counts.groupBy(*keys, "_range").agg(F.sum("_neg").alias("_neg_in"))
    over = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = per_range.select(*keys, "_range", F.coalesce(F.sum("_neg_in").over(over), F.lit(0)).alias("_neg0"))
    inside = Window.partitionBy(*keys, "_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.col("_local"), F.lit(0)) + F.col("_neg0")
    # Pairs ranked right, ties counting half; doubled to stay in whole numbers.
    pairs = (
        counts.withColumn("_local", F.sum("_neg").over(inside))
        .join(start, [*keys, "_range"])
        .groupBy(*keys)
        .agg(F.sum(F.col("_pos").cast(WIDE) * (below * 2 + F.col("_neg")).cast(WIDE)).cast("double").alias("_pairs2"))
    )
    tp, fp, fn, tn = (F.col(c) for c in ["tp", "fp", "fn", "tn"])
    return confusion.join(pairs, keys).select(
        *keys, "tp", "fp", "fn", "tn",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(tp * 2, tp * 2 + fp + fn), F.lit(0.0)).alias("f1"),
        F.try_divide(F.col("_pairs2"), (tp + fn).cast("double") * (fp + tn).cast("double") * 2).alias("auc"),
    )
