"""Any number of rules on every bar, by an index over their thresholds.

Rules are numbered and dealt into chunks. A chunk holds, per feature, the sorted cuts at which one of its rules begins
or ends to hold, and after each cut a bitmap of the rules whose bounds on that feature hold there. A bar finds its place
among the cuts of each feature by binary search and takes the AND of the bitmaps found; the bits left are its rules.

The plan has one expression whatever the number of rules, and no rule reaches the driver. A chunk's size is
bounded by its number of rules, so the index grows in proportion to the rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.operators.features import feature_columns
from barlab.operators.panel import BLOCK, number_rows
from barlab.operators.rules import merge_bounds
from barlab.session import stage

CHUNK = 1024
WORDS = CHUNK // 64
STEPS = [1 << k for k in reversed(range((2 * CHUNK + 2).bit_length()))]
LOW = float("-inf")
#: An index of at most so many bytes is sent to every task; bars meet a larger one by a join on their blocks.
SENT_BYTES = 64 << 20


def usable_bounds(parsed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Merged bounds of the rules that can be applied and can match.

    Left out are rules with a condition that cannot be read or that names none of ``columns``, and rules whose bounds on a
    feature contradict each other.
    """
    bad = parsed.filter(F.col("threshold").isNull() | ~F.col("feature").isin(*columns)).select("rule_id").distinct()
    bounds = stage(merge_bounds(parsed.join(bad, "rule_id", "left_anti")), "bounds")
    empty = (F.col("lower") > F.col("upper")) | ((F.col("lower") == F.col("upper")) & ~(F.col("lower_closed") & F.col("upper_closed")))
    return bounds.join(bounds.filter(empty).select("rule_id").distinct(), "rule_id", "left_anti")


def build_index(parsed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``chunk, ids, every, features``, staged: a row per chunk of rules.

    ``parsed`` is the result of :func:`parse_conditions`. ``ids`` are the rule ids by place, ``every`` the bitmap of all of them,
    and ``features`` has per feature its place in ``columns`` and its cuts ``(t, after, bits)``, in order: ``bits`` hold from
    ``t`` on, or after it. The first cut stands for a missing value.
    """
    bounds = stage(usable_bounds(parsed, columns), "usable")
    places = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature")).cast("int") - 1
    numbered = number_rows(bounds.select("rule_id").distinct(), [], ["rule_id"], out="no", total="all", name="rules")
    numbered = stage(numbered.select(
        "rule_id", F.expr(f"no div {CHUNK}L").alias("chunk"), F.expr(f"cast(no % {CHUNK} div 64 as int)").alias("word"),
        F.expr("shiftleft(1L, cast(no % 64 as int))").alias("mask"), "no",
    ), "numbered")
    every = numbered.groupBy("chunk", "word").agg(F.bit_or("mask").alias("bits"))
    rows = stage(bounds.join(numbered, "rule_id").withColumn("pos", places), "placed")
    held = rows.groupBy("chunk", "pos", "word").agg(F.bit_or("mask").alias("with"))
    used = held.select("chunk", "pos").distinct()
    free = used.join(every, "chunk").join(held, ["chunk", "pos", "word"], "left")
    zero, one = F.lit(0), F.lit(1)
    cells = [
        # Rules without a condition on the feature hold everywhere, also for a missing value.
        free.select("chunk", "pos", F.lit(LOW).alias("t"), F.lit(-1).alias("after"), "word",
                    F.col("bits").bitwiseXOR(F.coalesce("with", F.lit(0).cast("bigint"))).alias("mask")),
        rows.select("chunk", "pos", F.coalesce("lower", F.lit(LOW)).alias("t"),
                    F.when(F.coalesce("lower_closed", F.lit(True)), zero).otherwise(one).alias("after"), "word", "mask"),
        rows.filter(F.col("upper").isNotNull()).select(
            "chunk", "pos", F.col("upper").alias("t"), F.when(F.col("upper_closed"), one).otherwise(zero).alias("after"), "word", "mask"),
        used.select("chunk", "pos", F.lit(LOW).alias("t"), zero.alias("after"), zero.alias("word"), F.lit(0).cast("bigint").alias("mask")),
    ]
    turns = cells[0]
    for more in cells[1:]:
        turns = turns.unionByName(more)
    turns = stage(turns, "turns")
    cuts = turns.select("chunk", "pos", "t", "after").distinct()
    grid = cuts.withColumns({"word": F.explode(F.expr(f"sequence(0, {WORDS - 1})")), "mask": F.lit(0).cast("bigint")})
    turned = turns.unionByName(grid).groupBy("chunk", "pos", "t", "after", "word").agg(F.bit_xor("mask").alias("mask"))
    so_far = Window.partitionBy("chunk", "pos", "word").orderBy("t", "after").rowsBetween(Window.unboundedPreceding, 0)
    bits = turned.withColumn("bits", F.bit_xor("mask").over(so_far))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"]
    wide = bits.groupBy("chunk", "pos", "t", "after").agg(in_order.alias("bits"))
    per_feature = wide.groupBy("chunk", "pos").agg(F.sort_array(F.collect_list(F.struct("t", "after", "bits"))).alias("cuts"))
    features = per_feature.groupBy("chunk").agg(F.collect_list(F.struct("pos", "cuts")).alias("features"))
    all_words = every.unionByName(every.select("chunk").distinct().withColumns(
        {"word": F.explode(F.expr(f"sequence(0, {WORDS - 1})")), "bits": F.lit(0).cast("bigint")}))
    all_words = all_words.groupBy("chunk", "word").agg(F.bit_or("bits").alias("bits")).groupBy("chunk").agg(in_order.alias("every"))
    ids = numbered.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("no", "rule_id")))["rule_id"].alias("ids"))
    return stage(ids.join(all_words, "chunk").join(features, "chunk").select("chunk", "ids", "every", "features"), "index")


def _bits_at(feature: Column, values: Column) -> Column:
    """The bitmap of a feature at the bar's value: binary search among its cuts."""
    value = F.get(values, feature["pos"])

    def step(found: Column, width: Column) -> Column:
        cut = F.get(feature["cuts"], found + width - 1)
        passed = (cut["t"] < value) | ((cut["t"] == value) & (cut["after"] <= 0))
        return F.when(F.coalesce(passed, F.lit(False)), found + width).otherwise(found)

    passed = F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), step)
    return F.get(feature["cuts"], F.greatest(passed, F.lit(1)) - 1)["bits"]


def matched_words(values: Column) -> Column:
    """The bitmap of a chunk's rules that a bar matches, on a bar joined with an index row."""
    return F.aggregate(
        "features", F.col("every"), lambda found, f: F.zip_with(found, _bits_at(f, values), lambda a, b: a.bitwiseAND(b))
    )


def meet_index(bars: DataFrame, index: DataFrame, block: int = BLOCK, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """Every bar with every chunk.

    A small index goes to the bars. Of a larger one each block of bars gets a copy, so that neither a chunk nor
    a symbol is a key with too many rows.
    """
    size = index.agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum(F.aggregate("features", F.lit(0).cast("bigint"), lambda n, f: n + F.size(f["cuts"]) * (8 * WORDS + 40))).alias("bytes"),
    ).first()
    if not size["chunks"]:
        return bars.withColumn("chunk", F.lit(0).cast("bigint")).limit(0).join(index, "chunk")
    each = bars.withColumn("chunk", F.explode(F.expr(f"sequence(0L, {size['chunks'] - 1}L)")))
    if size["bytes"] <= sent_bytes:
        return each.join(F.broadcast(index), "chunk")
    each = each.withColumn("_blk", F.expr(f"bar_no div {block}L"))
    copies = each.select("symbol", "_blk", "chunk").distinct().join(index, "chunk")
    return each.join(stage(copies, "copies"), ["symbol", "_blk", "chunk"]).drop("_blk")


def rule_hits_many(features: DataFrame, parsed: DataFrame, columns: Sequence[str] | None = None, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``symbol, ts, bar_no, rule_id``: one row per (bar, matched rule), for rules given as a table.

    ``parsed`` comes from :func:`parse_conditions`. Conditions may name any of ``columns``, by default the numeric columns that are
    no bar numbers. A missing value matches no condition. Rules left out are those of :func:`usable_bounds`.
    """
    known = list(columns) if columns else [*feature_columns(features), "open", "high", "low", "close", "volume"]
    known = [c for c in dict.fromkeys(known) if c in features.columns]
    # At most as many names as columns, so that the scan reads only what rules ask for.
    named = [r["feature"] for r in parsed.filter(F.col("feature").isin(*known)).select("feature").distinct().collect()]
    asked = [c for c in known if c in named] or known[:1]
    index = build_index(parsed, asked)
    bars = features.select("symbol", "ts", "bar_no", F.array(*[F.col(c).cast("double") for c in asked]).alias("values"))
    met = meet_index(bars, index, sent_bytes=sent_bytes)
    words = met.select("symbol", "ts", "bar_no", "ids", F.posexplode(matched_words(F.col("values"))).alias("word", "bits"))
    bits = F.expr("filter(sequence(0, 63), b -> bit_get(bits, b) = 1)")
    hits = words.filter(F.col("bits") != 0).select("symbol", "ts", "bar_no", "ids", "word", F.explode(bits).alias("bit"))
    return hits.select("symbol", "ts", "bar_no", F.get("ids", F.col("word") * 64 + F.col("bit")).alias("rule_id"))


def signal_counts_many(features: DataFrame, parsed: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of signal bars per (symbol, rule); pairs without a signal have no row."""
    return rule_hits_many(features, parsed, columns).groupBy("symbol", "rule_id").agg(F.count(F.lit(1)).alias("n_signals"))
