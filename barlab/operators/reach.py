"""First later bar that reaches a level, over an unbounded horizon.

The bars are summarised in a tree: a node holds the highest value of each of its
``FAN`` children, and is in turn a child of the next level. A search climbs until
a node shows a later child that reaches the level, then steps down to the bar.
Each step is one equi-join of the open searches with one level, so no search
meets more than ``FAN`` values per step and no pairs are built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.operators.panel import BLOCK, blocked, own_rows
from barlab.operators.touch import first_high_at, first_low_at, future_lists
from barlab.session import stage

FAN = 64
NEAR = 32


def _levels(series: DataFrame, keys: Sequence[str], fan: int) -> list[DataFrame]:
    """Level 0 groups bars, level 1 groups level-0 nodes, and so on to one root."""
    top = series.agg(F.max("bar_no")).first()[0]
    rows = series.select(*keys, F.col("bar_no").alias("child"), F.col("value").alias("peak"))
    levels, width = [], top
    while True:
        place = F.struct((F.col("child") % fan).alias("at"), "peak")
        node = (
            rows.withColumn("node", F.expr(f"child div {fan}L"))
            .groupBy(*keys, "node")
            .agg(F.collect_list(place).alias("peaks"), F.max("peak").alias("_max"))
        )
        levels.append(stage(node, f"reach{len(levels)}"))
        if width < fan:
            return levels
        width //= fan
        rows = levels[-1].select(*keys, F.col("node").alias("child"), F.col("_max").alias("peak"))


def first_reach(
    series: DataFrame, searches: DataFrame, keys: Sequence[str], fan: int = FAN
) -> DataFrame:
    """``searches`` plus ``reach_bar``: least ``bar_no`` above theirs with ``value >= level``.

    ``series(keys, bar_no, value)``; ``searches(keys, bar_no, level, ...)``;
    ``reach_bar`` is null when the level is never reached.
    """
    keys = list(keys)
    levels = _levels(series.filter(F.col("value").isNotNull()), keys, fan)
    extra = [c for c in searches.columns if c not in keys]
    # `at` is the child a search stands on; it looks at later children only.
    open_ = searches.withColumn("_child", F.col("bar_no"))
    climbed = []
    for height, nodes in enumerate(levels):
        here = open_.withColumns({"node": F.expr(f"_child div {fan}L"), "_at": F.expr(f"_child % {fan}L")})
        met = here.join(nodes.select(*keys, "node", "peaks"), [*keys, "node"], "left").withColumn(
            "_hit",
            F.array_min(F.transform(
                F.filter("peaks", lambda x: (x["at"] > F.col("_at")) & (x["peak"] >= F.col("level"))),
                lambda x: x["at"],
            )),
        )
        met = stage(met.drop("peaks", "_at"), f"climb{height}")
        found = met.filter(F.col("_hit").isNotNull())
        climbed.append(found.withColumn("_child", F.col("node") * fan + F.col("_hit")).drop("node", "_hit"))
        open_ = met.filter(F.col("_hit").isNull()).withColumn("_child", F.col("node")).drop("node", "_hit")
    missed = open_.select(*keys, *extra, F.lit(None).cast("long").alias("reach_bar"))
    # Step down: a child of height h is a node of height h-1.
    falling = None
    for height in range(len(levels) - 1, 0, -1):
        here = climbed[height] if falling is None else falling.unionByName(climbed[height])
        nodes = levels[height - 1].select(*keys, F.col("node").alias("_child"), "peaks")
        first = F.array_min(F.transform(F.filter("peaks", lambda x: x["peak"] >= F.col("level")), lambda x: x["at"]))
        falling = (
            here.join(nodes, [*keys, "_child"])
            .withColumn("_child", F.col("_child") * fan + first)
            .drop("peaks")
        )
    landed = climbed[0] if falling is None else climbed[0].unionByName(falling)
    return landed.select(*keys, *extra, F.col("_child").alias("reach_bar")).unionByName(missed)


def durations_by_ratio(
    panel: DataFrame,
    entry_price: Column,
    atr: Column,
    csl: float,
    ratios: Sequence[float],
    near: int = NEAR,
    block: int = BLOCK,
    fan: int = FAN,
) -> DataFrame:
    """``symbol, bar_no, ratio, duration`` per entry and target/stop ratio.

    ``entry_price`` and ``atr`` are columns of the panel; a bar where one is null is
    no entry. An untouched trade lasts all bars left. Most trades end within ``near``
    bars and are settled in one window; only the others are searched over the rest of
    the history.
    """
    keys = ["symbol", "bar_no"]
    price, risk = F.col("_price"), F.col("_atr")
    cut = blocked(
        panel.select(*keys, "n_bars", "low", "high", entry_price.alias("_price"), atr.alias("_atr")), 0, near, block
    ).withColumns({
        "_stop": price - risk * float(csl),
        **{f"_target{i}": price + F.lit(float(r)) * float(csl) * risk for i, r in enumerate(ratios)},
    })
    rows = own_rows(cut.withColumns(future_lists(near)), block).filter(F.col("_stop").isNotNull())
    rows = rows.withColumn("_near_stop", first_low_at(F.col("_stop")))
    rows = rows.withColumns({
        f"_near{i}": F.least("_near_stop", first_high_at(F.col(f"_target{i}"))) for i in range(len(ratios))
    })
    per_ratio = F.array(*[
        F.struct(
            F.lit(float(r)).alias("ratio"), F.col(f"_near{i}").alias("met"), F.col(f"_target{i}").alias("target")
        )
        for i, r in enumerate(ratios)
    ])
    settled = (
        stage(rows.select(*keys, "n_bars", F.col("_stop").alias("stop"), per_ratio.alias("r")), "near")
        .select(*keys, "n_bars", "stop", F.explode("r").alias("r"))
        .select(*keys, "n_bars", "stop", "r.*")
    )
    left = F.col("n_bars") - 1 - F.col("bar_no")
    far = settled.filter(F.col("met").isNull() & (left > near))
    done = settled.filter(F.col("met").isNotNull() | (left <= near)).select(
        *keys, "ratio", F.coalesce("met", left).alias("duration")
    )
    falls = panel.select("symbol", F.lit("stop").alias("side"), "bar_no", (-F.col("low")).alias("value"))
    rises = panel.select("symbol", F.lit("target").alias("side"), "bar_no", F.col("high").alias("value"))
    sides = F.array(
        F.struct(F.lit("stop").alias("side"), (-F.col("stop")).alias("level")),
        F.struct(F.lit("target").alias("side"), F.col("target").alias("level")),
    )
    searches = far.select(
        "symbol", F.col("bar_no").alias("entry"), (F.col("bar_no") + near).alias("bar_no"), "ratio", "n_bars",
        F.explode(sides).alias("s"),
    ).select("symbol", "entry", "bar_no", "ratio", "n_bars", "s.*")
    met = first_reach(falls.unionByName(rises), searches, ["symbol", "side"], fan)
    late = met.groupBy("symbol", "entry", "ratio").agg(
        F.min("reach_bar").alias("_bar"), F.max("n_bars").alias("n_bars")
    ).select(
        "symbol", F.col("entry").alias("bar_no"), "ratio",
        (F.coalesce("_bar", F.col("n_bars") - 1) - F.col("entry")).alias("duration"),
    )
    return done.unionByName(late)
