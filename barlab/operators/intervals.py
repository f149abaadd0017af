"""Greedy choice of non-overlapping intervals, over any number of candidates.

In order of their start, a candidate is taken if it starts after the end of the
last one taken; one without an end blocks everything after it. This is a fold over
the whole history of a key, but as no interval is longer than ``max_len``, all
that a block of bars needs to know is the first allowed bar, one of ``max_len + 1``
offsets (or "blocked for good"). So each block maps every possible entry offset to
its exit offset, the maps are composed over ever larger groups of blocks, and the
true offsets come back down. Every fold is bounded by ``block`` or ``group``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.session import stage

BLOCK = 1024
GROUP = 1024
NEVER = 1 << 62


def _next_allowed(allowed: Column, candidate: Column, start: str, end: str) -> Column:
    taken = F.coalesce(candidate[end] + 1, F.lit(NEVER))
    return F.when(candidate[start] >= allowed, taken).otherwise(allowed)


def _block_map(block: int, max_len: int, start: str, end: str) -> Column:
    """Exit offset for each entry offset 0..max_len, then for "blocked"."""
    first = F.col("node") * block

    def leave(offset: Column) -> Column:
        allowed = F.aggregate(
            "candidates", first + offset, lambda acc, c: _next_allowed(acc, c, start, end)
        )
        return F.when(allowed == NEVER, max_len + 1).otherwise(F.greatest(allowed - first - block, F.lit(0)))

    offsets = F.transform(F.sequence(F.lit(0), F.lit(max_len)), lambda a: leave(a).cast("int"))
    return F.concat(offsets, F.array(F.lit(max_len + 1)))


def _after_gap(state: Column, blocked: int) -> Column:
    """Blocks without candidates are longer than any interval: all bars are free."""
    return F.when(state == blocked, blocked).otherwise(0)


def _through(members: Column, first: Column, state: Column, blocked: int) -> Column:
    """State after the maps in ``members`` (sorted by node), entered at node ``first``."""
    zero = F.struct((first - 1).alias("node"), state.cast("int").alias("state"))

    def step(acc: Column, m: Column) -> Column:
        entered = F.when(m["node"] == acc["node"] + 1, acc["state"]).otherwise(_after_gap(acc["state"], blocked))
        return F.struct(m["node"].alias("node"), F.element_at(m["map"], entered.cast("int") + 1).alias("state"))

    return F.aggregate(members, zero, step)


def _composed(group: int, max_len: int) -> Column:
    blocked = max_len + 1
    first, last = F.col("parent") * group, (F.col("parent") + 1) * group - 1

    def leave(offset: Column) -> Column:
        end = _through(F.col("members"), first, offset, blocked)
        return F.when(end["node"] == last, end["state"]).otherwise(_after_gap(end["state"], blocked)).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(blocked)), leave)


def _entered(group: int, max_len: int) -> Column:
    """Entry state of each member, given the entry state ``state`` of the parent."""
    blocked = max_len + 1
    empty = F.expr("cast(array() as array<struct<node:bigint,state:int>>)")
    zero = F.struct(
        (F.col("parent") * group - 1).alias("node"), F.col("state").alias("state"), empty.alias("seen")
    )

    def step(acc: Column, m: Column) -> Column:
        entered = (
            F.when(m["node"] == acc["node"] + 1, acc["state"])
            .otherwise(_after_gap(acc["state"], blocked))
            .cast("int")
        )
        return F.struct(
            m["node"].alias("node"),
            F.element_at(m["map"], entered + 1).alias("state"),
            F.concat(acc["seen"], F.array(F.struct(m["node"].alias("node"), entered.alias("state")))).alias("seen"),
        )

    return F.aggregate("members", zero, step)["seen"]


def select_intervals(
    candidates: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    max_len: int,
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """The candidates taken greedily per ``keys``, in order of ``start``.

    ``start`` is unique per key, ``end`` is null for an interval still open, and
    ``end - start <= max_len``. A block is longer than any interval; ``block`` is its least
    length. Other columns are carried along.
    """
    block = max(block, 1 << max_len.bit_length())
    keys = list(keys)
    payload = [c for c in candidates.columns if c not in keys and c not in (start, end)]
    row = F.struct(
        F.col(start).cast("long").alias(start), F.col(end).cast("long").alias(end), *payload
    )
    packs = stage(
        candidates.withColumn("node", F.expr(f"{start} div {block}L"))
        .groupBy(*keys, "node")
        .agg(F.sort_array(F.collect_list(row)).alias("candidates")),
        "packs",
    )
    top = packs.agg(F.max("node")).first()[0] or 0
    if top == 0:
        entered = packs.withColumn("state", F.lit(0))
    else:
        levels = [stage(packs.select(*keys, "node", _block_map(block, max_len, start, end).alias("map")), "maps")]
        width = top
        while True:
            # Grouped by parent; the last level has one parent per key.
            grouped = (
                levels[-1].withColumn("parent", F.expr(f"node div {group}L"))
                .groupBy(*keys, "parent")
                .agg(F.sort_array(F.collect_list(F.struct("node", "map"))).alias("members"))
            )
            width //= group
            if width == 0:
                break
            levels.append(stage(
                grouped.select(*keys, F.col("parent").alias("node"), _composed(group, max_len).alias("map")), "maps"
            ))
        states = None
        for maps in reversed(levels):
            grouped = (
                maps.withColumn("parent", F.expr(f"node div {group}L"))
                .groupBy(*keys, "parent")
                .agg(F.sort_array(F.collect_list(F.struct("node", "map"))).alias("members"))
            )
            if states is None:
                grouped = grouped.withColumn("state", F.lit(0))
            else:
                grouped = grouped.join(states.withColumnRenamed("node", "parent"), [*keys, "parent"])
            states = grouped.select(*keys, F.explode(_entered(group, max_len)).alias("s")).select(
                *keys, "s.node", "s.state"
            )
        entered = packs.join(states, [*keys, "node"])
    kind = packs.schema["candidates"].dataType.simpleString()
    zero = F.struct(
        F.when(F.col("state") == max_len + 1, F.lit(NEVER))
        .otherwise(F.col("node") * block + F.col("state"))
        .cast("long").alias("allowed"),
        F.expr(f"cast(array() as {kind})").alias("taken"),
    )

    def take(acc: Column, c: Column) -> Column:
        fits = c[start] >= acc["allowed"]
        taken = F.when(fits & c[end].isNotNull(), F.concat(acc["taken"], F.array(c))).otherwise(acc["taken"])
        return F.struct(
            _next_allowed(acc["allowed"], c, start, end).cast("long").alias("allowed"), taken.alias("taken")
        )

    picked = F.aggregate("candidates", zero, take)["taken"]
    return entered.select(*keys, F.explode(picked).alias("c")).select(*keys, "c.*")
