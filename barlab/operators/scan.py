"""Exponential moving averages as window expressions.

The recurrence ``y = A*y_prev + b`` is solved in segments of bars: inside a segment
by a running sum of ``b`` scaled with the running product of ``A``, plus the end of
the segment before. A segment is so long that everything before these two weighs
less than ``RESIDUAL``, below the precision of a double.

Missing values follow ``ewm(adjust=False, ignore_na=False)``: leading nulls stay
null, an inner null repeats the last value, and the next value is weighted by the
age of the last one. A column that may miss values goes through :func:`run_scans`, which looks back over any
distance: the bars of a block after its first known one are an affine map of that one's value, a block
is summed up by this map and by the bars of its first and last known value, and the maps of a symbol's blocks are
composed in order. Segments then follow the decay, not the bars, as a gap may decay as much as a thousand bars.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.operators.panel import SUB, bar_window, earlier_bars, segment_window
from barlab.operators.recipes import LAGS, Recipe, Scan

RESIDUAL = 1e-17
MAX_EXPONENT = 600.0  # the scaling of a segment must stay a finite double
LOG_FLOOR = -40.0     # decay of one step; anything below forgets the past
DECAY = 400.0         # decay in logs over a segment of a scan


def reach_of(span: float, residual: float = RESIDUAL) -> int:
    """Bars after which an old value weighs less than ``residual``."""
    return math.ceil(math.log(residual) / math.log(1.0 - 2.0 / (span + 1.0)))


def segment_length(span: float, residual: float = RESIDUAL) -> int:
    """The common length if it fits the span, else a power of two of its own."""
    per_bar = -math.log(1.0 - 2.0 / (span + 1.0))
    needed = reach_of(span, residual)
    if needed <= SUB and SUB * per_bar <= MAX_EXPONENT:
        return SUB
    return 1 << max(0, math.ceil(math.log2(needed)))


def ema(
    column: str,
    span: int,
    out: str,
    after: list[Recipe] | None = None,
    dense: bool = False,
    residual: float = RESIDUAL,
    first_stage: int = LAGS,
) -> Recipe:
    """EMA with ``alpha = 2/(span+1)``, started at the first value.

    ``dense`` promises that ``column`` is never null: the result then needs no look beyond the block and its
    halo, and is there from stage ``first_stage + 7`` on. Otherwise any number of values may be missing, and the result is there
    after stage ``first_stage``, on a block's own bars.
    """
    if span <= 1:
        raise ValueError("span must be above 1")
    if not dense:
        return Recipe({}, [out], 0, after=list(after or []), scans=[Scan(column, span, out, first_stage)])
    alpha = 2.0 / (span + 1.0)
    keep = 1.0 - alpha
    length = segment_length(span, residual)
    t = f"_{out}_"
    x = F.col(column)
    decay = F.exp((F.col("bar_no") % length + 1) * math.log(keep))
    step = F.when(F.col("bar_no") == 0, x).otherwise(x * alpha)
    stages = {first_stage + 3: {t + "decay": decay, t + "z": step / decay}}
    return _from_segments(stages, t, out, F.lit(True), length, span, after, residual, first_stage)


def ema_of_most(
    column: str, span: int, out: str, after: list[Recipe] | None = None, residual: float = RESIDUAL, first_stage: int = LAGS
) -> Recipe:
    """EMA of a column that misses leading values, and else single ones at most.

    As cheap as with ``dense``, so the directional index uses it. After a run of missing values longer than the halo
    it is null up to the next value.
    """
    alpha = 2.0 / (span + 1.0)
    keep = 1.0 - alpha
    length = segment_length(span, residual)
    segment = segment_window(length)
    t = f"_{out}_"
    x = F.col(column)
    s = first_stage
    seen = F.col(t + "seen")
    aged = F.pow(F.lit(keep), F.col("bar_no") - seen)
    # The first value has no predecessor: full weight, and its decay meets no carry.
    step = F.when(seen.isNull(), x).otherwise(x * alpha / (aged + alpha))
    log_decay = (
        F.when(x.isNull(), 0.0)
        .when(seen.isNull(), math.log(keep))
        .otherwise(F.greatest(F.ln(aged / (aged + alpha)), F.lit(LOG_FLOOR)))
    )
    stages = {
        s: {t + "seen": F.last(F.when(x.isNotNull(), F.col("bar_no")), ignorenulls=True).over(earlier_bars())},
        s + 1: {t + "b": F.coalesce(step, F.lit(0.0)), t + "ln": log_decay},
        s + 2: {t + "decay": F.exp(F.sum(t + "ln").over(segment))},
        s + 3: {t + "z": F.col(t + "b") / F.col(t + "decay")},
    }
    return _from_segments(stages, t, out, x.isNotNull() | seen.isNotNull(), length, span, after, residual, s)


def _from_segments(
    stages: dict, t: str, out: str, known: Column, length: int, span: float, after: list[Recipe] | None, residual: float, s: int
) -> Recipe:
    """The last stages of an EMA over segments of fixed length: their running sums, and the end of the one before."""
    last = F.col("bar_no") % length == length - 1
    carry = F.coalesce(F.col(t + "carry"), F.lit(0.0))
    stages = {
        **stages,
        s + 4: {t + "sum": F.sum(t + "z").over(segment_window(length))},
        s + 5: {t + "end": F.when(last, F.col(t + "sum") * F.col(t + "decay"))},
        s + 6: {t + "carry": F.last(t + "end", ignorenulls=True).over(earlier_bars())},
        s + 7: {out: F.when(known, F.col(t + "decay") * (F.col(t + "sum") + carry))},
    }
    return Recipe(stages, [out], lookback=reach_of(span, residual), after=list(after or []))


# Gaps of any length ---------------------------------------------------------------


def _decay(gap: Column, span: float) -> tuple[Column, Column, Column]:
    """How a value ``gap`` bars later takes over: minus the log of the old weight, the old weight, the new one."""
    alpha = 2.0 / (span + 1.0)
    aged = F.pow(F.lit(1.0 - alpha), gap)
    old = aged / (aged + alpha)
    # The log of a weight that underflows is missing, and everything below the floor forgets the past.
    return F.least(-F.coalesce(F.ln(old), F.lit(LOG_FLOOR)), F.lit(-LOG_FLOOR)), old, alpha / (aged + alpha)


def _affine_sums(df: DataFrame, parts: Sequence[str], at: str, t: str) -> DataFrame:
    """Add ``<t>y``: the recurrence ``y = exp(-ln)*y_prev + b`` from 0, over ``parts`` in the order of ``at``.

    ``df`` has ``<t>ln``, ``<t>b`` and the running sum ``<t>L`` of ``ln``. A segment ends when the decay has grown by ``DECAY``, so
    only its own sum and that of the segment before count.
    """
    segment = F.col(t + "seg")
    inside = Window.partitionBy(*parts, t + "seg").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    in_order = Window.partitionBy(*parts).orderBy(t + "seg", at)  # the order of the bars, and so the same sort
    df = df.withColumn(t + "seg", F.floor(F.col(t + "L") / DECAY))
    df = df.withColumn(t + "z", F.col(t + "b") * F.exp(F.col(t + "L") - segment * DECAY))
    df = df.withColumn(t + "S", F.sum(t + "z").over(inside))
    df = df.withColumn(t + "p", F.lag(t + "S").over(in_order))
    df = df.withColumn(t + "p", F.first(t + "p").over(inside))
    whole = F.col(t + "S") + math.exp(-DECAY) * F.coalesce(F.col(t + "p"), F.lit(0.0))
    return df.withColumn(t + "y", F.exp(segment * DECAY - F.col(t + "L")) * whole).drop(t + "seg", t + "z", t + "S", t + "p")


def run_scans(df: DataFrame, scans: Sequence[Scan], block: int) -> DataFrame:
    """Add the results of ``scans`` to a blocked frame; a block's copies of other bars get nulls.

    The frame is shuffled no further: its blocks are summed up where they are, one row for each goes through a window by symbol,
    and comes back by a join on the blocks.
    """
    own = F.expr(f"bar_no div {block}L = blk")
    names = {s.out: f"_{s.out}_" for s in scans}
    so_far = bar_window().rowsBetween(Window.unboundedPreceding, 0)
    bar = F.col("bar_no")
    seen, steps, sums = {}, {}, {}
    for s in scans:
        t = names[s.out]
        x = F.col(t + "x")
        seen[t + "seen"] = F.last(F.when(x.isNotNull(), bar), ignorenulls=True).over(earlier_bars())
        later = x.isNotNull() & F.col(t + "seen").isNotNull()
        ln, _, new = _decay(bar - F.col(t + "seen"), s.span)
        steps |= {t + "ln": F.when(later, ln).otherwise(0.0), t + "b": F.when(later, new * x).otherwise(0.0)}
        sums[t + "L"] = F.sum(t + "ln").over(so_far)
    kept = df.columns
    df = df.withColumns({names[s.out] + "x": F.when(own, F.col(s.column).cast("double")) for s in scans})
    df = df.withColumns(seen).withColumns(steps).withColumns(sums)
    for t in names.values():
        df = _affine_sums(df, ["symbol", "blk"], "bar_no", t)
    carry = _carried(df.filter(own), scans)
    met = df.join(carry, ["symbol", "blk"])
    results = {}
    for s in scans:
        t = names[s.out]
        inside = F.exp(-F.col(t + "L")) * F.col(t + "first") + F.col(t + "y")
        results[s.out] = F.when(own, F.when(bar >= F.col(t + "t1"), inside).otherwise(F.col(t + "before")))
    return met.withColumns(results).select(*[c for c in kept if c not in results], *results)


def _carried(rows: DataFrame, scans: Sequence[Scan]) -> DataFrame:
    """Per block and scan: ``before``, the value the block begins with, and ``first``, that of its first known bar ``t1``."""
    ends = {}
    for s in scans:
        t = f"_{s.out}_"
        known = F.when(F.col(t + "x").isNotNull(), F.col("bar_no"))
        ends |= {
            t + "t1": F.min(known), t + "x1": F.min_by(t + "x", known), t + "t2": F.max(known), t + "L1": F.max(t + "L"),
            t + "y1": F.max_by(t + "y", "bar_no"),
        }
    blocks = rows.groupBy("symbol", "blk").agg(*[c.alias(n) for n, c in ends.items()])
    by_symbol = Window.partitionBy("symbol").orderBy("blk")
    earlier = by_symbol.rowsBetween(Window.unboundedPreceding, -1)
    for s in scans:
        t = f"_{s.out}_"
        known, begun = F.col(t + "t1").isNotNull(), F.col(t + "last").isNotNull()
        blocks = blocks.withColumn(t + "last", F.last(t + "t2", ignorenulls=True).over(earlier))
        ln, old, new = _decay(F.col(t + "t1") - F.col(t + "last"), s.span)
        start = F.when(begun, new * F.col(t + "x1")).otherwise(F.col(t + "x1"))
        blocks = blocks.withColumns({
            t + "ln": F.when(known & begun, F.least(F.col(t + "L1") + ln, F.lit(-LOG_FLOOR))).otherwise(0.0),
            t + "b": F.when(known, F.exp(-F.col(t + "L1")) * start + F.col(t + "y1")).otherwise(0.0),
        })
        blocks = blocks.withColumn(t + "L", F.sum(t + "ln").over(by_symbol.rowsBetween(Window.unboundedPreceding, 0)))
        blocks = _affine_sums(blocks, ["symbol"], "blk", t)
        blocks = blocks.withColumn(t + "before", F.when(begun, F.lag(t + "y").over(by_symbol)))
        blocks = blocks.withColumn(t + "first", F.when(begun, old * F.col(t + "before")).otherwise(0.0) + start)
    return blocks.select("symbol", "blk", *[f"_{s.out}_{c}" for s in scans for c in ("t1", "before", "first")])
