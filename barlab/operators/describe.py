"""Summary statistics per symbol, with exact quantiles for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.operators import indicators as ind
from barlab.operators.panel import BLOCK, number_rows
from barlab.operators.recipes import with_indicators
from barlab.params import TIE_DIGITS
from barlab.session import stage

QUARTILES = (0.25, 0.5, 0.75)
#: Entries of a quantile sketch. The rank of what it gives is wrong by at most one in so many.
ACCURACY = 1_000
#: Half the width of the bracket around a wanted rank, as a share of all ranks; the sketch's error has to fit well inside.
REACH = 0.005
#: Rows of a group whose columns an aggregate may hold as they are. With so many, a bracket is several ranks wide.
FEW = 4_096


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``symbol, bar_no, feature, value`` without missing values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])
    return (
        df.select("symbol", "bar_no", F.explode(pairs).alias("p"))
        .select("symbol", "bar_no", "p.feature", "p.value")
        .filter(F.col("value").isNotNull())
    )


def wide_quantiles(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float] = QUARTILES, few: int = FEW, reach: float = REACH
) -> DataFrame:
    """``keys, feature, count, mean, std, min, max, q0, q1, ...``: interpolated quantiles of many columns, exact.

    Rows stay wide. Groups of fewer than ``few`` rows are held by an aggregate; see :func:`_bracketed` for larger ones. Both find the
    values at the same two ranks and blend them alike, so the size of a group does not show in the result.
    """
    keys = list(keys)
    names = [f"_c{i}" for i in range(len(columns))]
    rows = df.select(*keys, *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    moments = [
        f(n).alias(f"{n}_{m}") for n in names
        for m, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    first = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *moments), "moments")
    small, large = first.filter(F.col("_rows") < few), first.filter(F.col("_rows") >= few)
    sides = []
    if not small.isEmpty():
        asked = F.array(*[F.lit(float(p)) for p in probs])
        of_small = rows if large.isEmpty() else rows.join(small.select(*keys), keys, "left_semi")
        held = of_small.groupBy(*keys).agg(*[F.percentile(n, asked).alias(f"{n}_q") for n in names])
        sides.append(small.join(held, keys))
    if not large.isEmpty():
        of_large = rows if small.isEmpty() else rows.join(large.select(*keys), keys, "left_semi")
        sides.append(large.join(_bracketed(of_large, large, keys, names, probs, reach), keys))
    if not sides:
        sides.append(first.withColumns({f"{n}_q": F.lit(None).cast("array<double>") for n in names}))
    per_feature = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{n}_{m}").alias(m) for m in STATS], F.col(f"{n}_q").alias("q")) for c, n in zip(columns, names)
    ])
    long = [side.select(*keys, F.explode(per_feature).alias("f")).select(*keys, "f.*").filter("count > 0") for side in sides]
    whole = long[0] if len(long) == 1 else long[0].unionByName(long[1])
    return whole.select(*keys, "feature", *STATS, *[F.get("q", F.lit(j)).alias(f"q{j}") for j in range(len(probs))])


def _bracketed(
    rows: DataFrame, sizes: DataFrame, keys: list[str], names: list[str], probs: Sequence[float], reach: float
) -> DataFrame:
    """``keys`` and ``<name>_q``, the quantiles of each column, for groups of any size.

    A mergeable sketch of every column gives a bracket ``(low, high)`` around each wanted rank. The values strictly inside,
    some hundredths of all, are sorted over all tasks, and a count of those up to ``low`` gives their ranks, so a result
    from inside is proven. Values beyond measure are an end of the bracket and are not moved; a result
    at an end is proven by a count of its own, and where that fails the group goes again with wider brackets.
    """
    asked = sorted({e for p in probs for e in (p - reach, p + reach) if 0 < e < 1})
    sketches = stage(rows.groupBy(*keys).agg(*[F.percentile_approx(n, asked or [0.5], ACCURACY).alias(f"{n}_e") for n in names]), "sketches")

    def end(n: str, e: float) -> Column:
        return F.get(f"{n}_e", F.lit(asked.index(e))) if 0 < e < 1 else F.lit(float("-inf") if e <= 0 else float("inf"))

    ends = {(i, j): (end(n, p - reach), end(n, p + reach)) for i, n in enumerate(names) for j, p in enumerate(probs)}
    marked = rows.join(sketches, keys)
    under = marked.groupBy(*keys).agg(*[F.count_if(F.col(names[i]) <= low).alias(f"_{i}_{j}") for (i, j), (low, _) in ends.items()])
    counts = sizes.select(*keys, *[F.col(f"{n}_count").alias(f"{n}_n") for n in names])
    per_end = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(probs[j])).alias("p"), low.alias("low"), high.alias("high"),
                 F.col(f"_{i}_{j}").alias("to_low"), F.col(f"{names[i]}_n").alias("n"))
        for (i, j), (low, high) in ends.items()
    ])
    wanted = under.join(sketches, keys).join(counts, keys).select(*keys, F.explode(per_end).alias("e")).select(*keys, "e.*")
    at = F.col("p") * (F.col("n") - 1)
    wanted = stage(wanted.filter("n > 0").withColumns({"at": at, "r0": F.floor(at), "r1": F.ceil(at)}), "wanted")

    def in_some(i: int) -> Column:
        inside = F.lit(False)
        for j in range(len(probs)):
            low, high = ends[i, j]
            inside = inside | ((F.col(names[i]) > low) & (F.col(names[i]) < high))
        return inside

    found = F.array(*[F.when(in_some(i), F.struct(F.lit(i).alias("i"), F.col(n).alias("value"))) for i, n in enumerate(names)])
    picked = marked.select(*keys, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*")
    ranked = number_rows(picked, [*keys, "i"], ["value"], "place", "picked", "quantiles")
    spot = [*keys, "i", "j"]
    # A value's rank: those up to the bracket's low end, and the picked ones between that end and the value.
    inside = ranked.join(wanted.select(*spot, "low", "high", "to_low", "r0", "r1"), [*keys, "i"]).filter("value > low and value < high")
    inside = stage(inside.select(*spot, "value", "place", "to_low", "r0", "r1"), "inside")
    start = inside.groupBy(*spot).agg(F.min("place").alias("start"))
    rank = F.col("place") - F.col("start") + F.col("to_low")
    hits = inside.join(start, spot).withColumn("rank", rank).filter("rank = r0 or rank = r1").groupBy(*spot).agg(
        *[F.max(F.when(F.col("rank") == F.col(r), F.col("value"))).alias(v) for r, v in (("r0", "v0"), ("r1", "v1"))]
    )

    def value(r: str, hit: str) -> Column:
        return F.when(F.col(r) < F.col("to_low"), F.col("low")).otherwise(F.coalesce(F.col(hit), F.col("high")))

    share = F.col("at") - F.col("r0")
    mixed = F.when(F.col("r0") == F.col("r1"), value("r0", "v0")).otherwise((1 - share) * value("r0", "v0") + share * value("r1", "v1"))
    inner = F.col("v0").isNotNull() & F.col("v1").isNotNull()
    settled = stage(wanted.join(hits, spot, "left").select(*spot, mixed.alias("q"), inner.alias("inner"), "low", "high", "to_low", "r0", "r1"), "settled")
    if not (outer := settled.filter(~F.col("inner"))).isEmpty():
        sure = _proven(rows, stage(outer, "outer"), keys, names)
        settled = settled.join(sure, spot, "left").withColumn("inner", F.col("inner") | F.coalesce("sure", F.lit(False)))
    wide = settled.groupBy(*keys).agg(
        F.min("inner").alias("_sure"),
        *[F.array(*[F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("q"))) for j in range(len(probs))]).alias(f"{n}_q") for i, n in enumerate(names)],
    )
    wide = stage(wide, "quantiles")
    again = wide.filter(~F.col("_sure")).select(*keys)
    done = wide.filter("_sure").drop("_sure")
    if again.isEmpty():
        return done
    return done.unionByName(_bracketed(rows.join(again, keys, "left_semi"), sizes.join(again, keys, "left_semi"), keys, names, probs, reach * 8))


def _proven(rows: DataFrame, outer: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``keys, i, j, sure``: whether the ranks of a result at the end of its bracket belong to that end, by a count.

    Only the columns concerned are looked at, and the plain columns of a row, not a row per column.
    """
    places = [(r["i"], r["j"]) for r in outer.select("i", "j").distinct().collect()]  # at most columns x quantiles
    ends = outer.groupBy(*keys).agg(*[
        F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col(c))).alias(f"_{c}_{i}_{j}") for i, j in places for c in ("low", "high")
    ])
    counted = rows.join(stage(ends, "ends"), keys).groupBy(*keys).agg(
        *[F.count_if(F.col(names[i]) < F.col(f"_low_{i}_{j}")).alias(f"_under_{i}_{j}") for i, j in places],
        *[F.count_if(F.col(names[i]) <= F.col(f"_high_{i}_{j}")).alias(f"_up_{i}_{j}") for i, j in places],
    )
    long = counted.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"_under_{i}_{j}").alias("under"), F.col(f"_up_{i}_{j}").alias("up")) for i, j in places
    ])).alias("x")).select(*keys, "x.*")
    return outer.join(long, [*keys, "i", "j"]).select(*keys, "i", "j", ((F.col("under") <= F.col("r0")) & (F.col("r1") < F.col("up"))).alias("sure"))


STATS = ["count", "mean", "std", "min", "max"]


def exact_quantiles(values: DataFrame, keys: Sequence[str], probs: Sequence[float] = QUARTILES, few: int = FEW) -> DataFrame:
    """Interpolated quantiles ``q0, q1, ...`` of ``value`` per ``keys``, exact, for groups of any size."""
    found = wide_quantiles(values, keys, ["value"], probs, few)
    return found.select(*keys, *[f"q{i}" for i in range(len(probs))])


def approximate_quantiles(values: DataFrame, keys: Sequence[str], probs: Sequence[float] = QUARTILES, accuracy: int = ACCURACY) -> DataFrame:
    """Values ``q0, q1, ...`` per ``keys`` whose rank is wrong by at most one in ``accuracy`` of the group, in one pass.

    Each is one of the group's values; between two of them nothing is interpolated.
    """
    found = values.groupBy(*keys).agg(F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("q"))
    return found.select(*keys, *[F.get("q", F.lit(i)).alias(f"q{i}") for i in range(len(probs))])


def describe_columns(df: DataFrame, columns: Sequence[str], few: int = FEW) -> DataFrame:
    """count, mean, std, min, quartiles and max per symbol and column."""
    return wide_quantiles(df, ["symbol"], columns, QUARTILES, few).withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"})


def eda_summary(
    features: DataFrame, universe: DataFrame | None = None, er_bars: int = 10, er_above: float = 0.3, block: int = BLOCK
) -> DataFrame:
    """One row per symbol: span, price, ATR and ER moments, share of momentum bars.

    The efficiency ratio starts anew on the feature frame; its missing first values
    count as "not above" in the share. ``universe(symbol, csl)`` limits and labels.
    """
    rows = with_indicators(
        features.select("symbol", "ts", "bar_no", "n_bars", "close", "ATR_50"),
        ind.efficiency_ratio(er_bars, out="_er"),
        block=block,
    )
    above = F.coalesce(F.round("_er", TIE_DIGITS) > er_above, F.lit(False)).cast("int")
    summary = rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.to_date(F.min("ts")).alias("first_day"),
        F.to_date(F.max("ts")).alias("last_day"),
        F.avg("close").alias("price_mean"),
        F.stddev_samp("close").alias("price_std"),
        F.avg("ATR_50").alias("atr_mean"),
        F.stddev_samp("ATR_50").alias("atr_std"),
        F.avg("_er").alias("er_mean"),
        F.stddev_samp("_er").alias("er_std"),
        F.avg(above).alias("er_above_thresh_pct"),
    )
    return summary if universe is None else universe.select("symbol", "csl").join(summary, "symbol")


def eda_rollup(summary: DataFrame) -> DataFrame:
    """Number of symbols, all bars, and means of the per-symbol means."""
    return summary.agg(
        F.count(F.lit(1)).alias("n_symbols"),
        F.sum("n_bars").alias("n_bars"),
        F.avg("price_mean").alias("price_mean"),
        F.avg("atr_mean").alias("atr_mean"),
        F.avg("er_mean").alias("er_mean"),
        F.avg("er_above_thresh_pct").alias("er_above_thresh_pct"),
    )


def label_counts(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("symbol", "label").agg(F.count(F.lit(1)).alias("n"))
