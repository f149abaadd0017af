"""Row numbers and blocks of a panel.

A symbol may hold a third of all rows, so no window here is partitioned by
symbol alone. Rows carry a dense ``bar_no`` per symbol; bounded windows run on
``(symbol, blk)`` with ``blk = bar_no div BLOCK`` after each row was also copied
into the neighbouring blocks that look at it (the halo).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlab.session import shared_folder, stage

BLOCK = 32768
SUB = 1024  # common length of a scan segment; divides every block size in use


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "bar_no",
    total: str = "n_bars",
    name: str = "numbered",
) -> DataFrame:
    """Add the 0-based rank ``out`` and the row count ``total`` per ``keys``.

    The rows are range-partitioned and sorted by ``keys + order`` (balanced
    whatever the key distribution) and written once with their physical
    position. The rank is that position, shifted by the rows of the same key in
    earlier partitions: one small row per (key, partition).
    ``keys + order`` must be unique for a repeatable result.
    """
    keys, order = list(keys), list(order)
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_at", 33))
    )
    placed = stage(ranged, name)
    slices = placed.groupBy(*keys, "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(slices.select(
        *keys,
        "_slice",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias(total),
    ), "shifts")
    return (
        placed.join(shifts, [*keys, "_slice"])
        .withColumn(out, F.col("_at") + F.col("_shift"))
        .drop("_at", "_slice", "_shift")
    )


def number_bars(bars: DataFrame) -> DataFrame:
    """Turn bars with unique ``(symbol, ts)`` into a panel with ``bar_no, n_bars``."""
    return number_rows(bars, ["symbol"], ["ts"], name="panel")


def rank_kept(df: DataFrame, out: str = "row_no", total: str = "n_rows", block: int = BLOCK) -> DataFrame:
    """Rank of each remaining row per symbol, for frames that keep ``bar_no``.

    Counts per block are summed up per symbol; the rank inside a block is local.
    Reads ``df`` twice, so stage an expensive ``df`` first.
    """
    cut = df.withColumn("_blk", F.expr(f"bar_no div {block}L"))
    counts = cut.groupBy("symbol", "_blk").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("symbol")
    earlier = whole.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        "symbol",
        "_blk",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"),
        F.sum("_rows").over(whole).alias(total),
    )
    # The local rank needs the same partitioning as the join, so nothing moves twice.
    local = F.row_number().over(Window.partitionBy("symbol", "_blk").orderBy("bar_no")) - 1
    return (
        cut.withColumn("_local", local)
        .join(shifts, ["symbol", "_blk"])
        .withColumn(out, F.col("_local") + F.col("_shift"))
        .drop("_blk", "_local", "_shift")
    )


def blocked(panel: DataFrame, lookback: int = 0, lookahead: int = 0, block: int = BLOCK) -> DataFrame:
    """Add ``blk`` and ``sub``; rows within reach of another block are copied there.

    ``lookback`` rows before and ``lookahead`` rows after each own row are then
    present in its block, so a bounded frame gives the same value as without
    blocks. Take the copies out again with :func:`own_rows`. A table of
    :func:`bucketed` with copies enough is taken as it is.
    """
    if block % SUB:
        raise ValueError(f"block must be a multiple of {SUB}")
    if block_columns(panel):
        held = panel.schema["blk"].metadata
        if held["block"] != block or held["back"] < lookback or held["ahead"] < lookahead:
            raise ValueError(f"the table has {held}, asked are blocks of {block} with {lookback} bars back and {lookahead} ahead")
        return panel.withColumn("sub", F.expr(f"bar_no div {SUB}L"))
    if lookback == 0 and lookahead == 0:
        out = panel.withColumn("blk", F.expr(f"bar_no div {block}L"))
    else:
        first = f"greatest(bar_no - {lookahead}, 0L) div {block}L"
        last = f"least(bar_no + {lookback}, n_bars - 1) div {block}L"
        out = panel.withColumn("blk", F.explode(F.expr(f"sequence({first}, {last})")))
    return out.withColumn("sub", F.expr(f"bar_no div {SUB}L"))


def block_columns(panel: DataFrame) -> list[str]:
    """``blk`` if the frame comes from :func:`bucketed`, to be kept where columns are chosen."""
    return ["blk"] if "blk" in panel.columns and "block" in panel.schema["blk"].metadata else []


def bucketed(
    panel: DataFrame, lookback: int, lookahead: int, name: str = "panel", buckets: int | None = None, block: int = BLOCK
) -> DataFrame:
    """The panel as a table of blocks with their copies, bucketed by ``(symbol, blk)`` and sorted by ``bar_no``.

    Operators that look back or ahead no further than the copies reach take it without a shuffle: their windows, and their joins
    with per-block values, find the rows of a block together. Worth it where several of them read one panel. The table
    lies in the shared folder; ``blk`` carries the sizes with it.
    """
    spark = panel.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = F.col("blk").alias("blk", metadata={"block": block, "back": lookback, "ahead": lookahead})
    cut = blocked(panel, lookback, lookahead, block)
    table = f"barlab_{name}_{uuid.uuid4().hex}"
    rows = cut.select(*panel.columns, marked).repartition(count, "symbol", "blk")
    path = f"{shared_folder(spark)}/barlab/{table}"
    rows.write.bucketBy(count, "symbol", "blk").sortBy("bar_no").option("path", path).saveAsTable(table)
    return spark.table(table)


def own_rows(df: DataFrame, block: int = BLOCK, keep_blk: bool = False) -> DataFrame:
    """Drop the halo copies."""
    out = df.filter(F.expr(f"bar_no div {block}L = blk")).drop("sub")
    return out if keep_blk else out.drop("blk")


def bar_window() -> WindowSpec:
    """Bars of a block in order. ``sub`` leads so segment windows reuse the sort."""
    return Window.partitionBy("symbol", "blk").orderBy("sub", "bar_no")


def segment_window(length: int = SUB) -> WindowSpec:
    """Bars of one scan segment up to the current one."""
    segment = F.col("sub") if length == SUB else F.expr(f"bar_no div {length}L")
    return (
        Window.partitionBy("symbol", "blk", segment).orderBy("bar_no").rowsBetween(Window.unboundedPreceding, 0)
    )


def trailing(n: int) -> WindowSpec:
    return bar_window().rowsBetween(1 - n, 0)


def ahead(first: int, last: int) -> WindowSpec:
    return bar_window().rowsBetween(first, last)


def earlier_bars() -> WindowSpec:
    return bar_window().rowsBetween(Window.unboundedPreceding, -1)


def lag(column: str | Column, k: int = 1) -> Column:
    return F.lag(column, k).over(bar_window())


def spread(per_symbol: DataFrame, block: int = BLOCK) -> DataFrame:
    """One copy of a per-symbol row (with ``n_bars``) for each block of the symbol.

    Joining on ``(symbol, blk)`` keeps the panel's partitioning and splits a hot
    symbol, which a join on ``symbol`` would not.
    """
    return per_symbol.withColumn(
        "blk", F.explode(F.expr(f"sequence(0L, (n_bars - 1) div {block}L)"))
    ).drop("n_bars")


def fill_forward(
    df: DataFrame, columns: Sequence[str], block: int = BLOCK, trim: bool = False, name: str = "filled"
) -> DataFrame:
    """Last non-null value carried forward, per symbol, over any distance.

    Inside a block a running window fills; a row that is still null takes the
    last value of the earlier blocks, from one row per (symbol, block). ``df`` is
    written once, with a flag for rows that have a gap, and blocks without a gap
    skip window and join.

    ``trim`` also drops the rows with a null left and renumbers the bars. After the
    fill these rows are a prefix of each symbol, so the new number is the old one
    less the first complete bar; no new ranking is needed.
    """
    columns = list(columns)
    gap = F.lit(False)
    for c in columns:
        gap = gap | F.col(c).isNull()
    cut = stage(df.withColumns({"blk": F.expr(f"bar_no div {block}L"), "_gap": gap}), name)
    holes = cut.filter("_gap")
    if trim:
        sizes = cut.groupBy("symbol").agg(F.max("n_bars").alias("n_bars"))
        first = stage(spread(_first_complete(cut, columns).join(sizes, "symbol"), block), "first")
        # Holes in the dropped prefix need no filling.
        holes = holes.join(first, ["symbol", "blk"]).filter(F.col("bar_no") >= F.col("_first"))
    gappy = stage(holes.select("symbol", "blk").distinct(), "gappy")
    clean = cut.join(gappy, ["symbol", "blk"], "left_anti")
    run = Window.partitionBy("symbol", "blk").orderBy("bar_no").rowsBetween(Window.unboundedPreceding, 0)
    local = cut.join(gappy, ["symbol", "blk"], "left_semi").withColumns(
        {c: F.last(c, ignorenulls=True).over(run) for c in columns}
    )
    # Values are carried within the symbols concerned only; usually there are none.
    blocks = cut.groupBy("symbol", "blk").agg(F.count(F.lit(1)).alias("_n")).select("symbol", "blk")
    wanted = stage(blocks.join(gappy.select("symbol").distinct(), "symbol", "left_semi"), "concerned")
    concerned = cut.join(wanted, ["symbol", "blk"], "left_semi")
    ends = concerned.groupBy("symbol", "blk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("bar_no"))).alias(c) for c in columns]
    )
    before = Window.partitionBy("symbol").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        "symbol", "blk", *[F.last(c, ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns]
    )
    filled = local.join(carry, ["symbol", "blk"]).select(
        *[
            F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) if c in columns else F.col(c)
            for c in cut.columns
        ]
    )
    whole = clean.unionByName(filled).drop("_gap")
    if not trim:
        return whole.drop("blk")
    return (
        whole.join(first, ["symbol", "blk"])
        .filter(F.col("bar_no") >= F.col("_first"))
        .withColumns({"bar_no": F.col("bar_no") - F.col("_first"), "n_bars": F.col("n_bars") - F.col("_first")})
        .drop("_first", "blk")
    )


def _first_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``symbol, _first``: the bar from which every column has had a value.

    ``df`` flags rows with a missing value as ``_gap``. A symbol with a column that never has one is missing: it has no complete row.
    """
    names = [f"_at{i}" for i in range(len(columns))]
    # Rows without a hole show every column; only the few others are looked at singly.
    whole = df.filter(~F.col("_gap")).groupBy("symbol").agg(F.min("bar_no").alias("_at"))
    holed = df.filter("_gap").groupBy("symbol").agg(
        *[F.min(F.when(F.col(c).isNotNull(), F.col("bar_no"))).alias(n) for c, n in zip(columns, names)]
    )
    seen = (
        whole.select("symbol", *[F.col("_at").alias(n) for n in names])
        .unionByName(holed)
        .groupBy("symbol")
        .agg(*[F.min(n).alias(n) for n in names])
    )
    return seen.na.drop(subset=names).select("symbol", F.greatest(*names, F.lit(0)).alias("_first"))
