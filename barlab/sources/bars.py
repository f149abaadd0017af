"""Readers of bar tables and per-symbol files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlab.functions.scalars import null_if_nan
from barlab.params import FEATURE_COLUMNS
from barlab.schema import BAR_COLUMNS, BARS
from barlab.session import stage

# A cell up to its comma: quoted, with doubled quotes inside, or plain. Every line is matched with a comma appended.
CELL = r'("(?:[^"]|"")*+"|[^,]*+),'


def clean_bars(df: DataFrame) -> DataFrame:
    """The bar columns in fixed types; NaN becomes null."""
    return df.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        *[null_if_nan(c).alias(c) for c in BAR_COLUMNS[2:]],
    )


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A bar table ``symbol, ts, open, high, low, close, volume``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # The header is checked against the schema; a mismatch is an error.
        reader = reader.schema(BARS).option("header", True).option("enforceSchema", False)
    return clean_bars(reader.load(path))


def _symbol_from_path(prefix: str = "", folders: bool = False) -> Column:
    """The symbol by a file's stem, or by its folder ``symbol=<symbol>``."""
    if folders:
        return F.regexp_extract(F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)), "^symbol=(.*)$", 1)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    stem = F.regexp_replace(F.url_decode(name), r"\.[^.]+(\.gz)?$", "")
    return F.regexp_replace(stem, f"^{prefix}", "") if prefix else stem


# A line that begins outside quotes and ends inside a quoted cell. A quote within a plain cell means nothing.
OPENS = r'^(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]|"")*+$'
# What of a line that begins inside quotes is still inside, and its first closing quote up to the next cell.
INSIDE, CLOSES = r'^(?:[^"]|"")*+$', r'^(?:[^"]|"")*+"[^,]*+,?'
UNQUOTED = "transform({0}, c -> trim(CASE WHEN c LIKE '\"%' THEN replace(substring(c, 2, length(c) - 2), '\"\"', '\"') ELSE c END))"


def _bare_cells(line: str) -> Column:
    return F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(CELL), F.lit(1))


def _heading_flags(wanted: Sequence[tuple[str, ...]]) -> tuple[Column, Column]:
    """Whether ``line`` names every wanted column, and whether its ``cells`` are such names."""
    named, complete = F.lit(True), F.lit(True)
    unquoted = F.expr(UNQUOTED.format("cells"))
    for names in wanted:
        some = F.lit(False)
        for n in names:
            some = some | F.col("line").contains(n)
        named = named & some
        complete = complete & F.arrays_overlap(unquoted, F.array(*[F.lit(n) for n in names]))
    return named, named & complete


def _torn_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of files in which a quoted cell holds a line break: ``file, blk, symbol, line``, and files that end inside quotes.

    ``lines(file, blk, at, symbol, line)``. A line maps the state before it (outside or inside quotes) to the state after it; it
    keeps or swaps the state, or sets it. Maps are composed by windows over a block of a file, one row per block goes
    through a window over the file, and a record begins at each line that finds the state outside. Lines of a record
    meet by the block and number of its first line, also over several blocks.
    """
    line = F.col("line")
    after_out = line.rlike(OPENS).cast("int")
    after_in = F.when(line.rlike(INSIDE), 1).otherwise(F.regexp_replace(line, CLOSES, "").rlike(OPENS).cast("int"))
    rows = lines.withColumns({"_out": after_out, "_in": after_in})
    of_block = Window.partitionBy("file", "blk").orderBy("at")
    before = of_block.rowsBetween(Window.unboundedPreceding, -1)
    # The state is what the last setting line set, swapped by every swapping line since.
    rows = rows.withColumns({"_set": F.when(F.col("_out") == F.col("_in"), F.col("_out")), "_swap": (F.col("_out") > F.col("_in")).cast("int")})
    rows = rows.withColumn("_swaps", F.sum("_swap").over(of_block.rowsBetween(Window.unboundedPreceding, 0)))
    mark = F.when(F.col("_set").isNotNull(), F.struct(F.col("_set").alias("set"), F.col("_swaps").alias("swaps")))
    rows = rows.withColumns({"_mark": F.last(mark, ignorenulls=True).over(before), "_swapped": F.coalesce(F.lag("_swaps").over(of_block), F.lit(0))})
    rows = stage(rows, "torn")

    def state(mark: Column, swaps: Column, start: Column) -> Column:
        return F.when(mark.isNull(), (start + swaps) % 2).otherwise((mark["set"] + swaps - mark["swaps"]) % 2)

    last = F.max_by(F.struct("_out", "_in", F.col("_mark").alias("mark"), F.col("_swapped").alias("swaps")), "at").alias("l")
    ends = rows.groupBy("file", "blk").agg(last, F.max("symbol").alias("symbol"))

    def leaves(start: int) -> Column:
        into = state(F.col("l.mark"), F.col("l.swaps"), F.lit(start))
        return F.when(into == 0, F.col("l._out")).otherwise(F.col("l._in"))

    ends = ends.select("file", "blk", "symbol", leaves(0).alias("_out"), leaves(1).alias("_in"))
    of_file = Window.partitionBy("file").orderBy("blk")
    ends = ends.withColumns({"_set": F.when(F.col("_out") == F.col("_in"), F.col("_out")), "_swap": (F.col("_out") > F.col("_in")).cast("int")})
    ends = ends.withColumn("_swaps", F.sum("_swap").over(of_file.rowsBetween(Window.unboundedPreceding, 0)))
    mark = F.when(F.col("_set").isNotNull(), F.struct(F.col("_set").alias("set"), F.col("_swaps").alias("swaps")))
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("start", state(F.last(mark, ignorenulls=True).over(earlier), F.coalesce(F.lag("_swaps").over(of_file), F.lit(0)), F.lit(0)))
    ends = ends.withColumn("end", F.when(F.col("start") == 0, F.col("_out")).otherwise(F.col("_in")))
    ends = stage(ends.select("file", "blk", "symbol", "start", "end", F.row_number().over(of_file.orderBy(F.desc("blk"))).alias("last")), "states")
    unclosed = ends.filter((F.col("last") == 1) & (F.col("end") == 1)).select("file", "symbol")
    begins = state(F.col("_mark"), F.col("_swapped"), F.col("start")) == 0
    rows = rows.join(ends.select("file", "blk", "start"), ["file", "blk"]).join(unclosed.select("file"), "file", "left_anti")
    rows = rows.withColumn("_no", F.sum(begins.cast("int")).over(of_block.rowsBetween(Window.unboundedPreceding, 0)))
    counted = rows.groupBy("file", "blk").agg(F.max("_no").alias("_records"))
    own = F.when(F.col("_records") > 0, F.struct(F.col("blk").alias("blk"), F.col("_records").alias("no")))
    carried = counted.select("file", "blk", F.last(own, ignorenulls=True).over(earlier).alias("_carried"))
    rows = rows.join(carried, ["file", "blk"])
    first = F.when(F.col("_no") > 0, F.struct("blk", F.col("_no").alias("no"))).otherwise(F.col("_carried"))
    whole = rows.groupBy("file", "symbol", first.alias("first")).agg(F.sort_array(F.collect_list(F.struct("blk", "at", "line")))["line"].alias("parts"))
    return whole.select("file", F.col("first.blk").alias("blk"), "symbol", F.array_join("parts", "\n").alias("line")), unclosed


def _named_lines(
    spark: SparkSession, folder: str, pattern: str, prefix: str, wanted: Sequence[tuple[str, ...]], folders: bool = False
) -> tuple[DataFrame, DataFrame]:
    """CSV files of a folder, each read by its own header: ``(rows, rejected files)``.

    ``wanted`` lists the columns, each with the headings it may have; rows get ``file, blk, symbol`` and one string
    column per wanted one, under its first name. Columns may stand in any order and number, others are
    ignored. The text is read once: a line becomes one array of cells in a staged table, and the header's array
    tells the places. Only files in which a line ends inside quotes are looked at again, line by line. Rows meet
    their header by file and block of the file, so that a large file is read by many tasks.
    """
    text = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("blk"),
        _symbol_from_path(prefix, folders).alias("symbol"), F.regexp_replace("value", "^\ufeff", "").alias("line"),
        F.monotonically_increasing_id().alias("at"),
    )
    named, head = _heading_flags(wanted)
    quoted = F.col("line").contains('"')
    lines = text.withColumn("cells", _bare_cells("line")).select(
        "file", "blk", "symbol", "at", "cells", named.alias("named"), head.alias("head"), (F.trim("line") == "").alias("blank"),
        (quoted & F.col("line").rlike(OPENS)).alias("opens"), F.when(quoted, F.col("line")).alias("line"),
    )
    lines = stage(lines, "lines")
    torn = stage(lines.filter("opens").select("file").distinct(), "torn-files")
    parsed, unclosed = lines.filter("not blank"), None
    if not torn.isEmpty():
        plain = F.coalesce("line", F.array_join("cells", ","))
        records, unclosed = _torn_records(lines.join(torn, "file", "left_semi").select("file", "blk", "at", "symbol", plain.alias("line")))
        records = records.filter(F.trim("line") != "").withColumn("cells", _bare_cells("line"))
        kept = ["file", "blk", "symbol", "cells", "named", "head"]
        records = stage(records.select("file", "blk", "symbol", "cells", named.alias("named"), head.alias("head")), "records")
        parsed = parsed.join(torn, "file", "left_anti").select(*kept).unionByName(records)
    headers = stage(parsed.filter("head").groupBy("file").agg(F.min(F.expr(UNQUOTED.format("cells"))).alias("header")), "headers")
    blocks = stage(parsed.select("file", "blk", "symbol").distinct(), "blocks")
    place = stage(blocks.join(headers, "file").select("file", "blk", "header"), "places")
    rows = parsed.filter("not named").join(place, ["file", "blk"]).select(
        "file", "blk", "symbol", "header", F.expr(UNQUOTED.format("cells")).alias("cells")
    )

    def cell(names: tuple[str, ...]) -> Column:
        at = F.greatest(*[F.array_position("header", n) for n in names], F.lit(0))
        return F.get("cells", at.cast("int") - 1)

    bad = blocks.select("file", "symbol").distinct().join(headers, "file", "left_anti").withColumn("reason", F.lit("no header"))
    if unclosed is not None:
        bad = bad.unionByName(unclosed.withColumn("reason", F.lit("unclosed quote")))
    return rows.select("file", "blk", "symbol", *[cell(n).alias(n[0]) for n in wanted]), bad


def _without_bad(rows: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that have no ``bad`` row, and the other files."""
    spoilt = stage(rows.filter(bad).select("file", "symbol").distinct(), "spoilt")
    blocks = stage(rows.select("file", "blk").distinct().join(spoilt, "file", "left_semi"), "spoilt-blocks")
    return rows.join(blocks, ["file", "blk"], "left_anti"), spoilt


def _rejects(unread: DataFrame, spoilt: DataFrame, why: str) -> DataFrame:
    both = unread.select("file", "symbol", "reason").unionByName(spoilt.select("file", "symbol", F.lit(why).alias("reason")))
    return both.select("symbol", "reason", "file")


def read_symbol_files(
    spark: SparkSession, folder: str, pattern: str = "*.csv", date: str = "Date", time: str = "Time",
    ts_format: str | None = None, folders: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """All files below a folder as ``(bars, rejects)``; the file stem is the symbol, or with ``folders`` its folder's.

    Every file is read by its own header, also if two files have one stem. A file without a usable
    header, with a time that cannot be read, or that ends inside quotes goes to ``rejects(symbol, reason, file)``; other
    files of the symbol stay. Quoted cells may hold line breaks.
    """
    prices = ["Open", "High", "Low", "Close", "Volume"]
    rows, unread = _named_lines(spark, folder, pattern, "", [(date,), (time,), *[(n,) for n in prices]], folders)
    stamp = F.concat(F.col(f"`{date}`"), F.lit(" "), F.col(f"`{time}`"))
    ts = F.try_to_timestamp(stamp) if ts_format is None else F.try_to_timestamp(stamp, F.lit(ts_format))
    parsed = rows.select(
        "file", "blk", "symbol", ts.cast("timestamp_ntz").alias("ts"), *[F.col(n).try_cast("double").alias(n.lower()) for n in prices]
    )
    good, spoilt = _without_bad(parsed, F.col("ts").isNull())
    return clean_bars(good), _rejects(unread, spoilt, "bad time")


def read_frames(spark: SparkSession, folder: str, prefix: str, labeled: bool = False) -> tuple[DataFrame, DataFrame]:
    """Per-symbol CSV files ``<prefix><symbol>.csv`` of features or labeled bars, as ``(frames, rejects)``.

    Headings may be those of this package (``ts, open, ...``) or ``Datetime, Open, ...``; further columns, such as an
    ``ATR`` alias, are ignored. A file that lacks a column is rejected alone. Times may carry a zone
    and become zoneless UTC (the session zone is UTC); rows without a time are dropped.
    """
    prices = ["open", "high", "low", "close", "volume"]
    numbers = [*[(c, c.title()) for c in prices], *[(c,) for c in FEATURE_COLUMNS]]
    extra = [("label",), ("entry_bar", "entry_idx")] if labeled else []
    rows, unread = _named_lines(spark, folder, f"{prefix}*.csv", prefix, [("ts", "Datetime"), *numbers, *extra])
    kinds = {"label": "int", "entry_bar": "bigint"}
    frames = rows.select(
        "symbol", F.try_to_timestamp("ts").cast("timestamp_ntz").alias("ts"),
        *[F.col(n[0]).try_cast("double").alias(n[0]) for n in numbers],
        *[F.col(n[0]).try_cast("double").cast(kinds[n[0]]).alias(n[0]) for n in extra],
    )
    frames = frames.withColumns({n[0]: null_if_nan(n[0]) for n in numbers}).filter(F.col("ts").isNotNull())
    return frames, unread.select("symbol", "reason", "file")
