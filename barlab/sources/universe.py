"""Lists of symbols and calibrated universes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.params import DEFAULT_SYMBOLS
from barlab.schema import UNIVERSE


def parse_symbols(lines: DataFrame, column: str = "value") -> DataFrame:
    """One symbol per line, trimmed and upper-case; blanks and ``#`` lines skipped."""
    return (
        lines.select(F.upper(F.trim(column)).alias("symbol"))
        .filter((F.col("symbol") != "") & ~F.col("symbol").startswith("#"))
    )


def read_symbols(spark: SparkSession, path: str) -> DataFrame | None:
    """Symbols of a text file; None if the file is missing or names none."""
    try:
        found = parse_symbols(spark.read.text(path))
    except AnalysisException:
        return None
    return None if found.isEmpty() else found


def universe_symbols(spark: SparkSession, path: str | None = None, listed: Sequence[str] | None = None) -> DataFrame:
    """Symbols from the file, else from the list, else the default ones."""
    found = read_symbols(spark, path) if path else None
    if found is not None:
        return found
    return spark.createDataFrame([(s,) for s in (listed or DEFAULT_SYMBOLS)], "symbol string")


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """A calibrated universe from CSV, one row per symbol with its ``csl``."""
    return (
        spark.read.schema(UNIVERSE).option("header", True).option("enforceSchema", False).csv(path)
        .withColumnRenamed("ticker", "symbol")
    )
