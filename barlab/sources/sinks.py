"""Writers of result tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", per_symbol: bool = False, order: tuple[str, ...] = ()
) -> None:
    """Write a table as parquet or CSV (with header).

    ``per_symbol`` makes one folder per symbol and suits few symbols. Otherwise big
    tables are range-clustered by ``order`` (e.g. symbol, ts), so that file
    statistics let later reads skip files.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if per_symbol:
        writer = writer.partitionBy("symbol")
    writer.save(path)


def write_symbol_folders(df: DataFrame, folder: str, columns: Sequence[str], order: Sequence[str] = ("ts",)) -> None:
    """CSV files with a header in a folder ``symbol=<symbol>`` each, as many per symbol as its rows need.

    The rows are ranged by symbol and ``order``, so a large symbol is written by many tasks and each file holds consecutive rows.
    """
    ranged = df.select(F.col("symbol"), *[F.col(c) for c in dict.fromkeys([*columns, *order])]).repartitionByRange("symbol", *order)
    ranged.sortWithinPartitions("symbol", *order).select("symbol", *columns).write.mode("overwrite").partitionBy("symbol").option(
        "header", True).option("escape", '"').csv(folder)


def write_symbol_files(df: DataFrame, folder: str, columns: Sequence[str], prefix: str = "") -> None:
    """One CSV file ``<prefix><symbol>.csv`` per symbol, with ``columns`` in this order.

    The format asks for one file, and so for one task, per symbol; for large symbols use :func:`write_symbol_folders`.
    Spark writes a folder per symbol beside ``folder``, and each folder's file is then moved to its name.
    """
    spark = df.sparkSession
    side = f"{folder.rstrip('/')}-{uuid.uuid4().hex}"
    one = df.select(F.col("symbol").alias("_symbol"), *columns).repartition("_symbol").sortWithinPartitions("_symbol")
    one.write.partitionBy("_symbol").option("header", True).option("escape", '"').csv(side)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(side).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for held in fs.listStatus(path(side)):
        name = held.getPath().getName()
        if name.startswith("_symbol="):
            symbol = unescape(name.removeprefix("_symbol="))
            for file in fs.listStatus(held.getPath()):
                fs.rename(file.getPath(), path(f"{folder}/{prefix}{symbol}.csv"))
    fs.delete(path(side), True)
