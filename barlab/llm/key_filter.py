"""Rows told apart by a fixed-size filter of keys, so that only some of a table is shuffled."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.collocations import make_filter
from barlab.llm.common import ship_package


def split_by_keys(rows: DataFrame, k1: str, k2: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose two 64-bit columns may be among ``keys`` (two columns), and the others, which surely are not.

    The filter is sent to every task and has one size whatever the keys; the fuller it is, the more rows are in the first part. Only
    the two columns go through Python.
    """
    spark = rows.sparkSession
    ship_package(spark)
    a, b = keys.columns
    held = spark.sparkContext.broadcast(make_filter(keys.select(F.col(a).alias("w1"), F.col(b).alias("w2")), 2))

    @F.arrow_udf("boolean")
    def may_be(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(held.value.holds([x.to_numpy(), y.to_numpy()]))

    marked = rows.withColumn("__may_be", may_be(F.col(k1), F.col(k2)))
    return marked.where("__may_be").drop("__may_be"), marked.where("not __may_be").drop("__may_be")
